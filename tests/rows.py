"""Rows of a frame in a form that two results can be compared in."""


def rows(df, *names):
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*names) if names else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
