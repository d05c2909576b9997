"""Keys built from other columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.functions.columns import quoted

# Separators inside keys.
ROW_KEY_SEPARATOR = "|"
PERIOD_KEY_SEPARATOR = "/"


def surrogate_key(df: DataFrame, *names: str) -> Column:
    """SHA-256 hex of the parts' text, NULL as empty text.

    Decimals use Java's text (``0E-8``), so a key does not change with the ANSI setting.
    """
    kinds = dict(df.dtypes)
    parts = []
    for name in names:
        part = quoted(name)
        if kinds[name].startswith("decimal"):
            part = F.when(part.isNotNull(), F.format_string("%s", part))
        parts.append(F.coalesce(part.cast("string"), F.lit("")))
    return F.sha2(F.concat_ws(ROW_KEY_SEPARATOR, *parts), 256)


def joined_key(*parts: Column) -> Column:
    """``a/b``; NULL when any part is."""
    pieces = []
    for part in parts:
        pieces += [F.lit(PERIOD_KEY_SEPARATOR), part.cast("string")]
    return F.concat(*pieces[1:])
