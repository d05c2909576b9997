"""Row filters: months, dates, required columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.context import month_bounds
from tiercraft.functions.columns import quoted, to_whole, trim_lower


def only_month(df: DataFrame, column: str, month: int | None) -> DataFrame:
    """Rows of one month; everything when ``month`` is None."""
    if month is None:
        return df
    return df.filter(_month(df, column) == int(month))


def through_month(df: DataFrame, column: str, month: int | None) -> DataFrame:
    """Rows before the end of the month (NULL dates dropped); everything when ``month`` is None."""
    if month is None:
        return df
    _, following = month_bounds(month)
    kind = dict(df.dtypes)[column]
    # Dates and timestamps are compared as stored, so the bound reaches the file reader.
    value = quoted(column) if kind in ("date", "timestamp") else quoted(column).try_cast("timestamp")
    bound = F.lit(following) if kind == "date" else F.lit(following).cast("timestamp")
    return df.filter(value < bound)


def without_months(df: DataFrame, column: str, months: Iterable[int]) -> DataFrame:
    """Rows of other months (NULL months dropped); everything when no month is listed."""
    months = [int(m) for m in months]
    return df.filter(~quoted(column).isin(months)) if months else df


def in_months(column: str, months: Iterable[int | None]) -> Column:
    """Always true or false: a NULL month is in the list when ``None`` is."""
    months = list(months)
    named = quoted(column).isin([int(m) for m in months if m is not None])
    return F.coalesce(named, F.lit(None in months))


def _month(df: DataFrame, column: str) -> Column:
    # An integer column is compared as it is, so the filter can prune partitions.
    return quoted(column) if dict(df.dtypes)[column] in ("int", "bigint") else to_whole(quoted(column))


def from_date(df: DataFrame, column: str, first_day: str) -> DataFrame:
    return df.filter(quoted(column) >= F.lit(first_day).cast("date"))


def outside(region: Column, tenant: Column, regions: Iterable[str], tenants: Iterable[str]) -> Column:
    """Region and tenant not among the excluded ones, whatever their case.

    A missing region (or tenant) drops the row as soon as any region (or tenant) is excluded.
    """
    return ~trim_lower(region).isin([r.lower() for r in regions]) & ~trim_lower(tenant).isin(
        [t.lower() for t in tenants]
    )


def required(df: DataFrame, *names: str) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [quoted(name).isNotNull() for name in names]))


def from_files(df: DataFrame, column: str, names: Iterable[str]) -> DataFrame:
    """Rows of the named source files; everything when none is named."""
    names = list(names)
    return df.filter(quoted(column).isin(names)) if names else df


def scan_predicate(
    date_column: str,
    *,
    file_column: str = "FileName",
    month: str | None = None,
    min_date: str | None = None,
    files: Iterable[str] = (),
) -> Column | None:
    """Filter for a raw scan: one ``YYYY-MM`` month, or else from ``min_date`` on, and named files.

    It compares the stored column with literals, so it reaches the file reader. ``None`` when nothing is asked.
    """
    tests = []
    if month:
        start, following = month_bounds(int(month.replace("-", "")))
        tests.append((quoted(date_column) >= start.isoformat()) & (quoted(date_column) < following.isoformat()))
    elif min_date:
        tests.append(quoted(date_column) >= min_date)
    files = list(files)
    if files:
        tests.append(quoted(file_column).isin(files))
    return reduce(lambda a, b: a & b, tests) if tests else None

