"""Dates, and months written as ``YYYYMM`` numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiercraft.functions.columns import trimmed

# Day-first text is tried before month-first text.
DATE_FORMATS = ("dd/MM/yyyy", "MM/dd/yyyy")


def month_no(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_start(month: Column) -> Column:
    """First day of a ``YYYYMM`` month; NULL when there is no such month."""
    digits = F.lpad((month.cast("long") * 100 + 1).cast("string"), 8, "0")
    return F.try_to_date(digits, "yyyyMMdd")


def month_after(month_text: Column) -> Column:
    """First day after a ``YYYY-MM`` month: its exclusive upper bound."""
    return F.add_months(F.try_to_date(F.concat(month_text, F.lit("-01"))), 1)


def parse_date(value: Column) -> Column:
    """First reading that works: ISO, day-first, month-first, a timestamp's day."""
    text = trimmed(value)
    readings = [F.try_to_date(text)]
    readings += [F.try_to_date(text, fmt) for fmt in DATE_FORMATS]
    readings.append(parse_timestamp(text).cast("date"))
    return F.coalesce(*readings)


def parse_timestamp(value: Column) -> Column:
    return F.try_to_timestamp(trimmed(value))
