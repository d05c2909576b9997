"""Adding attributes from headcount, lookup and entity tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.functions.columns import quoted, trimmed
from tiercraft.operators.attach import Side, attach, settled
from tiercraft.operators.dedupe import unique_lookup

# What to call a country or division that no lookup knows.
NO_COUNTRY = "No Country"
NO_DIVISION = "Others"
# Headcount columns added to usage rows: (added, headcount column).
HEADCOUNT = (
    ("HCBusinessUnit", "HCBusinessUnit"),
    ("HCBusinessUnitCode", "HCBusinessUnitCode"),
    ("HCDivision", "HCDivision"),
    ("HCJobTitle", "HCJobTitle"),
    ("HCOffice", "HCOffice"),
    ("HCTalentSegment", "HCTalentSegment"),
    ("HCMonthNo", "Month_No"),
    ("HCOktaUserCountry", "OktaUserCountry"),
    ("HCDivisionINC", "HCDivisionINC"),
)


def headcount_attach(
    df: DataFrame, headcount: DataFrame, month: str, email: str, full_email: str, default: str = NO_DIVISION
) -> DataFrame:
    """Each attribute from the month's headcount row of ``email``, else of ``full_email``.

    Joins on the month number and the address, not on their concatenation. Of several rows for one address and
    month the one with the lowest employee number counts.
    """
    book = settled(_headcount_book(headcount))

    def look_up(rows: DataFrame, address: str, card: str) -> DataFrame:
        return attach(rows, Side(_renamed(book.table, month, address, card), book.small), [month, address], "left")

    return _with_cards(df, month, email, full_email, default, look_up)


def headcount_of_people(
    people: DataFrame, headcount: DataFrame, month: str, email: str, full_email: str, default: str = NO_DIVISION
) -> DataFrame:
    """:func:`headcount_attach` for a table of people, which has few rows per address and needs no size check."""
    book = _headcount_book(headcount)

    def look_up(rows: DataFrame, address: str, card: str) -> DataFrame:
        return rows.join(_renamed(book, month, address, card), [month, address], "left")

    return _with_cards(people, month, email, full_email, default, look_up)


def _headcount_book(headcount: DataFrame) -> DataFrame:
    """One card of attributes per (month, address)."""
    card = F.struct(*[F.col(source).alias(added) for added, source in HEADCOUNT]).alias("card")
    keyed = headcount.filter(F.col("OktaUserEmail").isNotNull() & F.col("Month_No").isNotNull())
    least = F.min(F.struct("OktaUserEmployeeNumber", card)).getField("card").alias("card")
    return keyed.groupBy("Month_No", "OktaUserEmail").agg(least)


def _renamed(book: DataFrame, month: str, address: str, card: str) -> DataFrame:
    return book.toDF(month, address, card)


def _with_cards(
    df: DataFrame,
    month: str,
    email: str,
    full_email: str,
    default: str,
    look_up: Callable[[DataFrame, str, str], DataFrame],
) -> DataFrame:
    found = look_up(look_up(df, email, "_short_card"), full_email, "_full_card")
    added = {
        name: F.coalesce(F.col("_short_card").getField(name), F.col("_full_card").getField(name))
        for name, _ in HEADCOUNT
    }
    added["HCDivisionINC"] = F.coalesce(added["HCDivisionINC"], F.lit(default))
    return found.select(*map(quoted, df.columns), *[value.alias(name) for name, value in added.items()])


def load_lookup(table: DataFrame, key: str = "Country", value: str = "DisplayName") -> DataFrame:
    """A lookup's two columns, named ``lookup_key`` and ``lookup_value``."""
    return table.select(quoted(key).alias("lookup_key"), quoted(value).alias("lookup_value"))


def lookup_normalize(
    df: DataFrame, source: str, lookup: DataFrame, output: str, default: str | None = None
) -> DataFrame:
    """``output`` is the lookup's value for ``source``, or ``default``. A key listed twice adds no rows."""
    side = unique_lookup(lookup, "lookup_key", "lookup_value").withColumnRenamed("lookup_key", source)
    found = attach(df, settled(side), [source], "left")
    value = F.col("lookup_value") if default is None else F.coalesce(F.col("lookup_value"), F.lit(default))
    return found.select(*[quoted(c) for c in df.columns if c != output], value.alias(output))


def trimmed_lookup(table: DataFrame, key: str, value: str) -> DataFrame:
    return table.select(trimmed(quoted(key)).alias("lookup_key"), trimmed(quoted(value)).alias("lookup_value"))


def present_or(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))
