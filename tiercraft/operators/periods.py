"""Months present in a table, and the ledger of closed months."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercraft.functions.columns import quoted, to_whole, trim_lower

# Fixed value: ledger rows of this product close a month for every product.
EVERY_PRODUCT = "all"


def months_of(df: DataFrame, column: str) -> DataFrame:
    """The distinct months of a table, in order."""
    month = to_whole(quoted(column)).alias("month_no")
    return df.select(month).filter(F.col("month_no").isNotNull()).distinct().orderBy("month_no")


def distinct_months(df: DataFrame, column: str) -> list[int]:
    """The months as a list: a handful of numbers, the one thing that crosses to the driver."""
    return [row[0] for row in months_of(df, column).collect()]


def frozen_rows(ledger: DataFrame, product: str) -> DataFrame:
    """Months the ledger closes for ``product``."""
    mine = trim_lower(quoted("product")).isin(product.strip().lower(), EVERY_PRODUCT)
    return months_of(ledger.filter(mine), "Month_No")


def frozen_months(ledger: DataFrame, product: str) -> list[int]:
    return [row[0] for row in frozen_rows(ledger, product).collect()]


def batch_profile(df: DataFrame, column: str, skip: Iterable[int]) -> DataFrame:
    """Months to skip and the newest month of a batch."""
    return df.agg(F.max(to_whole(quoted(column))).alias("batch_max_month")).withColumn(
        "months_to_skip", F.array(*[F.lit(int(m)) for m in skip]).cast("array<int>")
    )
