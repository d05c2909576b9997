"""Data-quality figures, each taken in one pass over the data, or observed by a job that reads or writes it anyway."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tiercraft.functions.columns import quoted


def unique_id(df: DataFrame, name: str, approximate: bool = False) -> DataFrame:
    """Rows and distinct ids. ``approximate`` trades exactness for one small sketch per task."""
    distinct = F.approx_count_distinct(quoted(name)) if approximate else F.count_distinct(quoted(name))
    return df.agg(F.count(F.lit(1)).alias("row_count"), distinct.alias("distinct_ids"))


def null_after_cast(df: DataFrame, raw: Column, parsed: Column) -> DataFrame:
    """Rows whose parsed value is missing, and those of them that did have text."""
    missing = parsed.isNull()
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(missing).alias("null_after_cast"),
        F.count_if(missing & raw.isNotNull()).alias("lost_by_cast"),
    )


def text_null(df: DataFrame, name: str) -> DataFrame:
    """Rows that hold the word NULL as text."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.upper(quoted(name)) == "NULL").alias("text_null")
    )


def row_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in, rows out and the difference."""
    sides = [
        df.agg(F.count(F.lit(1)).alias("n")).select(
            (F.col("n") if first else F.lit(0)).alias("rows_in"), (F.lit(0) if first else F.col("n")).alias("rows_out")
        )
        for df, first in ((before, True), (after, False))
    ]
    total = sides[0].unionByName(sides[1]).agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))
    return total.withColumn("rows_dropped", F.col("rows_in") - F.col("rows_out"))


def reject_rate(matched: DataFrame, rejects: DataFrame, reason: str) -> DataFrame:
    """Rows per outcome: the matched ones, and the rejects by reason."""
    kept = matched.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("matched").alias("outcome"), "row_count")
    lost = rejects.groupBy(quoted(reason).alias("outcome")).agg(F.count(F.lit(1)).alias("row_count"))
    return kept.unionByName(lost)


class Figures:
    """Figures that jobs report about the rows that pass them; they are known once the job has run."""

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def observed(self, df: DataFrame, *figures: Column) -> DataFrame:
        """The same rows; ``figures`` are aggregates with a name, none of them distinct."""
        self._seen.append(Observation())
        return df.observe(self._seen[-1], *figures)

    def rows_in(self, df: DataFrame) -> DataFrame:
        return self.observed(df, F.count(F.lit(1)).alias("rows_in"))

    def rows_out(self, df: DataFrame, *more: Column) -> DataFrame:
        return self.observed(df, F.count(F.lit(1)).alias("rows_out"), *more)

    def outcomes(self, df: DataFrame, found: Column) -> DataFrame:
        """Rows with and without a person."""
        return self.observed(df, F.count_if(found).alias("rows_matched"), F.count_if(~found).alias("rows_rejected"))

    def values(self) -> dict[str, int]:
        """All figures; a plan found to be empty while it runs may report none. With rows in and out, the difference."""
        made = {name: value for one in self._seen for name, value in one.get.items()}
        if {"rows_in", "rows_out"} <= made.keys():
            made["rows_dropped"] = made["rows_in"] - made["rows_out"]
        return made
