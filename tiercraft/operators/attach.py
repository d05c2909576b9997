"""Joining a large table to a smaller one without letting one key decide the run time.

A side is broadcast only after its rows and bytes were counted (for a derived side: while it is computed). A side
over the limit is joined by shuffle and merge, where Spark splits the partitions of hot keys while it runs. Both ways
give the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tiercraft.functions.columns import quoted
from tiercraft.session import shared_folder

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64

class Side(NamedTuple):
    """A table to attach, and whether every executor can hold it."""

    table: DataFrame
    small: bool


def _footprint(df: DataFrame) -> list[Column]:
    """Aggregates: rows and approximate bytes; text counts as it is, nested values by their JSON, others as fixed."""
    width = F.lit(ROW_OVERHEAD_BYTES)
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(quoted(field.name)), F.lit(0))
        elif isinstance(field.dataType, (StructType, ArrayType, MapType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(quoted(field.name)))), F.lit(0))
        else:
            width = width + 16
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")]


def _is_small(figures: Mapping[str, int]) -> bool:
    return figures["rows"] <= BROADCAST_ROWS and figures["bytes"] <= BROADCAST_BYTES


def measured(df: DataFrame) -> Side:
    """A table that is cheap to read twice, with its size."""
    return Side(df, _is_small(df.agg(*_footprint(df)).first().asDict()))


def settled(df: DataFrame) -> Side:
    """A derived table, computed once to a reliable checkpoint and measured on the way."""
    shared_folder(df.sparkSession)
    seen = Observation()
    table = df.observe(seen, *_footprint(df)).checkpoint(eager=True)
    figures = seen.get
    # A plan found to be empty while it runs may report nothing.
    return Side(table, _is_small(figures)) if "rows" in figures else measured(table)


def attach(
    base: DataFrame,
    side: Side,
    on: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """``base`` joined to ``side`` on equal columns ``on``; ``how`` is left, inner, left_semi or left_anti.

    The columns of ``base`` come first, in their order.
    """
    on = list(on)
    names = list(base.columns)
    if how in ("left", "inner"):
        names += [name for name in side.table.columns if name not in on]
    if side.small:
        joined = base.join(F.broadcast(side.table), on, how)
    else:
        # A merge join, which adaptive execution splits where a key of ``base`` (or no key) has a large share of the
        # rows; ``base`` runs once, and nothing has to be known about its keys beforehand.
        joined = base.join(side.table.hint("merge"), on, how)
    return joined.select(*map(quoted, names))
