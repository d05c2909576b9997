"""Whole rows carried in one struct, so that their column names cannot clash with those of the work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def row_struct(docs: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns but ``without`` as one struct; its fields are numbered."""
    return F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in without])


def unpacked(docs: DataFrame, row: str = "row", **instead: Column) -> list[Column]:
    """The columns of ``docs`` in their order, from the struct, or from ``instead`` by name."""
    return [(instead[c] if c in instead else F.col(row)[f"c{i}"]).alias(c) for i, c in enumerate(docs.columns)]
