"""Row-level merge for catalogs whose table format offers ``MERGE INTO`` (Iceberg, Delta and the like).

The warehouse's own Parquet tables are not of that kind: ``Warehouse.upsert`` rewrites the months it touches. A
deployment that has such a format registers its tables in the catalog and calls ``merge`` with the same arguments. No
such format is part of Spark itself, so here the statement is built and parsed, and not run by any query.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercraft.functions.columns import quoted
from tiercraft.sources.store import upsert_source


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def merge_statement(target: str, source: str, columns: Sequence[str], keys: Sequence[str], month_col: str | None = None, frozen: Iterable[int] = ()) -> str:
    """Rows of ``source`` replace those of ``target`` with the same keys; new keys are added; closed months stay."""
    on = " AND ".join(f"t.{_name(k)} = s.{_name(k)}" for k in keys)
    closed = ", ".join(str(int(m)) for m in frozen)
    is_open = f" AND (t.{_name(month_col)} IS NULL OR t.{_name(month_col)} NOT IN ({closed}))" if closed else ""
    changes = ", ".join(f"t.{_name(c)} = s.{_name(c)}" for c in columns if c not in keys)
    update = f" WHEN MATCHED{is_open} THEN UPDATE SET {changes}" if changes else ""
    names, values = ", ".join(map(_name, columns)), ", ".join(f"s.{_name(c)}" for c in columns)
    return f"MERGE INTO {target} t USING {source} s ON {on}{update} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"


def merge(df: DataFrame, target: str, keys: Sequence[str], order: Sequence[str], month_col: str | None = None, frozen: Iterable[int] = ()) -> None:
    """Upsert into a table of such a format: one source row a key, no NULL keys, rows of closed months left out."""
    frozen = list(frozen)
    source = upsert_source(df, keys, order)
    if month_col is not None and frozen:
        source = source.filter(F.coalesce(~quoted(month_col).isin(frozen), F.lit(True)))
    source.createOrReplaceTempView("merge_source")
    try:
        df.sparkSession.sql(merge_statement(target, "merge_source", source.columns, keys, month_col, frozen))
    finally:
        df.sparkSession.catalog.dropTempView("merge_source")
