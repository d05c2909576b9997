"""Where tables are: a registry of name, tier, key, month column and place, from which runs resolve what they read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from tiercraft.sources.scan import read_path


@dataclass(frozen=True)
class Table:
    """One table. ``name`` is what runs call it; ``at`` is its catalog name, or, with ``form``, a path of that format."""

    name: str
    tier: str
    at: str
    key: tuple[str, ...] = ()
    month_col: str | None = None
    form: str | None = None


class Catalogue:
    """Tables by tier and name.

    ``places`` overrides where single tables are, by ``tier.name``: a path, read as ``form`` of the table or Parquet, or
    a catalog name. An unknown name in it is an error, so that a misspelt override is not silently unused.
    """

    def __init__(self, spark: SparkSession, tables: Iterable[Table], places: Mapping[str, str] | None = None):
        self.spark = spark
        self.tables = {f"{t.tier}.{t.name}": t for t in tables}
        for name, at in (places or {}).items():
            if name not in self.tables:
                raise KeyError(f"no table {name} in the catalogue")
            table = self.tables[name]
            form = (table.form or "parquet") if "/" in at else None
            self.tables[name] = replace(table, at=at, form=form)

    def table(self, name: str) -> Table:
        return self.tables[name]

    def names(self, tier: str) -> list[str]:
        return [t.name for t in self.tables.values() if t.tier == tier]

    def exists(self, name: str) -> bool:
        table = self.tables[name]
        if table.form is None:
            return self.spark.catalog.tableExists(table.at)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.at)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def read(self, name: str) -> DataFrame:
        table = self.tables[name]
        return self.spark.table(table.at) if table.form is None else read_path(self.spark, table.at, table.form)

    def find(self, name: str) -> DataFrame | None:
        """The table, or None where it is not there."""
        return self.read(name) if name in self.tables and self.exists(name) else None
