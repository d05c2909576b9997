"""Versioned tables: immutable folders of files, a manifest for each version, and one pointer.

A table is a view under its own name. The view reads one *version*: an external catalog table whose partitions are the
folders that the version's manifest lists. A write puts new folders beside the old ones, then the manifest and the
version's table, and last replaces the view. That one catalog change is the commit: however many months a write
replaces and drops, readers see all of it or none, and a writer that fails before it leaves the table as it was.

The partitions are (month, piece), or (piece) for a table without months: an append adds a piece, a replaced month
gets one new piece. A table may have an index of its keys: beside every data folder one with the keys' hashes, from
which the months that hold given keys are found without reading the table.

Manifests are kept; of the versions' tables and folders only those of the last ``KEPT`` versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tiercraft.functions.columns import quoted

#: Versions whose folders are kept, the current one among them: readers that began before a write can end.
KEPT = 3
VERSION = "tiercraft.version"
PIECE, KEY_HASH = "_piece", "_key_hash"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Piece:
    """Rows of one month (of no month, or of a table without months: None) in a folder, and the folder of their keys."""

    month: int | None
    tag: str
    data: str
    keys: str | None = None


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: str
    month_col: str | None = None
    keys: tuple[str, ...] = ()
    pieces: tuple[Piece, ...] = ()
    notes: dict = field(default_factory=dict)

    @property
    def columns(self) -> StructType:
        """All columns, the month last."""
        return StructType.fromJson(json.loads(self.schema))

    @property
    def months(self) -> set[int | None]:
        return {p.month for p in self.pieces}

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of_json(text: str) -> Manifest:
        read = json.loads(text)
        return Manifest(**{**read, "keys": tuple(read["keys"]), "pieces": tuple(Piece(**p) for p in read["pieces"])})


def schema_json(columns: StructType, month_col: str | None, nullable: bool = True) -> str:
    """Columns with the month last; ``nullable`` drops NOT NULL, which only declared tables have."""
    fields = [StructField(f.name, f.dataType, True if nullable else f.nullable) for f in columns.fields]
    fields.sort(key=lambda f: f.name == month_col)
    return json.dumps(StructType(fields).jsonValue())


class Versions:
    """The versions of the tables of one catalog schema (database)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._hadoop = spark.sparkContext._jsc.hadoopConfiguration()

    # -- reading ------------------------------------------------------------------------------------------

    def current(self, name: str) -> Manifest | None:
        """The manifest that the view points to; None for a table that is not versioned."""
        if not self.spark.catalog.tableExists(name):
            return None
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        return self.load(name, int(found[VERSION])) if VERSION in found else None

    def load(self, name: str, version: int) -> Manifest | None:
        path = self._path(f"{self.root(name)}/manifests/{version}.json")
        files = path.getFileSystem(self._hadoop)
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return Manifest.of_json(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, name: str, manifest: Manifest) -> DataFrame:
        return self.spark.table(self._table(name, manifest.version)).select(*map(quoted, manifest.columns.names))

    def read_keys(self, name: str, manifest: Manifest) -> DataFrame:
        """(key hash, month) of every row, from the index."""
        return self.spark.table(self._table(name, manifest.version, "k")).drop(PIECE)

    def key_hash(self, keys: Sequence[str]):
        return F.xxhash64(*map(quoted, keys)).alias(KEY_HASH)

    # -- writing ------------------------------------------------------------------------------------------

    def write(self, name: str, df: DataFrame, manifest: Manifest) -> list[Piece]:
        """New pieces with the rows of ``df``, which has the manifest's columns; a hot month gets several files."""
        tag = uuid.uuid4().hex[:12]
        folder, month = f"{self.root(name)}/{tag}", manifest.month_col
        try:
            if month is None:
                df.write.parquet(folder)
                pieces = [Piece(None, tag, folder)]
            else:
                df.hint("rebalance", month).write.partitionBy(month).parquet(folder)
                pieces = [Piece(m, tag, f"{folder}/{part}") for part, m in self._parts(folder)]
            return self.index(name, manifest, pieces, folder) if manifest.keys and pieces else pieces
        except BaseException:
            self.delete([folder, f"{folder}-keys"])
            raise

    def index(self, name: str, manifest: Manifest, pieces: list[Piece], folder: str) -> list[Piece]:
        """The same pieces with an index of their keys, made from the key columns of what was just written."""
        month = manifest.month_col
        rows = self.spark.read.schema(manifest.columns).option("basePath", folder).parquet(folder)
        rows.select(self.key_hash(manifest.keys), quoted(month)).hint("rebalance", month).write.partitionBy(month).parquet(f"{folder}-keys")
        return [replace(p, keys=f"{folder}-keys/{p.data.rpartition('/')[2]}") for p in pieces]

    def index_all(self, name: str, manifest: Manifest, keys: Sequence[str]) -> Manifest:
        """A table's first index over the columns ``keys``: one pass over the key columns of all months."""
        folder, month = f"{self.root(name)}/{uuid.uuid4().hex[:12]}-keys", manifest.month_col
        if manifest.pieces:
            rows = self.spark.table(self._table(name, manifest.version)).select(self.key_hash(keys), quoted(month), PIECE)
            rows.write.partitionBy(PIECE, month).parquet(folder)
        pieces = [replace(p, keys=f"{folder}/{PIECE}={p.tag}/{p.data.rpartition('/')[2]}") for p in manifest.pieces]
        return replace(manifest, keys=tuple(keys), pieces=tuple(pieces))

    def commit(self, name: str, manifest: Manifest) -> None:
        """The manifest and the version's tables first; then the view is replaced, which is the commit."""
        self._put(f"{self.root(name)}/manifests/{manifest.version}.json", manifest.to_json())
        columns, month = manifest.columns, manifest.month_col
        self._create(self._table(name, manifest.version), columns, month, manifest.pieces, [p.data for p in manifest.pieces])
        if manifest.keys:
            hashes = StructType([StructField(KEY_HASH, LongType()), *[f for f in columns.fields if f.name == month]])
            self._create(self._table(name, manifest.version, "k"), hashes, month, manifest.pieces, [p.keys for p in manifest.pieces])
        self.point(name, manifest)
        self.expire(name, manifest)

    def point(self, name: str, manifest: Manifest) -> None:
        chosen = ", ".join(f"`{c}`" for c in columns_text(manifest.columns.names))
        select = f"SELECT {chosen} FROM {self._table(name, manifest.version)}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{manifest.version}') AS {select}")

    def expire(self, name: str, manifest: Manifest) -> None:
        """Tables and folders that only the version before the kept ones has."""
        last = self.load(name, manifest.version - KEPT)
        if last is None:
            return
        for kind in ("v", "k"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name, last.version, kind)}")
        held = {f for k in range(KEPT) if (m := self.load(name, manifest.version - k)) for p in m.pieces for f in (p.data, p.keys)}
        self.delete({f for p in last.pieces for f in (p.data, p.keys)} - held - {None})

    # -- helpers ------------------------------------------------------------------------------------------

    def root(self, name: str) -> str:
        schema, _, short = name.partition(".")
        place = self.spark.catalog.getDatabase(schema.strip("`")).locationUri
        return f"{place.rstrip('/')}/{short}__data"

    def _table(self, name: str, version: int, kind: str = "v") -> str:
        return f"{name}__{kind}{version}"

    def _create(self, table: str, columns: StructType, month: str | None, pieces: Sequence[Piece], folders: Sequence[str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # of a commit that failed
        ddl = self.spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromJson(StructType([*columns.fields, StructField(PIECE, StringType())]).json()).toDDL()
        parts = [*([month] if month else []), PIECE]
        self.spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)}) LOCATION '{self.root(table)}'")
        specs = []
        for piece, folder in zip(pieces, folders, strict=True):
            of_month = f"`{month}` = {'null' if piece.month is None else piece.month}, " if month else ""
            specs.append(f"PARTITION ({of_month}`{PIECE}` = '{piece.tag}') LOCATION '{folder}'")
        if specs:
            self.spark.sql(f"ALTER TABLE {table} ADD {' '.join(specs)}")

    def _parts(self, folder: str) -> list[tuple[str, int | None]]:
        """Partition folders by name, and their months."""
        path = self._path(folder)
        names = [s.getPath().getName() for s in path.getFileSystem(self._hadoop).listStatus(path) if s.isDirectory()]
        values = [(n, n.partition("=")[2]) for n in sorted(names) if "=" in n]
        return [(n, None if v == NO_MONTH else int(v)) for n, v in values]

    def delete(self, folders: Iterable[str]) -> None:
        for folder in folders:
            path = self._path(folder)
            path.getFileSystem(self._hadoop).delete(path, True)

    def _put(self, file: str, text: str) -> None:
        path = self._path(file)
        out = path.getFileSystem(self._hadoop).create(path, True)
        out.write(text.encode())
        out.close()

    def _path(self, text: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)


def columns_text(names: Iterable[str]) -> list[str]:
    return [n.replace("`", "``") for n in names]
