"""Writing warehouse tables: overwrite, append, keyed upsert, month replacement, closed months.

Tables are versioned (``sources/versions``): a write makes new files for the months it touches, and one change of the
table's view commits all of them. Other months are neither read nor written. One writer per table.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tiercraft.functions.columns import quoted
from tiercraft.operators.attach import attach, measured, settled
from tiercraft.operators.dedupe import keep_one
from tiercraft.operators.filters import in_months, without_months
from tiercraft.operators.periods import frozen_months
from tiercraft.session import compiled_methods, stage, staging
from tiercraft.sources.versions import Manifest, Versions, schema_json

# The ledger of closed months, and the note on months closed by a run.
LEDGER = "ingest_freeze_control"
LEDGER_SCHEMA = (
    "product string not null, Month_No int not null, frozen_at timestamp not null, frozen_by string, notes string"
)
CLOSE_NOTE = "Month-close auto-freeze"


class Warehouse:
    """The silver and gold tables, in one schema (database) each."""

    def __init__(self, spark: SparkSession, silver: str = "silver", gold: str = "gold", location: str | None = None):
        self.spark = spark
        compiled_methods(spark)
        self.schemas = {"silver": silver, "gold": gold}
        self.versions = Versions(spark)
        for schema in dict.fromkeys(self.schemas.values()):
            place = f" LOCATION '{location}/{schema}'" if location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`{place}")

    def name(self, table: str) -> str:
        """``gold.x`` or ``silver.x`` under this warehouse's schema names."""
        tier, _, short = table.partition(".")
        return f"{self.schemas[tier]}.{short}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        """The table as it is now; a frame made before a write goes on reading what it read."""
        manifest = self.versions.current(self.name(table))
        return self.spark.table(self.name(table)) if manifest is None else self.versions.read(self.name(table), manifest)

    def version(self, table: str) -> int:
        """The number of the last write; 0 while there is none."""
        manifest = self.versions.current(self.name(table))
        return 0 if manifest is None else manifest.version

    def changed_months(self, table: str, since: int | None) -> set[int | None] | None:
        """Months written or dropped after version ``since``; None where that version is not known: any may have changed."""
        now = self.versions.current(self.name(table))
        old = None if since is None else self.versions.load(self.name(table), since)
        if now is None or old is None:
            return None
        # A piece is its tag: an index that was added to it later is no change.
        return {month for month, _ in {(p.month, p.tag) for p in now.pieces} ^ {(p.month, p.tag) for p in old.pieces}}

    def notes(self, table: str) -> dict:
        """What writers have noted down with the table's current version."""
        manifest = self.versions.current(self.name(table))
        return {} if manifest is None else manifest.notes

    # -- whole tables -------------------------------------------------------------------------------------

    def overwrite(self, df: DataFrame, table: str, month_col: str | None = None, notes: dict | None = None) -> None:
        """Full load; the new columns replace the old ones. ``df`` may read the table itself.

        The rows are complete before the table changes, so a failing job leaves it as it was, whatever its columns.
        """
        old = self._adopted(table)
        made = Manifest(old.version + 1 if old else 1, schema_json(df.schema, month_col), month_col, notes={**(old.notes if old else {}), **(notes or {})})
        if old and old.keys and month_col and set(old.keys) <= set(df.columns):
            made = replace(made, keys=old.keys)
        pieces = self.versions.write(self.name(table), _guarded(df.select(*map(quoted, made.columns.names)), made), made)
        self.versions.commit(self.name(table), replace(made, pieces=tuple(pieces)))

    def _adopted(self, table: str) -> Manifest | None:
        """The current manifest; a plain table under this name is copied and takes part from then on."""
        name = self.name(table)
        manifest = self.versions.current(name)
        if manifest is not None or not self.spark.catalog.tableExists(name):
            return manifest
        months = [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]
        rows = self.spark.table(name)
        month_col = months[0] if months else None
        made = Manifest(1, schema_json(rows.schema, month_col), month_col)
        made = replace(made, pieces=tuple(self.versions.write(name, rows, made)))
        self.spark.sql(f"ALTER TABLE {name} RENAME TO {name}__before")
        self.versions.commit(name, made)
        return made

    def append(self, df: DataFrame, table: str, month_col: str | None = None) -> None:
        """Add rows; the first call creates the table."""
        old = self._adopted(table)
        if old is None:
            self.overwrite(df, table, month_col)
            return
        rows, made = self._aligned(df, old)
        pieces = self.versions.write(self.name(table), rows, made)
        self.versions.commit(self.name(table), replace(made, version=old.version + 1, pieces=(*old.pieces, *pieces)))

    # -- months -------------------------------------------------------------------------------------------

    def replace_months(
        self,
        df: DataFrame,
        table: str,
        month_col: str,
        months: Iterable[int | None],
        keys: Sequence[str] = (),
        frozen: Iterable[int] = (),
        notes: dict | None = None,
    ) -> int:
        """The listed months become what ``df`` holds for them, perhaps nothing; other months stay. One commit.

        ``None`` stands for the rows without a month. ``df`` may hold no month that is not listed: a stray row
        fails the job before anything is replaced.

        With ``keys`` no key is stored twice: a row whose key lies in a ``frozen`` month that is not listed is left
        out, and a key that lies in another month goes from there. Returns how many keys were left out.
        """
        months = list(dict.fromkeys(months))
        if not months:
            return 0
        listed = in_months(month_col, months)
        stray = F.raise_error(F.concat(F.lit("month outside the replaced ones: "), _text(quoted(month_col))))
        checked = df.withColumn(month_col, F.when(listed, quoted(month_col)).otherwise(stray.cast("int")))
        if not keys or not self.exists(table):
            self._change(checked, table, month_col, months, notes=notes)
            return 0
        with staging(self.spark):
            return self._move_in(stage(checked, "replace"), table, month_col, keys, set(months), set(frozen) - set(months), notes)

    def _move_in(
        self, source: DataFrame, table: str, month_col: str, keys: Sequence[str], months: set, frozen: set, notes: dict | None
    ) -> int:
        """``months`` become ``source`` without the keys of ``frozen`` months; other months lose the keys of ``source``."""
        held = self._holding(source, table, keys) - months
        source, left_out = self._without_closed(source, table, month_col, keys, held & frozen)
        others = held - frozen
        kept = attach(self.read(table).filter(in_months(month_col, others)), measured(source.select(*keys)), keys, "left_anti")
        self._change(kept.unionByName(source, allowMissingColumns=True), table, month_col, months | others, notes=notes)
        return left_out

    def _holding(self, source: DataFrame, table: str, keys: Sequence[str]) -> set[int | None]:
        """Months that hold keys of ``source``, from the key index; a table gets it when it is first asked for.

        Keys are looked up by hash, so a month may be named that holds none of them.
        """
        name = self.name(table)
        manifest = self._adopted(table)
        if not manifest.pieces:
            return set()
        if manifest.keys != tuple(keys):
            manifest = self.versions.index_all(name, manifest, keys)
            manifest = replace(manifest, version=manifest.version + 1)
            self.versions.commit(name, manifest)
        kinds = {f.name: f.dataType for f in manifest.columns.fields}
        asked = source.select(*[quoted(k).cast(kinds[k]).alias(k) for k in keys]).select(self.versions.key_hash(keys))
        index = self.versions.read_keys(name, manifest)
        found = attach(index, measured(asked), asked.columns, "left_semi").select(manifest.month_col).distinct()
        return {row[0] for row in found.collect()}

    def _without_closed(
        self, source: DataFrame, table: str, month_col: str, keys: Sequence[str], closed: set
    ) -> tuple[DataFrame, int]:
        """``source`` without the keys that do lie in the ``closed`` months, and how many those are."""
        if not closed:
            return source, 0
        there = self.read(table).filter(in_months(month_col, closed)).select(*keys)
        found = settled(attach(there, measured(source.select(*keys)), keys, "left_semi").distinct())
        return attach(source, found, keys, "left_anti"), found.table.count()

    def preserve_frozen(
        self,
        df: DataFrame,
        table: str,
        month_col: str,
        frozen: Iterable[int],
        keys: Sequence[str] = (),
        order: Sequence[str] = (),
        mode: str = "upsert_open",
        fixed_month: bool = True,
        notes: dict | None = None,
    ) -> int:
        """A daily write that leaves closed months as they are; returns how many keys were left out.

        ``mode="rebuild_open"``: all but the closed months becomes exactly ``df``, so open rows it lacks disappear.
        ``mode="upsert_open"``: ``df`` is upserted into the open months, for batches that hold only some rows.
        In both a key that lies in a closed month, unless its month is fixed, stays there and is not stored again.
        """
        frozen = [int(m) for m in frozen]
        open_rows = df.filter(~quoted(month_col).isin(frozen)) if frozen else df
        if mode == "upsert_open" or not frozen:
            return self.upsert(open_rows, table, keys, order, month_col, fixed_month=fixed_month, frozen=frozen, notes=notes)
        if not keys or fixed_month or not self.exists(table):
            self._change(open_rows, table, month_col, self.stored_months(table) - set(frozen), notes=notes)
            return 0
        with staging(self.spark):
            source = stage(upsert_source(open_rows, keys, order), "rebuild")
            closed = self._holding(source, table, keys) & set(frozen)
            source, left_out = self._without_closed(source, table, month_col, keys, closed)
            self._change(source, table, month_col, self.stored_months(table) - set(frozen), notes=notes)
            return left_out

    def overwrite_preserve_frozen(self, df: DataFrame, table: str, month_col: str, frozen: Iterable[int]) -> None:
        """Full load of the open months; closed months come from the table itself."""
        frozen = list(frozen)
        if frozen and self.exists(table):
            self.preserve_frozen(df, table, month_col, frozen, mode="rebuild_open")
        else:
            self.overwrite(without_months(df, month_col, frozen), table, month_col)

    def stored_months(self, table: str) -> set[int | None]:
        """The months a table has, from its manifest alone; None stands for rows without a month."""
        manifest = self._adopted(table)
        return set() if manifest is None else manifest.months

    # -- keys ---------------------------------------------------------------------------------------------

    def upsert(
        self,
        df: DataFrame,
        table: str,
        keys: Sequence[str],
        order: Sequence[str],
        month_col: str,
        fixed_month: bool = True,
        frozen: Sequence[int] = (),
        notes: dict | None = None,
    ) -> int:
        """Rows of ``df`` replace the table's rows with the same key; new keys are added.

        Of several source rows with one key the last by ``order`` counts. A NULL key fails the job. Only months
        that hold affected rows are read and rewritten: those of ``df``, and, unless a key determines its month
        (``fixed_month``), those where the table has the keys now, found in its key index.

        A key that lies in a ``frozen`` month stays there as it is: an arriving row with that key is left out, so no
        key is stored twice. Returns how many keys were left out.
        """
        source = upsert_source(df, keys, order)
        if not self.exists(table):
            self.overwrite(source, table, month_col, notes=notes)
            return 0
        with staging(self.spark):
            return self._upsert(stage(source, "upsert"), table, keys, month_col, fixed_month, set(frozen), notes)

    def _upsert(
        self, source: DataFrame, table: str, keys: Sequence[str], month_col: str, fixed_month: bool, frozen: set, notes: dict | None
    ) -> int:
        held = set() if fixed_month else self._holding(source, table, keys)
        source, left_out = self._without_closed(source, table, month_col, keys, held & frozen)
        touched = {row[0] for row in source.select(month_col).distinct().collect()} | held
        touched -= frozen
        kept = attach(self.read(table).filter(in_months(month_col, touched)), measured(source.select(*keys)), keys, "left_anti")
        # A key that has left its month may leave that month empty.
        self._change(kept.unionByName(source, allowMissingColumns=True), table, month_col, touched, notes=notes)
        return left_out

    # -- closed months ------------------------------------------------------------------------------------

    def frozen_months(self, product: str) -> list[int]:
        """Months closed for ``product``; none while there is no ledger."""
        ledger = f"gold.{LEDGER}"
        return frozen_months(self.read(ledger), product) if self.exists(ledger) else []

    def freeze_append(
        self, product: str, month: int, by: str | None = None, notes: str = CLOSE_NOTE, at: datetime | None = None
    ) -> bool:
        """Close a month once; False when it was closed already."""
        product = product.strip().lower()
        if int(month) in self.frozen_months(product):
            return False
        row = (product, int(month), at or datetime.now(UTC), by or f"{product}_pipeline", notes)
        self.append(self.spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1), f"gold.{LEDGER}")
        return True

    def create(self, table: str, ddl: str, month_col: str | None = None) -> None:
        """An empty table from its column list, if it is absent; rows that lack a NOT NULL column fail their write."""
        if not self.exists(table):
            columns = StructType.fromDDL(ddl)
            self.versions.commit(self.name(table), Manifest(1, schema_json(columns, month_col, nullable=False), month_col))

    def view(self, view: str, table: str, columns: Sequence[str]) -> None:
        """A view of some columns of a table, in this order."""
        names = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)} AS SELECT {names} FROM {self.name(table)}")

    # -- helpers ------------------------------------------------------------------------------------------

    def _change(self, df: DataFrame, table: str, month_col: str, months: Iterable[int | None], notes: dict | None = None) -> None:
        """In one commit: the listed months, and any that ``df`` holds, become the rows of ``df``; others stay."""
        old = self._adopted(table)
        if old is None:
            self.overwrite(df, table, month_col, notes=notes)
            return
        rows, made = self._aligned(df, old)
        pieces = self.versions.write(self.name(table), rows, made)
        gone = set(months) | {p.month for p in pieces}
        kept = [p for p in old.pieces if p.month not in gone]
        made = replace(made, version=old.version + 1, pieces=(*kept, *pieces), notes={**old.notes, **(notes or {})})
        self.versions.commit(self.name(table), made)

    def _aligned(self, df: DataFrame, old: Manifest) -> tuple[DataFrame, Manifest]:
        """``df`` in the table's columns, those it lacks NULL, and the manifest with columns that are new to the table."""
        fields = old.columns.fields
        have = {f.name.lower() for f in fields}
        new = [StructField(f.name, f.dataType) for f in df.schema.fields if f.name.lower() not in have]
        given = {name.lower() for name in df.columns}
        merged = StructType([*[f for f in fields if f.name != old.month_col], *new, *[f for f in fields if f.name == old.month_col]])
        made = replace(old, schema=json.dumps(merged.jsonValue()))
        values = [(quoted(f.name) if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in merged.fields]
        return _guarded(df.select(*values), made), made


def _guarded(df: DataFrame, manifest: Manifest) -> DataFrame:
    """NULL in a column that may hold none fails the job."""
    strict = [f for f in manifest.columns.fields if not f.nullable]
    empty = lambda f: F.raise_error(F.lit(f"NULL in column {f.name}")).cast(f.dataType)
    return df.withColumns({f.name: F.when(quoted(f.name).isNull(), empty(f)).otherwise(quoted(f.name)) for f in strict}) if strict else df


def upsert_source(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One source row per key, the last by ``order``; a NULL key is an error."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | quoted(key).isNull()
    first = quoted(keys[0])
    kind = dict(df.dtypes)[keys[0]]
    guarded = F.when(missing, F.raise_error(F.lit(f"NULL in merge key {list(keys)}")).cast(kind)).otherwise(first)
    checked = df.withColumn(keys[0], guarded)
    return keep_one(checked, [quoted(k) for k in keys], [quoted(o).desc_nulls_last() for o in order])


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("NULL"))
