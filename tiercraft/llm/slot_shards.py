"""Sharding by fixed virtual slots: records hash into thousands of slots, a versioned map says which shard has a slot.

A record's slot is a hash of its key and never changes; only the map does. Version 1 places the slots, heaviest first,
each on the lightest shard, by the bytes that Spark adds up per slot. Later versions are edits of the map before: a
rebalancing moves few slots from heavy to light shards, one more shard takes slots only into itself. The law is `bytes`:
shards are nearly equal in size.

A key whose records are more than a sixteenth of a shard is dealt over several units of its slot, so that neither a
shard nor a task holds all of it; there are fewer such keys than 16 for each shard, which bounds what is broadcast. All
other keys are whole: their records are in one slot. The map has a row a unit: the slots, and what hot keys add.

Placing and editing are folds over the units, a few thousand rows whatever the input; records take part in sums by slot
and one narrow shuffle that numbers them within their unit. Everything is DataFrame functions.

Defined results: NULL is one key, as if empty text. A record without text has 16 bytes. Repeated rows get places of
their own. A record larger than a shard's share is a shard's whole load or more. An empty table gives an empty map and an
empty table. Extra columns are carried, whatever their names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiercraft.llm._carry import quoted, row_struct, unpacked
from tiercraft.session import shared_folder, stage

#: What a record takes besides its text.
RECORD_BYTES = 16
LAW = "bytes"
MAP_SCHEMA = "version int, slot int, unit int, shard int, bytes long, records long, first long"


@dataclass(frozen=True)
class Settings:
    shards: int = 40
    slots: int = 4096
    #: A key over 1 / hot of a shard is dealt over several units.
    hot: int = 16


def slot_of(key: Column, slots: int) -> Column:
    """The fixed slot of a key: 32 bits of a hash of its text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % slots).cast("int")


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text, none for NULL, and the record's own."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + RECORD_BYTES


def crc_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def slotted(docs: DataFrame, size: Column, key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """Records with slot and unit: (key, size, number, slot, unit, row), staged; ``size`` is over the columns of ``docs``."""
    rows = docs.select(quoted(key).alias("key"), size.alias("size"), slot_of(quoted(key), settings.slots).alias("slot"), row_struct(docs).alias("row"))
    # The number tells records of one key apart; it is written, so that every later read sees the same one.
    rows = stage(rows.withColumn("number", F.monotonically_increasing_id()), "slot-records")
    return rows.join(F.broadcast(_hot_keys(rows, settings)), (F.col("slot") == F.col("hot_slot")) & F.col("key").eqNullSafe(F.col("hot_key")), "left").select(
        "key", "size", "number", "slot", F.when(F.col("units").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("number"), "units")).cast("int").alias("unit"), "row"
    )


def _hot_keys(rows: DataFrame, settings: Settings) -> DataFrame:
    """Keys with several records and more than a sixteenth of a shard, and over how many units they go.

    Looked for in slots that are as heavy; both are fewer than ``shards * hot``, as each has more than that share.
    """
    by_slot = stage(rows.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records")), "slot-bytes")
    total = by_slot.agg(F.sum("bytes")).first()[0] or 0
    limit = max(1, total // (settings.shards * settings.hot))
    heavy = by_slot.where((F.col("bytes") > limit) & (F.col("records") > 1)).select("slot")
    keys = rows.join(F.broadcast(heavy), "slot").groupBy(F.col("slot").alias("hot_slot"), F.col("key").alias("hot_key")).agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))
    hot = keys.where((F.col("bytes") > limit) & (F.col("records") > 1))
    return stage(hot.select("hot_slot", "hot_key", F.ceil(F.col("bytes") / limit).cast("bigint").alias("units")), "slot-hot-keys")


def units_of(rows: DataFrame) -> DataFrame:
    """Bytes and records of every unit."""
    return rows.groupBy("slot", "unit").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))


def _units(rows: DataFrame) -> DataFrame:
    """All units in one row, heaviest first."""
    unit = F.struct((-F.col("bytes")).alias("weight"), "slot", "unit", "bytes", "records", *[c for c in ("shard",) if c in rows.columns])
    return rows.agg(F.array_sort(F.collect_list(unit)).alias("units"))


def _versioned(placed: DataFrame, version: int) -> DataFrame:
    """Columns of a map; ``first`` is the number of records in the shard's units before this one."""
    before = Window.partitionBy("shard").orderBy("slot", "unit").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("records").over(before), F.lit(0)).cast("bigint")
    return placed.select(F.lit(version).alias("version"), "slot", "unit", F.col("shard").cast("int").alias("shard"), "bytes", "records", first.alias("first"))


def _argmin(values: Column) -> Column:
    return (F.array_position(values, F.array_min(values)) - 1).cast("int")


def place(units: DataFrame, shards: int) -> DataFrame:
    """Version 1 of a map: the heaviest unit first, each to the shard with the fewest bytes (the lowest of equals)."""
    start = F.struct(F.array_repeat(F.lit(0).cast("bigint"), shards).alias("loads"), F.array().cast("array<int>").alias("taken"))

    def take(state: Column, unit: Column) -> Column:
        to = _argmin(state["loads"])
        loads = F.transform(state["loads"], lambda load, i: load + F.when(i == to, unit["bytes"]).otherwise(F.lit(0)))
        return F.struct(loads.alias("loads"), F.concat(state["taken"], F.array(to)).alias("taken"))

    folded = _units(units).select("units", F.aggregate("units", start, take)["taken"].alias("taken"))
    placed = folded.select(F.explode(F.arrays_zip("units", "taken")).alias("u")).select("u.units.*", F.col("u.taken").alias("shard"))
    return _versioned(placed, 1)


def edit(placed: DataFrame, shards: int, version: int, into: int | None = None, moves: int = 500) -> DataFrame:
    """The next version: up to ``moves`` units change their shard, all others stay.

    A move takes, from the heaviest shard to the lightest, the unit that comes nearest to halving their difference, and
    ends where none makes it smaller. With ``into`` only that shard receives, up to an equal share.
    """
    # Fixed through the fold: weight and place of every unit. Changed by it: shard of every unit and bytes of every shard.
    rows = placed.select("slot", "unit", "bytes", "records", "shard")
    one = _units(rows).withColumn("loads", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), _load))
    one = one.withColumn("share", F.floor(F.aggregate("loads", F.lit(0).cast("bigint"), lambda a, b: a + b) / shards))
    start = F.struct("loads", F.transform("units", lambda u: u["shard"]).alias("shards"))

    def move(state: Column, _: Column) -> Column:
        loads = state["loads"]
        source = (F.array_position(loads, F.array_max(loads)) - 1).cast("int")
        target = _argmin(loads) if into is None else F.lit(into)
        gap = F.get(loads, source) - F.get(loads, target)
        fits = lambda b: b < gap if into is None else (b < gap) & (F.get(loads, target) + b <= F.col("share"))
        near = F.transform("units", lambda u, i: F.when((F.get(state["shards"], i) == source) & fits(u["bytes"]), F.struct(F.abs(2 * u["bytes"] - gap).alias("off"), i.alias("i"), u["bytes"].alias("bytes"))))
        best = F.array_min(near)
        changed = F.transform(loads, lambda load, i: load + F.when(i == target, best["bytes"]).when(i == source, -best["bytes"]).otherwise(F.lit(0)))
        shards_now = F.transform(state["shards"], lambda s, i: F.when(i == best["i"], target).otherwise(s))
        return F.when(best.isNull() | (source == target), state).otherwise(F.struct(changed.alias("loads"), shards_now.alias("shards")))

    folded = one.select("units", F.aggregate(F.sequence(F.lit(1), F.lit(moves)), start, move)["shards"].alias("shards"))
    moved = folded.select(F.explode(F.arrays_zip("units", "shards")).alias("u"))
    return _versioned(moved.select("u.units.slot", "u.units.unit", "u.units.bytes", "u.units.records", F.col("u.shards").alias("shard")), version)


def _load(shard: Column) -> Column:
    own = F.filter("units", lambda u: u["shard"] == shard)
    return F.aggregate(own, F.lit(0).cast("bigint"), lambda a, u: a + u["bytes"])


class ShardMaps:
    """The versions of a map in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/shard-map-{uuid.uuid4().hex}"

    def save(self, placed: DataFrame, version: int) -> DataFrame:
        """Written once; an existing version is an error."""
        placed.drop("version").coalesce(1).write.mode("error").parquet(f"{self.folder}/version={version}")
        return self.load(version)

    def load(self, version: int | None = None) -> DataFrame:
        """One version, the latest by default."""
        every = self.spark.read.schema(MAP_SCHEMA).parquet(self.folder)
        version = every.agg(F.max("version")).first()[0] if version is None else version
        return every.where(F.col("version") == version)

    def latest(self) -> int:
        return self.spark.read.schema(MAP_SCHEMA).parquet(self.folder).agg(F.max("version")).first()[0] or 0

    def rebalance(self, units: DataFrame, shards: int) -> DataFrame:
        """The next version, by what the units hold now; units the map lacks start where their slot is, or by number."""
        version = self.latest()
        old = self.load(version)
        home = old.where("unit = 0").select("slot", F.col("shard").alias("home"))
        now = units.join(F.broadcast(old.select("slot", "unit", "shard")), ["slot", "unit"], "left").join(F.broadcast(home), "slot", "left")
        now = now.select("slot", "unit", "bytes", "records", F.coalesce("shard", "home", F.col("slot") % shards).alias("shard"))
        return self.save(edit(now, shards, version + 1), version + 1)

    def grow(self, shards: int) -> DataFrame:
        """The next version with one shard more than ``shards``, which takes units only into itself."""
        version = self.latest()
        return self.save(edit(self.load(version), shards + 1, version + 1, into=shards), version + 1)


def located(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Where each record is: (row, size, shard, position, virtual_slot, unit)."""
    in_unit = Window.partitionBy("slot", "unit").orderBy("key", "number")
    numbered = rows.withColumn("in_unit", F.row_number().over(in_unit) - 1)
    joined = numbered.join(F.broadcast(placed.select("slot", "unit", "shard", "first")), ["slot", "unit"])
    return joined.select("row", "size", "shard", (F.col("first") + F.col("in_unit")).alias("position"), F.col("slot").alias("virtual_slot"), "unit")


def assign(docs: DataFrame, size: Column, key: str = "doc_id", settings: Settings = Settings(), maps: ShardMaps | None = None) -> DataFrame:
    """Every record's shard, position within it (gapless from 0) and virtual slot; ``row`` has the columns of ``docs``.

    Without ``maps`` version 1 of a new map is placed; maps that exist go on with a rebalanced version.
    """
    rows = slotted(docs, size, key, settings)
    units = stage(units_of(rows), "slot-units")
    if maps is None:
        placed = ShardMaps(docs.sparkSession).save(place(units, settings.shards), 1)
    else:
        placed = maps.rebalance(units, settings.shards)
    return located(rows, placed)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """doc_id, size, crc of the text, law, shard, position in it as ``slot``, and the virtual slot; texts are read once."""
    narrow = docs.select(quoted(key).alias("doc_id"), size_of(quoted(text)).alias("size"), crc_of(quoted(text)).alias("text_crc32"))
    placed = assign(narrow, F.col("size"), "doc_id", settings)
    doc_id, _, crc = unpacked(narrow)
    return placed.select(
        doc_id, "size", crc, F.lit(LAW).alias("law"), "shard", F.col("position").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"
    )


#: The query in SQL, for tables without hot keys: CRC-32 byte by byte, slots, and a recursion over the units.
CHECK = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
sized AS MATERIALIZED (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + {RECORD_BYTES} AS size,
    ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT % 4096 AS virtual_slot,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table),
units AS MATERIALIZED (
  SELECT virtual_slot, sum(size)::BIGINT AS bytes, row_number() OVER (ORDER BY sum(size) DESC, virtual_slot) AS k FROM sized GROUP BY virtual_slot),
placed(k, loads, shard) AS (
  SELECT 0::BIGINT, list_transform(range(40), lambda i: 0::BIGINT), NULL::BIGINT
  UNION ALL
  SELECT u.k, list_transform(range(40), lambda i: p.loads[i + 1] + CASE WHEN i + 1 = list_position(p.loads, list_min(p.loads)) THEN u.bytes ELSE 0 END),
    list_position(p.loads, list_min(p.loads)) - 1
  FROM placed p JOIN units u ON u.k = p.k + 1)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY virtual_slot, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard, virtual_slot::INTEGER AS virtual_slot
FROM sized JOIN units USING (virtual_slot) JOIN placed USING (k)
"""
