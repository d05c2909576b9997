"""One row out of several, always the same one whatever order the rows come in.

Two narrow steps. ``rank() = 1`` over the key and the order columns lets Spark keep only each task's best rows per key
before the shuffle, so a key with a large share of the rows arrives as a few rows per task. Of the rows that are still
equal the least by all columns is an aggregate (a minimum of structs), on the partitioning that is there. Nothing is
sorted by more than key and order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiercraft.functions.columns import quoted

_RANK, _KEY, _ROW = "_rank", "_key", "_row"


def keep_one(df: DataFrame, keys: Sequence[Column], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: first by ``order``, ties by all the columns in turn."""
    ties = [quoted(field.name) for field in df.schema.fields if field.dataType.typeName() not in ("map", "variant")]
    names = [f"{_KEY}{i}" for i in range(len(keys))]
    rows = df.select("*", *[key.alias(name) for key, name in zip(keys, names, strict=True)])
    first = Window.partitionBy(*names).orderBy(*(order or ties[:1]))
    rows = rows.withColumn(_RANK, F.rank().over(first)).filter(quoted(_RANK) == 1)
    whole = F.struct(*map(quoted, df.columns))
    least = F.min(whole) if len(ties) == len(df.columns) else F.min_by(whole, F.struct(*ties))
    return rows.groupBy(*names).agg(least.alias(_ROW)).select(*[F.col(_ROW).getField(c).alias(c) for c in df.columns])


def latest_per(df: DataFrame, keys: Sequence[str], *newest: str) -> DataFrame:
    """The newest row per key; rows without a date come last."""
    return keep_one(df, [quoted(key) for key in keys], [quoted(name).desc_nulls_last() for name in newest])


def dedupe_by_key(df: DataFrame, *keys: Column, order: Sequence[Column] = ()) -> DataFrame:
    """One row per composite key in which NULL and empty text are the same; a single key is taken as it is."""
    if len(keys) > 1:
        keys = tuple(F.coalesce(key.cast("string"), F.lit("")) for key in keys)
    return keep_one(df, keys, order)


def unique_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """A two-column lookup with one value per key, the lowest."""
    return df.filter(quoted(key).isNotNull()).groupBy(quoted(key)).agg(F.min(quoted(value)).alias(value))


def first_present(value: str, order: Column) -> Column:
    """Aggregate: the first non-NULL ``value`` by ``order``."""
    return F.min_by(quoted(value), F.when(quoted(value).isNotNull(), order)).alias(value)
