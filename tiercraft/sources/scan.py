"""Table scans: by name, by path, with a column list and a filter, with a stored schema."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from tiercraft.functions.columns import quoted
from tiercraft.session import shared_folder


def read_path(
    spark: SparkSession, path: str, form: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """A table by path. With ``schema`` nothing is inferred from the files."""
    reader = spark.read.format(form)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_table(spark: SparkSession, name: str, paths: Mapping[str, str] | None = None) -> DataFrame:
    """A table by name: from ``paths`` if listed there, else from the catalog."""
    if paths and name in paths:
        return read_path(spark, paths[name])
    return spark.table(name)


def scan(df: DataFrame, columns: Sequence[str] | None = None, predicate: Column | None = None) -> DataFrame:
    """A filtered scan of some columns; both reach the file reader."""
    rows = df if predicate is None else df.filter(predicate)
    return rows if columns is None else rows.select(*map(quoted, columns))


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows of a known type, for an input that is absent."""
    return spark.createDataFrame([], schema)


def snapshot_path(spark: SparkSession, name: str, predicate: str | None = None) -> str:
    """Where a named snapshot lies; each filter has its own."""
    suffix = "" if predicate is None else "-" + hashlib.sha256(predicate.encode()).hexdigest()[:16]
    return f"{shared_folder(spark)}/snapshots/{name}{suffix}"


def snapshot_save(df: DataFrame, name: str, predicate: str | None = None) -> str:
    """Keep the rows under a name; an earlier snapshot of that name and filter is replaced."""
    path = snapshot_path(df.sparkSession, name, predicate)
    df.write.mode("overwrite").parquet(path)
    return path


def snapshot_load(
    spark: SparkSession, name: str, predicate: str | None = None, schema: StructType | None = None
) -> DataFrame:
    return read_path(spark, snapshot_path(spark, name, predicate), schema=schema)
