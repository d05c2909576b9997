"""Python work in tasks: Arrow batches through a function of this package, which goes to the executors with the job."""

from __future__ import annotations

import ctypes
import gc
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tiercraft.llm import _text
from tiercraft.session import shared_folder

ROOT = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for a Spark context, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_tiercraft_shipped", False) or not ROOT.is_dir():
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as packed:
        for file in sorted(ROOT.rglob("*.py")):
            packed.write(file, file.relative_to(ROOT.parent))
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/code/tiercraft-{uuid.uuid4().hex}.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(data.getvalue())
    out.close()
    context.addPyFile(path.toString())
    context._tiercraft_shipped = True


def _release() -> None:
    """Give memory back; Spark keeps its Python workers for later tasks of any kind."""
    _text.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, task: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow``, on executors that may not have this package, in workers that give memory back afterwards."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            _release()

    return df.mapInArrow(run, schema)
