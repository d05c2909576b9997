"""Session settings and the shared folder that staged data goes to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# The JVM interprets, and never compiles, methods over 8000 bytes; above that Spark does better without fusing the stage
# into one method.
METHOD_SETTING, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def build_session(app: str = "tiercraft", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config(METHOD_SETTING, METHOD_BYTES)
        # Recording the Python call site of every column expression triples the time to build a wide plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def compiled_methods(spark: SparkSession) -> None:
    """Wide projections are split into methods that the JVM compiles, unless the deployment has set its own limit."""
    if spark.conf.get(METHOD_SETTING, None) is None:
        spark.conf.set(METHOD_SETTING, METHOD_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting and without a
    checkpoint folder (a test) gets a temporary one; on a cluster that is an error, as no folder of the driver's
    machine can be read by the executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        if not context.getCheckpointDir():
            context.setCheckpointDir(folder)
        return folder
    if not context.getCheckpointDir():
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tiercraft-"))
    return context.getCheckpointDir()


#: Folders staged within the innermost ``staging``.
_until_end: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged within is removed at the end, also after an error: for runs that write their tables themselves."""
    paths: list[str] = []
    token = _until_end.set(paths)
    try:
        yield
    finally:
        _until_end.reset(token)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for text in paths:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
            path.getFileSystem(hadoop).delete(path, True)


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    This cuts the lineage, survives lost executors and keeps column pruning for every later reader. With ``by`` there
    is a folder for each value of that column, so that readers of one value read nothing of the others.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage/{label}-{uuid.uuid4().hex}"
    if (kept := _until_end.get()) is not None:
        kept.append(path)
    (df.write if by is None else df.write.partitionBy(by)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
