import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from texts import prose  # noqa: E402

CLASHING = ["row", "rest", "class", "rank", "frequent", "kept_text", "n_words", "row_key", "tie", "body", "host", "is_text", "bad_key", "with.dot"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)


def frame(spark, rows):
    """A documents table with extra columns whose names clash with those the operators make."""
    full = [(i, t, "en", s, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def edge(spark):
    long = " ".join(prose(1, 60_000))
    plain = " ".join(prose(2, 120))
    return frame(
        spark,
        [
            (1, plain, "a"), (1, plain, "a"), (2, plain, None), (3, None, "a"), (4, "", "b"), (5, " \n\t ", "b"), (None, plain, "a"),
            (None, None, None), (6, long, "a"), (7, "x" * 30_000, "c"), (8, "same " * 3000, "c"), (9, " ".join(prose(3, 80)), "b"),
            (9, " ".join(prose(4, 80)), "b"), (10, "Ünïcödé ß İ 漢字\x00  <|endoftext|>", "d"), (-5, "one two three", "a"),
        ],
    )


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
