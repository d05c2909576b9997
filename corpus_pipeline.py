"""A corpus from raw documents to token ids: quality rules, near duplicates, repeated passages, benchmark leaks, encoding.

Every stage takes (spark, docs, folder of the tables) and works on all that the stage before it kept. All but the last
return the columns of ``documents``; the last returns a row a document with ids and decoded text.

Defined results: a stage keeps NULL keys and extra columns as its operator's docstring says; an empty table gives an
empty table.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercraft.llm import line_rules, prefix_join, rank_bpe, spaced_seeds, window_dedup
from tiercraft.session import shared_folder


def with_lengths(docs: DataFrame) -> DataFrame:
    """n_chars as the text is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rejected documents go; lines that many documents of a host share go from those that stay."""
    return with_lengths(line_rules.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words a shingle, similarity 0.8 or more."""
    return prefix_join.one_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Words in 50-word passages that an earlier document has go; a document that loses all its words goes."""
    return with_lengths(window_dedup.clean(docs))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that overlap with an item of the benchmark go."""
    return spaced_seeds.clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers) and the decoded text."""
    made = rank_bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return made.select("doc_id", rank_bpe.n_tokens(F.col("ids")).alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]

#: The last stage encodes text, which SQL cannot express; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, folder)
