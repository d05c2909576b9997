"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercraft.llm import hadamard_codes, iceberg_terms, line_rules, link_trust, loss_difference, plane_shards, prefix_join, rank_bpe, slot_shards, spaced_seeds, subword_quality, window_dedup, word_language

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = build
        if check is not None:
            CHECKS[name] = check
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_loss_difference")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return loss_difference.score(table(spark, folder, "documents"), good)


@query("op2_plane_shards")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return plane_shards.read(plane_shards.write(documents, public_tokenizers.path("byte_bpe_50k.json"), end_id=2))


@query("op3_spaced_seeds")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return spaced_seeds.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op4_word_language")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = word_language.remainder("doc_id", 3) == 1
    model = word_language.learn(documents.where(~held_out))
    return word_language.predict(documents, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


#: The rules that this library's url query judges by.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}

#: Scores until they stand; the SQL takes eight steps, which is the same where pages link to their own host only.
STANDING = link_trust.TrustFlow(tolerance=1e-6)


@query("op5_link_trust", link_trust.check_sql(URL_RULES))
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return link_trust.judge(table(spark, folder, "pages"), URL_RULES, STANDING)


@query("op6_line_rules", line_rules.check_sql())
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.judge(table(spark, folder, "documents")).drop("text_hash", "frequent")


@query("op7_window_dedup", window_dedup.CHECK)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return window_dedup.digests(window_dedup.remove(table(spark, folder, "documents")))


@query("op8_prefix_join", prefix_join.CHECK)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_join.groups(table(spark, folder, "documents"), prefix_join.Similarity(words=4, percent=85)).drop("tie")


@query("op9_subword_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(word_language.remainder("doc_id", 4) == 2, F.lit(False))
    labels = table(spark, folder, "labels").where(~held_out)
    scored = subword_quality.predict(documents, subword_quality.learn(documents.where(~held_out), labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query("op10_rank_bpe")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return rank_bpe.digests(rank_bpe.encode(documents, public_tokenizers.path("word_bpe_49k.json")))


@query("op11_hadamard_codes", hadamard_codes.CHECK)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return hadamard_codes.digests(table(spark, folder, "embeddings"))


@query("op12_slot_shards", slot_shards.CHECK)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return slot_shards.digests(table(spark, folder, "documents"))


@query("op13_iceberg_terms", iceberg_terms.CHECK)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return iceberg_terms.audit(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
