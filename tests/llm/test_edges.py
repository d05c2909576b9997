"""Every operator and stage on NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tiercraft.llm import line_rules, link_trust, loss_difference, plane_shards, prefix_join, queries, rank_bpe, spaced_seeds, subword_quality, window_dedup, word_language

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def items(spark, some=True):
    rows = [(1, "fu gal hi ino ke an ber cho dil er fu fu gal gal"), (2, None), (None, "a b c d e f g h i j"), (3, ""), (4, "one two")]
    return spark.createDataFrame(rows if some else [], "item_id long, text string")


def labels(spark, some=True):
    return spark.createDataFrame([(1, 1, 0), (8, 0, 0), (9, 1, 0), (None, 1, 0), (6, None, 0)] if some else [], "doc_id long, quality int, toxic int")


BY_ROW = {
    "op1": lambda spark, docs, some: loss_difference.score(docs, labels(spark, some).select("doc_id"), loss_difference.Settings(words=50)),
    "op1_whole": lambda spark, docs, some: loss_difference.score(docs, labels(spark, some).select("doc_id")),
    "op2": lambda spark, docs, some: plane_shards.read(plane_shards.write(docs, BYTES, 2)),
    "op4": lambda spark, docs, some: word_language.predict(docs, word_language.learn(docs)),
    "op6": lambda spark, docs, some: line_rules.judge(docs),
    "op7": lambda spark, docs, some: window_dedup.digests(window_dedup.remove(docs)),
    "op8": lambda spark, docs, some: prefix_join.groups(docs),
    "op9": lambda spark, docs, some: subword_quality.predict(docs, subword_quality.learn(docs, labels(spark, some), subword_quality.Settings(epochs=1))),
    "op10": lambda spark, docs, some: rank_bpe.digests(rank_bpe.encode(docs, WORDS)),
}


@pytest.mark.parametrize("name", BY_ROW)
def test_a_row_for_each_row(spark, edge, name):
    made = BY_ROW[name](spark, edge, True)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in made.collect())
    assert got == sorted((r[0] is not None, r[0] or 0) for r in edge.select("doc_id").collect())


@pytest.mark.parametrize("name", BY_ROW)
def test_empty_table(spark, nothing, name):
    assert BY_ROW[name](spark, nothing, False).collect() == []


@pytest.mark.parametrize("name", BY_ROW)
def test_repeated_rows_get_one_answer(spark, edge, name):
    made = BY_ROW[name](spark, edge, True).where("doc_id = 1").drop("start").collect()
    assert len(made) == 2 and made[0] == made[1]


def test_overlaps_on_edges(spark, edge, nothing):
    assert spaced_seeds.overlaps(nothing, items(spark)).collect() == []
    assert spaced_seeds.overlaps(edge, items(spark, False)).collect() == []
    got = spaced_seeds.overlaps(edge.withColumn("text", F.when(F.col("doc_id") == 4, "FU, gal hi-ino ke an ber cho dil er fu fu gal gal!").otherwise(F.col("text"))), items(spark)).collect()
    assert [(r.doc_id, r.item_id, r.first_word, r.last_word) for r in got] == [(4, 1, 0, 14)]


def test_urls_on_edges(spark):
    rows = [(1, None, None), (2, "no scheme", "<a href='http://B.net/x'>"), (None, "HTTP://A.com", None), (3, "http://a.com?x", ""), (3, "http://a.com?x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("score", F.lit(1))
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in link_trust.judge(pages, queries.URL_RULES).collect()}
    assert got == {(1, "", "", None, "allow"), (2, "", "", None, "allow"), (None, "a.com", "", None, "allow"), (3, "a.com", "", None, "allow")}
    assert link_trust.judge(pages.limit(0), queries.URL_RULES).collect() == []


def test_a_very_long_page(spark):
    """Links of a page of some megabytes all count; a page of one long word has none."""
    html = "".join(f'<p>{"x" * 400}</p><a href="http://h{k % 50}.org/{k}">y</a>' for k in range(8000))
    pages = spark.createDataFrame([(1, "http://a.com/", html), (2, "http://b.com/", "<a" + "z" * 3_000_000)], "page_id long, url string, html string")
    links = {(r.src, r.dst): r.links for r in link_trust.host_links(pages).collect()}
    assert links == {("a.com", f"h{k}.org"): 160 for k in range(50)}
    assert {r.verdict for r in link_trust.judge(pages, queries.URL_RULES).collect()} == {"allow"}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, edge, nothing, tmp_path, name, stage):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert stage(spark, nothing, str(tmp_path)).collect() == []
    made = stage(spark, edge, str(tmp_path))
    assert made.count() > 0
    if name != "token_ids":
        assert made.columns == edge.columns and made.dtypes == edge.dtypes
        assert {r["with.dot"] for r in made.collect()} == {"x"}
