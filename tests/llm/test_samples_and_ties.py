"""Samples of labelled rows at any size, plain-Python training and scoring, texts of one key, short benchmark items."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import prose

from tiercraft.llm import line_rules, link_trust, spaced_seeds, subword_quality, window_dedup, word_language


@pytest.mark.parametrize("rows", [10**9, 10**11, 10**13])
def test_some_rows_are_learned_from_at_any_size(spark, rows):
    """Of a made-up table of so many rows, those with hashes in the lowest 2**20 / rows of the range stay."""
    share = 2**20 / rows
    hashed = spark.range(-(2**63), -(2**63) + int(2**64 * share * 2), max(1, int(2**64 * share / 1000))).toDF("h")
    assert 990 <= hashed.where(word_language.below(F.col("h"), F.lit(share))).count() <= 1010


def test_sample_of_each_language_is_bounded(spark):
    rows = [(str(i), "en", f"text {i}") for i in range(5000)] + [(str(i), "qq", f"rare {i}") for i in range(7)]
    rows += [("hot", "hh", "the same text")] * 3000 + [(None, "nn", "no key")] * 3000
    got = Counter(r.lang for r in word_language.sampled(spark.createDataFrame(rows, "k string, lang string, body string").repartition(4), 100).collect())
    assert got["en"] == 100 and got["qq"] == 7 and got["hh"] in (0, 100) and got["nn"] in (0, 100)


def plain_language(learned, texts, settings):
    """(language, score) of texts by counting whole words and n-grams, the most frequent of each language known."""
    letters = lambda p: "".join(c for c in p if c.isalpha()).lower()
    words = {}
    for text, lang in learned:
        words.setdefault(lang, Counter()).update(w for p in text.split() if (w := letters(p)))
    langs = sorted(words)
    tables = {}
    for lang in langs:
        counts = {0: words[lang]}
        for n in range(1, settings.longest + 1):
            counts[n] = Counter()
            for w, k in words[lang].items():
                padded = f" {w} "
                for i in range(len(padded) - n + 1):
                    counts[n][padded[i : i + n]] += k
        for n, c in counts.items():
            most = settings.most_grams if n else settings.most_words
            for item, k in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:most]:
                tables.setdefault((n, item), {})[lang] = -math.log10(k / sum(c.values()))
    cost = lambda n, item: [tables[n, item].get(la, settings.penalty) for la in langs] if (n, item) in tables else None
    out = []
    for text in texts:
        found = []
        for p in text.split():
            if not (w := letters(p)):
                continue
            own = cost(0, w)
            for n in range(settings.longest, 0, -1):
                if own is None:
                    padded = f" {w} "
                    some = [c for i in range(len(padded) - n + 1) if (c := cost(n, padded[i : i + n])) is not None]
                    own = [sum(x) / len(some) for x in zip(*some, strict=True)] if some else None
            if own is not None:
                found.append(own)
        if not any(letters(p) for p in text.split()):
            out.append(("und", 0.0))
            continue
        mean = [sum(x) / len(found) for x in zip(*found, strict=True)] if found else [0.0] * len(langs)
        chance = [math.exp(-settings.sharpness * (x - min(mean))) for x in mean]
        out.append((langs[mean.index(min(mean))], 1 / sum(chance)))
    return out


def test_language_against_plain_counting(spark):
    rng = random.Random(6)
    stocks = {"aa": prose(11, 80), "bb": [w[::-1] for w in prose(12, 80)], "cc": prose(13, 40)}
    learned = [(" ".join(rng.choice(stock) for _ in range(30)), lang) for lang, stock in stocks.items() for _ in range(12)]
    texts = [" ".join(rng.choice(stock) + rng.choice(["", ",", "s"]) for _ in range(12)) for stock in stocks.values() for _ in range(15)] + ["", "12 34", "Zq", "été"]
    settings = word_language.Settings(most_words=25, most_grams=40)
    rows = spark.createDataFrame([(i, t, la) for i, (t, la) in enumerate(learned)], "doc_id long, text string, lang string")
    model = word_language.learn(rows, settings)
    got = {r.doc_id: r for r in word_language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, settings).collect()}
    for i, (lang, score) in enumerate(plain_language(learned, texts, settings)):
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, abs=1e-4)


def plain_training(texts, labels, settings):
    """Vectors, weights and bias after the same steps, a number at a time in double precision."""
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1 / settings.dim, 1 / settings.dim, (settings.buckets, settings.dim)).tolist()
    weights, bias = [[0.0] * settings.dim for _ in range(2)], [0.0, 0.0]
    docs = [plain_shares(t, settings) for t in texts]
    steps = settings.epochs * len(docs)
    for step in range(steps):
        if step % len(docs) == 0:
            order = rng.permutation(len(docs))
        k = order[step % len(docs)]
        rate = settings.rate * (1 - step / steps)
        mean, chance = plain_chance(docs[k], vectors, weights, bias)
        error = [p - (c == labels[k]) for c, p in enumerate(chance)]
        pull = [sum(error[c] * weights[c][d] for c in range(2)) for d in range(settings.dim)]
        for c in range(2):
            bias[c] -= rate * 0.1 * error[c]
            for d in range(settings.dim):
                weights[c][d] -= rate * error[c] * mean[d]
        for b, share in docs[k].items():
            for d in range(settings.dim):
                vectors[b][d] -= rate * len(docs[k]) ** 0.5 * share * pull[d]
    return vectors, weights, bias


def plain_shares(text, settings):
    words = text.encode().split()
    marks = []
    for i, w in enumerate(words):
        if i and words[i - 1] == w:
            marks.append(subword_quality.SAME)
        if any(i > lag and words[i - lag] == w and words[i - lag - 1] == words[i - 1] for lag in range(2, subword_quality.LAG + 1)):
            marks.append(subword_quality.LOOP)
    every = [w.decode() for w in words] + marks
    shares = Counter()
    for w in every:
        buckets = subword_quality.subwords(w, settings)
        for b in buckets:
            shares[b] += 1 / len(buckets) / len(every)
    return shares


def plain_chance(shares, vectors, weights, bias):
    mean = [sum(share * vectors[b][d] for b, share in shares.items()) for d in range(len(weights[0]))]
    raw = [sum(w * m for w, m in zip(weights[c], mean, strict=True)) + bias[c] for c in range(2)]
    top = max(raw)
    high = [math.exp(x - top) for x in raw]
    return mean, [x / sum(high) for x in high]


def test_quality_against_plain_training(spark):
    settings = subword_quality.Settings(buckets=256, dim=3, epochs=3, rate=0.5)
    texts = [" ".join(prose(40 + k, 15, 30)) + (" go go a b a b a b" if k % 2 else "") for k in range(24)]
    labels = [k % 2 for k in range(24)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int")
    got = {r.doc_id: r.score for r in subword_quality.predict(docs, subword_quality.learn(docs, marks, settings)).collect()}
    order = sorted(range(24), key=str)  # rows are trained on in order of their key as text
    model = plain_training([texts[k] for k in order], [labels[k] for k in order], settings)
    for k in range(24):
        assert got[k] == pytest.approx(plain_chance(plain_shares(texts[k], settings), *model)[1][1], abs=2e-3)


def test_training_sample_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    texts = [(i, "word " * 50) for i in range(400)] + [(400, "x" * 5000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    marks = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    taken = {}

    def seen(**limits):
        settings = subword_quality.Settings(epochs=1, buckets=64, **limits)
        model = subword_quality.learn(docs, marks, settings)
        taken[str(limits)] = model.vectors
        return model

    assert seen(sample_rows=10).vectors.shape == (64, 8)
    assert seen(sample_rows=400, sample_bytes=600, longest_text=4000).vectors.shape == (64, 8)
    assert not np.array_equal(*taken.values())


@pytest.mark.parametrize("long", [False, True])
def test_texts_of_one_key_with_like_hashes(spark, long):
    """Two texts without a key whose hashes agree in the low 31 bits: one loses its repeated passage, the other nothing."""
    shared = " ".join(prose(77, 60))
    tail = F.lit(" ".join(f"w{k}" for k in range(80)) if long else "end")
    low = lambda c: F.xxhash64(c).bitwiseAND(F.lit(2**31 - 1))
    a = spark.range(300_000).select(F.concat(F.lit(shared + " "), F.col("id").cast("string")).alias("a"))
    b = spark.range(300_000).select(F.concat(F.col("id").cast("string"), F.lit(" "), tail).alias("b"))
    pair = a.join(b, low("a") == low("b")).orderBy("a", "b").first()
    assert pair is not None
    rows = spark.createDataFrame([(1, shared), (None, pair.a), (None, pair.b)], "doc_id long, text string")
    got = {(r.doc_id, r.n_words): (r.n_removed, r.kept_text) for r in window_dedup.remove(rows).collect()}
    assert got == {(1, 60): (0, shared), (None, 61): (60, pair.a.split()[-1]), (None, len(pair.b.split())): (0, pair.b)}
    assert {r.text for r in window_dedup.clean(rows).collect()} == {shared, pair.a.split()[-1], pair.b}


def test_a_passage_of_many_rows_without_a_key(spark):
    shared = " ".join(prose(78, 55))
    rows = [(None, f"{shared} t{k}") for k in range(200)] + [(None, shared)] * 20 + [(3, f"a {shared}"), (9, f"{shared} z")]
    got = window_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == {(None, 55): 220, (3, 0): 1, (9, 55): 1}


def plain_overlaps(docs, items, seeds):
    """(doc, item) pairs by every alignment of every pair."""
    cut = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (t or "")).lower().split()
    found = set()
    for d, text in docs:
        doc = cut(text)
        for i, other in items:
            item = cut(other)
            size = min(seeds.window, len(item))
            if len(item) < seeds.shortest:
                continue
            for shift in range(-len(item), len(doc) + 1):
                equal = [doc[k + shift] == item[k] if 0 <= k + shift < len(doc) else None for k in range(len(item))]
                for at in range(len(item) - size + 1):
                    part = equal[at : at + size]
                    if None not in part and 100 * sum(part) >= seeds.percent * size:
                        found.add((d, i))
    return found


def test_overlaps_against_every_alignment(spark):
    rng = random.Random(8)
    seeds = spaced_seeds.Seeds()
    stock = prose(3, 300, 60)
    items = [(k if k % 7 else None, " ".join(rng.choice(stock) for _ in range(rng.randint(1, 24)))) for k in range(45)]
    items = [(k, t) for n, (k, t) in enumerate(items) if k is not None or n in (0, 14)]
    docs = [(None, ""), (0, None)]
    for k in range(1, 160):
        words = [rng.choice(stock) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            quote = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):
                quote[rng.randrange(len(quote))] = "zzz"
            at = rng.randint(0, len(words))
            words[at:at] = quote
        docs.append((k, " ".join(words).capitalize() + "!"))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = plain_overlaps(docs, items, seeds)
    assert {(r.doc_id, r.item_id) for r in spaced_seeds.overlaps(frame, tests).collect()} == want
    assert {i for _, i in want} >= {None} and len(want) > 50
    left = {r.doc_id for r in spaced_seeds.clean(frame, tests).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}


def test_line_limits(spark):
    """Documents count, copies too; a long line goes from a large host by the absolute limit alone."""
    own = [" ".join(prose(500 + k, 60)) for k in range(300)]
    line = "one line that very many documents of this host hold"
    rows = [(k, f"{own[k]}\n{line}" if k < 12 else f"{own[k]}\nshort one" if k < 24 else own[k], "big") for k in range(300)]
    rows += [(1000 + k, f"{own[0]}\nmore here", "small") for k in range(22)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by = {r.doc_id: r for r in line_rules.judge(docs, line_rules.LineRules(many=10)).collect()}
    assert [by[k].n_removed_words for k in (0, 11, 12, 30)] == [10, 10, 0, 0]
    assert by[0].kept and not by[1000].kept and by[1000].n_removed_words == 62
    assert hashlib.sha256(b"").hexdigest() and line_rules.judge(docs).where("doc_id = 0").first().n_removed_words == 0


def test_trust_that_does_not_stand_is_an_error(spark):
    """A chain longer than the steps allowed: the last hosts are reached too late."""
    pages = [(k, f"http://h{k}.org/", f'<a href="http://h{k + 1}.org/">x</a>') for k in range(30)] + [(99, "http://a.com/", '<a href="http://h0.org/">x</a>')]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    with pytest.raises(RuntimeError, match="do not stand after 12 steps"):
        link_trust.judge(frame, {"com/": "allow"}, link_trust.TrustFlow(tolerance=1e-6, most_steps=12)).collect()
