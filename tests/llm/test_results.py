"""Results against brute force, the library that a format belongs to, exact round trips, or SQL."""

import hashlib
import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from texts import prose
from pyarrow import fs
from tokenizers import Tokenizer

from tiercraft.llm import _graph, _sketch, line_rules, link_trust, loss_difference, plane_shards, prefix_join, queries, rank_bpe, spaced_seeds, subword_quality, window_dedup, word_language

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts):
    return spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)


def odd_texts(n, seed=5):
    rng = random.Random(seed)
    signs = "abcdefgh THEing \n\t '.,#$%019ΑΣ中🎉é́ ß\x1c\x85 "
    made = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 80))) for _ in range(n)]
    return [*made, "a<|endoftext|>b <|startoftext|>", "don't WE'LL 's", "x" * 500 + "éß" * 100, "end \n\n", "", " lead", "two  spaces", "l\n\nl"]


@pytest.mark.parametrize("path", [WORDS])
def test_ids_and_text_as_the_library(spark, path):
    library = Tokenizer.from_file(path)
    library.no_padding(), library.no_truncation()
    texts = odd_texts(400)
    for r in rank_bpe.encode(docs_of(spark, texts), path).collect():
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_long_and_short_words_merge_alike():
    bpe = rank_bpe.RankBpe(WORDS)
    words = [w.encode() for w in ("a", "hello", "internationalization", "üß日本語", "abcabc" * 10)]
    for word, short in zip(words, bpe.merge(words), strict=True):
        assert short.tolist() == bpe.merge_long(word).tolist()


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("width", [2, 3])
def test_planes_round_trip(tmp_path, kind, width):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 1 << (8 * width), 1000, dtype=np.uint32)
    counts = np.array([0, 300, 1, 699])
    local = fs.LocalFileSystem()
    writer = plane_shards.ShardWriter(local.open_output_stream(f"{tmp_path}/a.tps"), width, kind, block=64)
    writer.add(np.arange(2), np.ones(2, "u1"), counts[:2], ids[:300])
    writer.add(np.arange(2, 4), np.ones(2, "u1"), counts[2:], ids[300:])
    assert writer.close() == (4, 1000)
    with local.open_input_file(f"{tmp_path}/a.tps") as file:
        shard = plane_shards.ShardReader(file)
        assert len(shard.index) == 16
        assert shard.ids(0, 1000).tolist() == ids.tolist()
        assert shard.ids(130, 193).tolist() == ids[130:193].tolist()
        assert shard.documents()[2].tolist() == counts.tolist()
    with pytest.raises(ValueError):
        writer.add(np.arange(1), np.ones(1, "u1"), np.array([1]), np.array([1 << (8 * width)], dtype=np.uint32))


def test_shards_as_the_library(spark):
    library = Tokenizer.from_file(BYTES)
    texts = odd_texts(300)
    at = 0
    got = {r.doc_id: r for r in plane_shards.read(plane_shards.write(docs_of(spark, texts), BYTES, 2, block=128)).collect()}
    for i, text in enumerate(texts):
        want = np.array([*library.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(want), zlib.crc32(want.tobytes()))
        at += len(want)


def test_byte_pieces_go_to_the_library_as_texts_of_many_words():
    """The same ids as of whole texts; words, with punctuation too, are not given to the library one by one."""
    random.seed(5)
    parts = [" it's", " two", "three,", "\n", "\t", " a\tb", "  ", " ", "\r\n", " \u00e9t\u00e9", "\u65e5\u672c", " x1.", "!", " 42%", "\u0120", " \u0120a", "\u010a", "don't"]
    texts = ["".join(random.choices(parts, k=random.randrange(12))) for _ in range(600)] + ["", " ", "\n", "end ", "\tx"]
    texts += ["".join(f" w{'abcdefgh'[i % 8]}{'xyz'[k % 3] * (i % 5)}{i}," for i in range(60)) + "\nnext" for k in range(20)]
    tokenizer = plane_shards.ByteTokenizer(BYTES)
    library, given = tokenizer.library, []

    class Counting:
        model = library.model

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return library.encode_batch_fast(texts, **options)

    tokenizer.library = Counting()
    ids, ends = tokenizer.texts(pa.array(["", *texts])[1:])
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want
    assert len(given) < len(tokenizer.memo.index) / 2
    offsets, codes, pieces = plane_shards._cut(pa.array(["zz q", "a b\nc", "", "d b"])[1:])
    assert offsets.tolist() == [0, 4, 4, 6] and [pieces[c] for c in codes] == ["a", " b", "\n", "c", "d", " b"]



def test_sketch_never_loses_a_repeated_key(spark):
    keys = [3 * k for k in range(3000)] + [3 * k for k in range(0, 3000, 7)]
    table = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)

    def found(batches):
        for b in batches:
            yield b.column("k").to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    sketch = _sketch.build(table, found, 20, counted=True).value
    every = np.unique(np.array(keys, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    again = sketch.repeated(every)
    assert again[::7].all() and again.mean() < 0.2
    assert sketch.frequency(every)[::7].min() >= 2


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 480)] + [(500, k) for k in range(501, 600)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.vertex: r.root for r in _graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in {x for a, b in pairs if a != b for x in (a, b)}}


def copied(seed):
    """Texts with exact and near copies, shared passages, loops and short ones."""
    rng = random.Random(seed)
    texts = [" ".join(prose(k, rng.choice([3, 12, 40, 90]))) for k in range(60)]
    passage = prose(999, 25)
    for k in range(60):
        base = texts[rng.randrange(60)].split()
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            base[rng.randrange(len(base))] = f"new{rng.randrange(9)}"
        texts.append(" ".join(base[: rng.choice([None, None, -1, -5])] or base))
    texts += [" ".join([*prose(700 + k, 10), *passage, *prose(800 + k, 10)]) for k in range(10)]
    texts += ["loop de loop " * 30, "loop de loop " * 31, "", None, "Few Words", "few words", "FEW\twords  "]
    return texts


@pytest.mark.parametrize("slice_bytes", [300, 4 << 20])
def test_repeated_windows_go(spark, monkeypatch, slice_bytes):
    n, texts = 8, copied(1)
    monkeypatch.setattr(window_dedup, "SLICE_BYTES", slice_bytes)
    first = {}
    worded = [SPACE.findall(t or "") for t in texts]
    for i, w in enumerate(worded):
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k : k + n]), i)
    for r in window_dedup.remove(docs_of(spark, texts), n).collect():
        w = worded[r.doc_id]
        gone = {k + j for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < r.doc_id for j in range(n)}
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept_text == " ".join(x for k, x in enumerate(w) if k not in gone)


def test_kept_words_stay_spaced_as_they_were():
    body = b" a  b\nc d\ne f\tg"
    assert window_dedup.keep(body, [(2, 1)], 2, True) == (7, 2, b" a  b\ne f\tg")
    assert window_dedup.keep(body, [(0, 2)], 2, True) == (7, 3, b"d\ne f\tg")
    assert window_dedup.keep(body, [(4, 1)], 2, False) == (7, 2, b"a b c d g")
    assert window_dedup.keep(body, [(0, 6)], 2, True) == (7, 7, b"")
    assert window_dedup.keep(body, [], 2, True) == (7, 0, body)


@pytest.mark.parametrize("words,percent", [(2, 70), (4, 85), (5, 80)])
def test_linked_groups(spark, words, percent):
    texts = copied(2)
    sets = []
    for t in texts:
        w = SPACE.findall((t or "").lower())
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = group[a], group[b]
            group = [min(x, y) if g in (x, y) else g for g in group]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in prefix_join.groups(docs_of(spark, texts), prefix_join.Similarity(words, percent)).collect()}
    assert got == {i: (len(s), group[i]) for i, s in enumerate(sets)}
    stay = {r.doc_id for r in prefix_join.one_each(docs_of(spark, texts), prefix_join.Similarity(words, percent)).collect()}
    empty = [i for i, s in enumerate(sets) if not s]
    assert stay - set(empty) == {group[i] for i, s in enumerate(sets) if s}


def test_more_matches_cost_less_only_where_prefixes_are_frequent():
    assert prefix_join.matches(np.array([0.0, 1, 1, 1, 1]), 2, 4) in range(1, 5)
    assert prefix_join.matches(np.array([0, 0, 5000, 5000, 5000.0]), 2, 4) == 1
    assert prefix_join.matches(np.array([5000, 1, 1, 1.0]), 1, 4) == 4


@pytest.mark.parametrize("first,step", [(4, 9), (4, 5), (2, 6), (40, 1)])
def test_overlaps_with_replaced_words(spark, first, step):
    tests = [(k, " ".join(prose(2000 + k, 30))) for k in range(20)]
    texts, planted = [], set()
    for k in range(60):
        words = prose(3000 + k, 60)
        if k % 3 == 0:
            quote = tests[k // 3][1].split()
            for at in range(first, 30, step):
                quote[at] = "other"
            words[20:20] = [w.upper() + "," for w in quote]
            planted.add((k, k // 3))
        texts.append(" ".join(words))
    got = spaced_seeds.overlaps(docs_of(spark, texts), spark.createDataFrame(tests, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    assert all(r.first_word >= 20 and r.last_word <= 50 and r.equal_words >= 20 for r in got)
    left = spaced_seeds.clean(docs_of(spark, texts), spark.createDataFrame(tests, "item_id long, text string")).collect()
    assert {r.doc_id for r in left} == set(range(60)) - {d for d, _ in planted}


def same_rows(frame, sql, **tables):
    db = duckdb.connect()
    for name, rows in tables.items():
        db.register(name, pa.Table.from_pylist([r.asDict() for r in rows.collect()], schema=None))
    want = db.execute(sql)
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(map(str, (tuple(r[c] for c in names) for r in frame.collect()))) == sorted(map(str, want.fetchall()))


def test_line_rules_as_sql(spark):
    rng = random.Random(4)
    shared = [" ".join(prose(50 + k, 9)) + f" {k}" for k in range(4)]
    rows = []
    for k in range(80):
        lines = [" ".join(prose(100 + k + 1000 * j, rng.choice([4, 12, 30]))) for j in range(rng.randint(1, 5))]
        lines += rng.sample(shared, rng.randint(0, 3)) + rng.choice([[], ["", "# $ |"], lines[:1] * 2])
        rows.append((k, "\n".join(lines), f"host{k % 3}" if k % 7 else None))
    rows += [(80 + k, rows[k][1], rows[k][2]) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rules = line_rules.LineRules(min_words=20, least=3, share=0.2, min_left=15, min_left_percent=60)
    judged = line_rules.judge(docs, rules)
    assert judged.where("n_removed_words > 0 AND kept").count() and judged.where("NOT kept AND NOT base_failed").count()
    same_rows(judged.drop("text_hash", "frequent"), line_rules.check_sql(rules), documents=docs)
    cleaned = {r.doc_id: r.text for r in line_rules.clean(docs, rules).collect()}
    assert set(cleaned) == {r.doc_id for r in judged.where("kept").collect()}
    removed = {r.doc_id: r.n_removed_words for r in judged.collect()}
    before = {r[0]: r[1] for r in rows}
    assert all(len(before[k].split()) - len(t.split()) == removed[k] for k, t in cleaned.items())


def test_trust_flows_as_sql(spark):
    rng = random.Random(6)
    hosts = [f"{a}{k}.{z}" for a in ("a", "b", "www.c") for k in range(5) for z in ("com", "net", "org")]
    rows = []
    for k in range(400):
        host = rng.choice(hosts) if k % 4 else "hub.org"
        links = "".join(f"<a class=x href={q}{p}{rng.choice(hosts)}/y{q}>" for q, p in [('"', "http://"), ("'", "//"), ("", "https://")] for _ in range(rng.randint(0, 2)))
        path = "/es/" if host.endswith("net") and rng.random() < 0.8 else "/en/x"
        rows.append((k, f"https://{host.upper() if k % 5 == 0 else host}{path}?q", f"<p>{links}<a href='/own'>"))
    rows += [(400, None, None), (401, "x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    judged = link_trust.judge(pages, queries.URL_RULES)
    assert {r.verdict for r in judged.where("rule IS NULL").collect()} == {"allow", "block"}
    same_rows(judged, link_trust.check_sql(queries.URL_RULES), pages=pages)
    assert "Python" not in judged._jdf.queryExecution().toString() and "Arrow" not in judged._jdf.queryExecution().toString()


def test_losses_by_hand(spark):
    texts = [" ".join(prose(k, 30, 12)) for k in range(12)] + ["Fu, GAL zz9 ¿odd?", ""]
    settings = loss_difference.Settings(words=8, strength=5.0)
    marked = {0, 3, 5}
    tokens = [[loss_difference.token(p) for p in t.split()] for t in texts]
    count = Counter(x for t in tokens for x in t)
    vocabulary = sorted(count, key=lambda x: (-count[x], x))[:8]
    name = lambda p: loss_difference.token(p) if loss_difference.token(p) in vocabulary else loss_difference.shape(p)
    ids = 1 + 16 + 8

    def model(some):
        pairs, first, second = Counter(), Counter(), Counter()
        for i in some:
            line = ["<s>", *map(name, texts[i].split())]
            for a, b in itertools.pairwise(line):
                pairs[a, b] += 1
                first[a] += 1
                second[b] += 1
        n = sum(second.values())
        return lambda a, b: -math.log2((pairs[a, b] + 5.0 * (second[b] + 1) / (n + ids)) / (first[a] + 5.0))

    target, background = model(marked), model(range(len(texts)))
    docs = docs_of(spark, texts)
    for r in loss_difference.score(docs, docs.where("doc_id IN (0, 3, 5)").select("doc_id"), settings).collect():
        line = ["<s>", *map(name, texts[r.doc_id].split())]
        if len(line) == 1:
            assert r.n_tokens == 0 and r.difference is None
            continue
        want = [sum(m(a, b) for a, b in itertools.pairwise(line)) / (len(line) - 1) for m in (target, background)]
        assert r.n_tokens == len(line) - 1
        assert abs(r.target_loss - want[0]) < 1e-4 and abs(r.background_loss - want[1]) < 1e-4
        assert abs(r.difference - (want[0] - want[1])) < 1e-4


def test_words_first_then_shorter_grams():
    one, two, grams = (np.array(x) for x in ([1.0, 7.0], [7.0, 2.0], [3.0, 4.0]))
    model = word_language.Model(["a", "b"], {"tree": one}, [{"q": grams}, {}, {"bau": two}])
    assert word_language.word_cost("tree", model) is one
    assert word_language.word_cost("bau", model).tolist() == two.tolist()
    assert word_language.word_cost("qqx", model).tolist() == grams.tolist()
    assert word_language.word_cost("zzz", model) is None


FOLDER = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@given
def test_held_out_languages(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in queries.QUERIES["op4_word_language"](spark, FOLDER).collect() if r.held_out]
    assert {r.doc_id for r in got} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_subwords_at_once_as_one_by_one():
    settings = subword_quality.Settings()
    words = ["a", "Über", "日本語", "###", "x🎉y", "word"]
    buckets, sizes = subword_quality.subword_table(words, settings)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    for k, word in enumerate(words):
        assert sorted(buckets[ends[k] : ends[k + 1]].tolist()) == sorted(subword_quality.subwords(word, settings))


def test_repeats():
    place = np.array([1, 1, 1, 2, 3, 2, 3, 2, 4, 4])
    assert subword_quality.repeats(place, np.array([0, 8, 8, 10])).tolist() == [[2.0, 2.0], [0.0, 0.0], [1.0, 0.0]]


@given
def test_held_out_quality(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = [r for r in queries.QUERIES["op9_subword_quality"](spark, FOLDER).collect() if r.held_out and r.doc_id in truth]
    good, bad = ([r.score for r in got if truth[r.doc_id] == y] for y in (1, 0))
    assert sum(g > b for g in good for b in bad) >= 0.85 * len(good) * len(bad)
    assert all(r.predicted == (r.score >= 0.7) for r in got)


@given
def test_digest_columns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    library = Tokenizer.from_file(WORDS)
    library.no_padding(), library.no_truncation()
    for r in queries.QUERIES["op10_rank_bpe"](spark, FOLDER).where("doc_id % 50 = 0").collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_linked_groups_around_one_text(spark, monkeypatch):
    """Edits of one text, on either side of the threshold, some of them shared: what is linked only with each other."""
    monkeypatch.setattr(prefix_join, "CROWD", 2)
    rng = random.Random(8)
    base = prose(77, 110)
    edits = [(rng.randrange(110), f"new{k}") for k in range(12)]
    texts = [" ".join(base)]
    for _ in range(70):
        words = list(base)
        for at, word in [*rng.sample(edits, rng.randint(0, 5)), *[(rng.randrange(110), f"own{rng.random()}") for _ in range(rng.choice([0, 0, 1, 2]))]]:
            words[at] = word
        texts.append(" ".join(words))
    sets = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in map(str.split, texts)]
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = group[a], group[b]
            group = [min(x, y) if g in (x, y) else g for g in group]
    got = {r.doc_id: r.component_id for r in prefix_join.groups(docs_of(spark, texts), prefix_join.Similarity(4, 85)).collect()}
    assert len(set(group)) > 5 and got == dict(enumerate(group))


def test_losses_over_every_token(spark, monkeypatch):
    """More tokens than a fixed vocabulary holds, in several slices; rare words tell documents apart."""
    monkeypatch.setattr(loss_difference, "SLICE_BYTES", 3000)
    texts = [" ".join(f"w{(k * 70 + j) % 3900}" for j in range(90)) for k in range(60)] + ["the rarest", "the scarce", "the scarce", ""]
    target_keys = {*range(0, 60, 4), 61}

    def model(some):
        pairs, first, second = Counter(), Counter(), Counter()
        for i in some:
            for a, b in itertools.pairwise(["<s>", *texts[i].split()]):
                pairs[a, b] += 1
                first[a] += 1
                second[b] += 1
        n, ids = sum(second.values()), 17 + len({x for t in texts for x in t.split()})
        return lambda a, b: -math.log2((pairs[a, b] + 100 * (second[b] + 1) / (n + ids)) / (first[a] + 100))

    assert len({x for t in texts for x in t.split()}) > 3000
    both = model(target_keys), model(range(len(texts)))
    docs = docs_of(spark, texts)
    got = {r.doc_id: r for r in loss_difference.score(docs, spark.createDataFrame([(k,) for k in target_keys], "doc_id long")).collect()}
    assert len(got) == len(texts) and got[63].difference is None
    for i, text in enumerate(texts[:63]):
        line = ["<s>", *text.split()]
        want = [sum(m(a, b) for a, b in itertools.pairwise(line)) / (len(line) - 1) for m in both]
        assert got[i].n_tokens == len(line) - 1
        assert abs(got[i].target_loss - want[0]) < 1e-9 and abs(got[i].background_loss - want[1]) < 1e-9
    assert got[61].difference < got[60].difference - 0.1


@pytest.mark.parametrize("key", [None, 7])
def test_a_quote_takes_no_other_text_of_its_key(spark, key):
    item = prose(4000, 30)
    quote, other, plain = [" ".join([*prose(4001, a), *item, *prose(4002, 20)]) for a in (10, 40)] + [" ".join(prose(4003, 60))]
    docs = spark.createDataFrame([(key, quote, 1), (key, other, 2), (key, plain, 3), (key, None, 4), (8, plain, 5), (key, quote, 6)], "doc_id long, text string, n int")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert sorted(r.n for r in spaced_seeds.clean(docs, items).collect()) == [3, 4, 5]
    assert sorted((r.doc_id, r.first_word, r.last_word) for r in spaced_seeds.overlaps(docs, items).collect()) == [(key, 10, 40), (key, 40, 70)]


def test_trust_flows_until_it_stands(spark):
    """Paths longer than the least number of steps, and loops, against the solved equations."""
    rng = random.Random(9)
    links = [("h1.org", "bad.net")] + [(f"h{k + 1}.org", f"h{k}.org") for k in range(1, 14)]
    links += [("good.com", "g1.org")] + [(f"g{k}.org", f"g{k + 1}.org") for k in range(1, 11)] + [("g11.org", "h13.org"), ("g11.org", "g1.org"), ("g5.org", "bad.net")]
    links += [(f"r{rng.randrange(12)}.org", f"{rng.choice('rrrgh')}{rng.randrange(1, 12)}.org") for _ in range(40)]
    links = [(a, b) for a, b in links if a != b]
    hosts = sorted({h for pair in links for h in pair})
    at = {h: k for k, h in enumerate(hosts)}

    def solved(seed, pairs):
        flow = np.zeros((len(hosts), len(hosts)))
        for a, b in pairs:
            flow[at[b], at[a]] += 1 / sum(x == a for x, _ in pairs)
        start = np.zeros(len(hosts))
        start[at[seed]] = 0.15
        return np.linalg.solve(np.eye(len(hosts)) - 0.85 * flow, start)

    trust, distrust = solved("good.com", links), solved("bad.net", [(b, a) for a, b in links])
    rows = [(k, f"http://{h}/es/x", "".join(f"<a href='http://{b}/'>" for a, b in links if a == h)) for k, h in enumerate(hosts)]
    got = {r.host: r.verdict for r in link_trust.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), queries.URL_RULES, queries.STANDING).collect()}
    assert min(abs(trust - distrust)[distrust + trust > 0]) > 1e-6
    want = {h: "block" if distrust[k] > 1e-12 and distrust[k] >= trust[k] else "allow" for h, k in at.items()}
    assert got == want and got["h14.org"] == "block"


def test_seeds_hit_every_window_that_counts():
    seeds = spaced_seeds.Seeds()
    replaced = seeds.window - -(-seeds.percent * seeds.window // 100)
    places = [[first + k for k, one in enumerate(m) if one == "1"] for m in seeds.masks for first in range(seeds.window - len(m) + 1)]
    missed = [x for n in range(replaced + 1) for x in itertools.combinations(range(seeds.window), n) if all(set(x) & set(p) for p in places)]
    assert replaced == 2 and missed == []
