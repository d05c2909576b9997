"""N-gram Jaccard self-join with adaptive multi-match prefixes, and the groups that its links make.

Texts are sets of word n-grams; two are linked when their Jaccard similarity reaches a threshold. Equal sets are one
class, so copies are never paired. The n-grams of a set are put in one global order, rare ones first: those that a
count-min sketch proves to occur once, then by estimated frequency, then by hash. Linked sets of overlap o share at
least l n-grams among the first ``size - o + l`` of each (the l-prefixes). Every document chooses its own l: a longer
prefix costs more index entries, and pays when the candidates that must then share l of them get fewer; the estimate
is made from the frequencies of the n-grams that would be added. Two documents are compared only when they share as
many prefix n-grams as the smaller of their l, and when lengths and places in the order allow the threshold at all.

Large groups are not paired off. A first round compares every document of an index entry with one centre, the member
with the fewest n-grams of its own. What these links join is one component, and a second round compares only
documents of different components, the exact rest. Of documents that are close to one centre it compares those that
share what sets them apart from it: if x and y share none of these n-grams, both are at least as similar to the
centre as to each other, so a link of theirs is in one component already. The shared ones must be so many that a
prefix of the rare ones shows it (``apart``). N-grams proved to occur once never leave their task.

Candidates are verified on whole texts. The result is one row a document with the smallest key of its group.

Defined results: texts without words (also NULL) have no n-grams, link with nothing and keep their own key; a text of
fewer than n words is one n-gram. Keys are numbers, or text of numbers (other text is an error in ANSI mode, else NULL).
NULL keys are never the smallest key of a group with another key. Repeated rows are
in one group. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercraft.llm import _sketch
from tiercraft.llm._carry import quoted, row_struct, unpacked
from tiercraft.llm._graph import components
from tiercraft.llm._text import U64, Words, bytes_of, mix, signed, slices, window_hashes, words_of
from tiercraft.llm._tasks import map_arrow
from tiercraft.operators.attach import attach, settled
from tiercraft.session import stage

#: Counters of the sketch for each estimated n-gram; a word and its space take about 7 bytes.
PER_GRAM, GRAM_BYTES = 3.0, 7
#: A verification costs as much as so many index entries.
VERIFY = 8
MOST_MATCHES = 4
#: In index entries with so many members all are compared with the centre, also those that cannot be linked to it.
CROWD = 24


@dataclass(frozen=True)
class Similarity:
    words: int = 5
    percent: int = 80

    def least(self, size):
        """The smallest overlap that a set of this size can have with a linked one."""
        return -(-self.percent * size // 100)

    def needed(self, a: Column, b: Column) -> Column:
        """The smallest overlap of two linked sets of these sizes."""
        return F.ceil(self.percent * (a + b) / F.lit(100 + self.percent))

    def linked(self, both: int, a: int, b: int) -> bool:
        return 100 * both >= self.percent * (a + b - both)


def gram_sets(words: Words, hashes: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The different n-gram hashes of every row, sorted."""
    first, row = words.rows_of(n)
    grams = window_hashes(hashes, first, n)
    ends = np.searchsorted(row, np.arange(len(words.first)))
    for r in range(len(words.first) - 1):
        a, b = words.first[r], words.first[r + 1]
        if b - a >= n:
            own = np.sort(grams[ends[r] : ends[r + 1]])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            yield window_hashes(hashes[a:b], np.array([0]), b - a)
        else:
            yield grams[:0]


def class_of(grams: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        first = mix(np.array([grams.sum(dtype=np.uint64), len(grams)], dtype=np.uint64)).sum(dtype=np.uint64)
        second = mix(np.array([mix(grams ^ U64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], dtype=np.uint64))[0]
    return int(first).to_bytes(8, "big") + int(second).to_bytes(8, "big")


def _classes(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                words = words_of(part, "body", lower=True)
                sets = [*gram_sets(words, words.hashes(), n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_key"), part.column("tie"), pa.array([class_of(s) if len(s) else None for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())],
                    ["row_key", "tie", "class", "size"],
                )

    return rows


def _keys(n: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for part in slices(batch, "body"):
                words = words_of(part, "body", lower=True)
                yield np.concatenate([*gram_sets(words, words.hashes(), n), np.empty(0, dtype=np.uint64)])

    return keys


def matches(weights: np.ndarray, base: int, most: int) -> int:
    """How many shared prefix n-grams to ask for: the number with the least estimated cost.

    ``weights`` are the estimated other documents with each n-gram, in order; ``base`` is the prefix for one match.
    """
    sums = np.cumsum(weights[: base + most - 1])
    asked = np.arange(1, most + 1)
    found = sums[np.minimum(base - 1 + asked - 1, len(sums) - 1)]
    return int(np.argmin(found + VERIFY * found / asked)) + 1


INDEX = "token long, class binary, size int, place int, own int, asked int"


def _prefixes(sketch: Broadcast, alike: Similarity):
    """Rows (INDEX) of n-grams in prefixes that may occur in another document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sketch.value
        noise = int(known.counts.sum()) // _sketch.COUNTERS
        for batch in batches:
            for part in slices(batch, "body"):
                words = words_of(part, "body", lower=True)
                sets = [*gram_sets(words, words.hashes(), alike.words)]
                every = np.concatenate([*sets, np.empty(0, dtype=np.uint64)])
                again, often = known.repeated(every), known.frequency(every)
                columns: list[list] = [[] for _ in range(6)]
                seen, at = set(), 0
                for grams in sets:
                    size = len(grams)
                    here, at = slice(at, at + size), at + size
                    own = size - int(again[here].sum())
                    base = size - alike.least(size) + 1
                    if not size or own >= min(size, base + MOST_MATCHES - 1) or own >= base:
                        continue
                    name = class_of(grams)
                    if name in seen:
                        continue
                    seen.add(name)
                    level = np.where(again[here], often[here], 0)
                    order = np.lexsort((grams, level))
                    weights = np.where(level[order] > 0, np.maximum(level[order] - noise, 1), 0)
                    asked = matches(weights, base, min(MOST_MATCHES, alike.least(size)))
                    place = np.arange(own, min(size, base + asked - 1), dtype=np.int32)
                    columns[0].append(grams[order[place]])
                    columns[1].extend([name] * len(place))
                    columns[2].append(np.full(len(place), size, dtype=np.int32))
                    columns[3].append(place)
                    columns[4].append(np.full(len(place), own, dtype=np.int32))
                    columns[5].append(np.full(len(place), asked, dtype=np.int32))
                if columns[1]:
                    arrays = [signed(np.concatenate(columns[0])), pa.array(columns[1], pa.binary()), *[pa.array(np.concatenate(c)) for c in columns[2:]]]
                    yield pa.RecordBatch.from_arrays(arrays, ["token", "class", "size", "place", "own", "asked"])

    return rows


def possible(alike: Similarity, a: str, b: str) -> Column:
    """Lengths and places allow the threshold: what can be shared before, at and after this n-gram is enough."""
    c = lambda side, name: F.col(f"{side}.{name}")
    x, y = c(a, "size"), c(b, "size")
    before = F.least(c(a, "place") - c(a, "own"), c(b, "place") - c(b, "own"))
    after = F.least(x - c(a, "place"), y - c(b, "place"))
    return (100 * F.least(x, y) >= alike.percent * F.greatest(x, y)) & (before + after >= alike.needed(x, y))


def index_of(plain: DataFrame, sketch: Broadcast, alike: Similarity) -> DataFrame:
    """Index entries with two classes or more, each class once, with the entry's centre."""
    made = plain.select("body").transform(map_arrow, _prefixes(sketch, alike), INDEX)
    rows = stage(made.distinct(), "entries")
    # Centre and number combine before they are shuffled, and the merge join is split: an n-gram that a third of the
    # documents have in their prefix is no task of its own.
    heads = rows.groupBy("token").agg(F.count("*").alias("members"), F.min(F.struct("own", "class", "size", "place")).alias("head")).where("members > 1")
    # Written, as a join in the stage that sums up would not be split.
    heads = stage(heads.select("token", "members", F.struct("head.class", "head.size", "head.place", "head.own").alias("centre")), "heads")
    return stage(rows.join(heads.hint("merge"), "token").select(*rows.columns, "centre", "members"), "index")


def _packed(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, "body"):
                words = words_of(part, "body", lower=True)
                names = [class_of(s) if len(s) else None for s in gram_sets(words, words.hashes(), n)]
                data, ends = bytes_of(part.column("body"))
                first = {name: k for k, name in reversed([*enumerate(names)]) if name is not None}
                texts = [packer.compress(data[ends[k] : ends[k + 1]].tobytes()) for k in first.values()]
                yield pa.RecordBatch.from_arrays([pa.array([*first], pa.binary()), pa.array(texts, pa.binary())], ["class", "packed"])

    return rows


def texts_of(plain: DataFrame, classes: DataFrame, alike: Similarity) -> DataFrame:
    """(class, packed): one compressed text for each class in ``classes``."""
    every = plain.select("body").transform(map_arrow, _packed(alike.words), "class binary, packed binary")
    # One text a class and task first, so that a class of many copies meets no shuffle with all of them.
    return stage(every.groupBy("class").agg(F.min("packed").alias("packed")).join(classes, "class", "left_semi"), "texts")


PAIRS = "a binary, b binary, linked boolean, size int, gone array<bigint>, added array<bigint>"


def _verify(alike: Similarity):
    """Rows (PAIRS); with half of both or more in common also a's size, and what of a is gone in b and added there."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[bytes, np.ndarray] = {}

        def grams(name: bytes, packed: bytes) -> np.ndarray:
            if name not in recent:
                if len(recent) >= 200:
                    recent.pop(next(iter(recent)))
                part = pa.record_batch([pa.array([zstandard.decompress(packed)], pa.binary()).cast(pa.string())], ["body"])
                words = words_of(part, "body", lower=True)
                recent[name] = next(gram_sets(words, words.hashes(), alike.words))
            return recent[name]

        for batch in batches:
            linked, size, gone, added = [], [], [], []
            a, b, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "packed_a", "packed_b"))
            for k in range(len(a)):
                one, two = grams(a[k], x[k]), grams(b[k], y[k])
                both = np.intersect1d(one, two, assume_unique=True)
                linked.append(alike.linked(len(both), len(one), len(two)))
                near = 2 * len(both) >= len(one) + len(two) - len(both)
                size.append(len(one))
                for out, own in ((gone, one), (added, two)):
                    out.append(np.setdiff1d(own, both, assume_unique=True).view(np.int64) if near else None)
            arrays = [pa.array(linked, pa.bool_()), pa.array(size, pa.int32()), pa.array(gone, pa.list_(pa.int64())), pa.array(added, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *arrays], ["a", "b", "linked", "size", "gone", "added"])

    return rows


def verified(pairs: DataFrame, texts: DataFrame, alike: Similarity) -> DataFrame:
    """PAIRS for pairs (a, b) of classes."""
    side = lambda name: texts.select(F.col("class").alias(name), F.col("packed").alias(f"packed_{name}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "packed_a", "packed_b")
    return stage(met.transform(map_arrow, _verify(alike), PAIRS), "verified")


def _pair(a: str, b: str) -> tuple[Column, Column]:
    return F.least(F.col(a), F.col(b)).alias("a"), F.greatest(F.col(a), F.col(b)).alias("b")


def apart(near: DataFrame, roots: DataFrame, alike: Similarity) -> DataFrame:
    """(a, b): pairs close to one centre, not in one component, that share enough of what sets them apart from it.

    With d n-grams of the centre gone and e added, let f = (100 d + percent e) / (100 + percent), and S be
    size * (100 - percent) / (100 + percent): a document is linked to its centre when f <= S, and a linked pair must
    share f(x) + f(y) - S or more of these n-grams. Documents linked to the centre are in one component, so one of the
    pair has f > S and the other must share more than its own f: all but its first d + e - f, rare ones first, could
    be missing. Two that are not linked to the centre must both share more than their f.
    """
    p = alike.percent
    f = (100 * F.size("gone") + p * F.size("added")) / F.lit(100 + p)
    own = near.where("b <> a").select(F.col("a").alias("c"), F.col("b").alias("class"), "linked", (F.size("gone") + F.size("added") - F.floor(f)).alias("first"), "gone", "added")
    token = F.concat(F.transform("gone", lambda x: F.struct(x.alias("t"), F.lit(0).alias("side"))), F.transform("added", lambda x: F.struct(x.alias("t"), F.lit(1).alias("side"))))
    rows = own.select("c", "class", "linked", "first", F.explode(token).alias("token"))
    often = rows.groupBy(F.col("c").alias("often_c"), F.col("token").alias("often_token")).agg(F.count("*").alias("often"))
    rows = rows.join(often, (F.col("c") == F.col("often_c")) & (F.col("token") == F.col("often_token")))
    order = Window.partitionBy("c", "class").orderBy("often", "token")
    rows = rows.withColumn("strict", F.row_number().over(order) <= F.col("first")).where((F.col("often") > 1) & (F.col("strict") | ~F.col("linked")))
    rows = rows.join(roots.withColumnRenamed("vertex", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    rows = stage(rows.select("c", "token", "class", "linked", "strict", "root"), "apart")
    x, y = rows.where("strict").alias("x"), rows.where("NOT linked").alias("y")
    enough = F.col("x.linked") | (F.col("y.strict") & (F.col("x.class") < F.col("y.class")))
    met = x.join(y, (F.col("x.c") == F.col("y.c")) & (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & enough)
    return met.select(*_pair("x.class", "y.class")).distinct()


def links_of(plain: DataFrame, index: DataFrame, alike: Similarity) -> DataFrame:
    """(vertex, root): the components of all links between classes."""
    texts = texts_of(plain, index.select("class").distinct(), alike)
    star = index.select("members", F.struct("class", "size", "place", "own").alias("m"), F.col("centre").alias("c")).where(F.col("m.class") != F.col("c.class"))
    close = star.where(possible(alike, "m", "c") | (F.col("members") >= CROWD)).select(F.col("c.class").alias("a"), F.col("m.class").alias("b")).distinct()
    first = verified(close, texts, alike)
    joined = components(first.where("linked"))
    # the exact rest: documents of one entry that are not in one component yet; each was held against the centre
    entries = index.where(F.col("class") != F.col("centre.class")).withColumn("c", F.col("centre.class")).drop("centre", "members")
    entries = entries.join(joined.withColumnRenamed("vertex", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    counts = entries.groupBy("token", "root").agg(F.count("*").alias("n"))
    split = counts.groupBy("token").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1").select("token", "main")
    near = first.where("gone IS NOT NULL")
    is_near = near.select(F.col("a").alias("c"), F.col("b").alias("class"), F.lit(True).alias("near"))
    entries = entries.join(split, "token").join(is_near, ["c", "class"], "left").withColumn("near", F.coalesce("near", F.lit(False)))
    entries = stage(entries, "entries")
    m, r = entries.where(F.col("root") != F.col("main")).alias("m"), entries.alias("r")
    once = (F.col("r.root") == F.col("r.main")) | (F.col("m.class") < F.col("r.class"))
    met = m.join(r, (F.col("m.token") == F.col("r.token")) & (F.col("m.root") != F.col("r.root")) & ~(F.col("m.near") & F.col("r.near")) & once & possible(alike, "m", "r"))
    met = met.select(*_pair("m.class", "r.class"), F.least("m.asked", "r.asked").alias("asked"))
    met = met.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("asked").alias("asked")).where(F.col("shared") >= F.col("asked")).select("a", "b")
    known = first.select(*_pair("a", "b")).distinct()
    rest = verified(met.unionByName(apart(near, joined, alike)).distinct().join(known, ["a", "b"], "left_anti"), texts, alike)
    more = rest.where("linked")
    if more.isEmpty():
        return joined
    tree = joined.where(F.col("vertex") != F.col("root")).select(F.col("root").alias("a"), F.col("vertex").alias("b"))
    return components(tree.unionByName(more.select("a", "b")))


def groups(docs: DataFrame, alike: Similarity = Similarity(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, tie (hash of the text), n_shingles and component_id of every row."""
    plain = docs.select(F.col(key).cast("long").alias("row_key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = stage(plain.transform(map_arrow, _classes(alike.words), "row_key long, tie long, class binary, size long"), "classes")
    bytes_in = plain.select(F.sum(F.octet_length("body"))).first()[0] or 0
    sketch = _sketch.build(plain.select("body"), _keys(alike.words), _sketch.log_width(bytes_in / GRAM_BYTES, PER_GRAM), counted=True)
    joined = links_of(plain, index_of(plain, sketch, alike), alike)
    least = rows.where("class IS NOT NULL").groupBy("class").agg(F.min("row_key").alias("least"))
    named = least.join(joined.withColumnRenamed("vertex", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = attach(named, settled(roots), ["root"], "inner").select("class", "component_id")
    out = rows.join(ids, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("row_key")).otherwise(F.col("component_id"))
    return out.select(F.col("row_key").alias(key), "tie", F.col("size").alias("n_shingles"), own.alias("component_id"))


def one_each(docs: DataFrame, alike: Similarity = Similarity(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, all columns: of every group the row with the smallest key.

    Of rows with equal keys the one with the smallest hash of its text, of equal rows one. Rows without a key or
    without words are groups of their own text.
    """
    made = groups(docs, alike, key, text)
    name = F.when(F.col("component_id").isNotNull() & (F.col("n_shingles") > 0), F.struct(F.col("component_id").alias("id"), F.lit(0).cast("long").alias("tie")))
    name = F.coalesce(name, F.struct(F.col(key).cast("long").alias("id"), F.col("tie")))
    order = Window.partitionBy("group").orderBy(F.asc_nulls_last(key), "tie")
    stay = made.withColumn("group", name).withColumn("rank", F.row_number().over(order)).where("rank = 1")
    stay = stay.select(F.col(key).cast("long").alias("stay_key"), F.col("tie").alias("stay_tie"))
    whole = docs.select(row_struct(docs).alias("row"), quoted(key).cast("long").alias("row_key"), F.xxhash64(F.coalesce(quoted(text), F.lit(""))).alias("tie"))
    kept = whole.join(stay, F.col("row_key").eqNullSafe(F.col("stay_key")) & (F.col("tie") == F.col("stay_tie")), "left_semi")
    once = Window.partitionBy("row_key", "tie").orderBy(F.lit(0))
    return kept.withColumn("rank", F.row_number().over(once)).where("rank = 1").select(*unpacked(docs))


CHECK = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM doc WHERE len(w) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingle a JOIN shingle b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN sized x ON a = x.doc_id JOIN sized y ON b = y.doc_id WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT DISTINCT a AS doc_id, a AS other FROM edge UNION SELECT doc_id, b FROM reach JOIN edge ON other = a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM doc LEFT JOIN sized USING (doc_id) LEFT JOIN least USING (doc_id)
"""
