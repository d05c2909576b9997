"""Substring deduplication: words covered by a 50-word window that an earlier document has as well are removed.

A window is judged on its whole word sequence, against all documents with a smaller key, on the input as it is.

First pass: a count-min sketch. A window is counted through its anchor, the smallest hash among the 25-word runs that
it covers; equal windows have equal anchors, so the count of the anchor is never below the count of the window, and a
dozen windows share an anchor. Second pass: only windows whose anchor is estimated to occur twice or more leave their
task, as two independent 64-bit hashes with document and place, and are grouped exactly. Within a slice of some
megabytes only the smallest document of equal windows asks, in one row with those of equal key; the others are known to
go. So a window that a third of all documents share, with keys or without, is a row per slice and not a row per
document. Last, documents and the places to remove meet
in one shuffle, sorted so that a document's places come before its text.

Defined results: NULL and empty texts have no words (NULL comes back empty); shorter texts have no windows. Keys
are numbers, or text of numbers (other text counts as NULL, or is an error in ANSI mode). A NULL key counts as 2**63 - 1,
no smaller than any other. Rows with equal keys, also repeated rows, are not earlier than each other; their texts are
told apart by 96 bits of hashes. An empty table gives an empty table. Other columns are carried along; they go in one struct, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiercraft.llm import _sketch
from tiercraft.llm._carry import row_struct, unpacked
from tiercraft.llm._text import mix, signed, slices, window_hashes, words_of
from tiercraft.llm._tasks import map_arrow

SLICE_BYTES = 16 << 20
#: Counters of the sketch for each estimated anchor; about one anchor is made per 80 bytes of text.
PER_ANCHOR, ANCHOR_BYTES = 8.0, 80
LAST = 2**63 - 1
#: ``place`` has the second hash of the text in its upper half; ``more`` are the other rows of that key with the window.
OPEN = "h1 long, h2 long, row_key long, tie long, place long, run int, more array<struct<tie:long,place:long>>"


def anchors(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """For every window of n words (by its first word) the smallest hash of the runs of about n / 2 words in it."""
    size = max(1, n // 2)
    runs = window_hashes(words, np.arange(len(words) - size + 1), size, which=3)
    reach, step = n - size + 1, 1
    while 2 * step <= reach:
        runs = np.minimum(runs[:-step], runs[step:])
        step *= 2
    return np.minimum(runs[first], runs[first + reach - step])


def _anchor_keys(n: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for part in slices(batch, "body"):
                words = words_of(part, "body")
                first, row = words.rows_of(n)
                if len(first):
                    found = anchors(words.hashes(), first, n)
                    # neighbours of one document mostly share their anchor
                    yield found[np.concatenate(([True], (found[1:] != found[:-1]) | (row[1:] != row[:-1])))]

    return keys


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers as runs of consecutive ones: first number and length."""
    begins = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1)))
    return at[begins], np.diff(np.append(begins, len(at)))


def _candidates(sketch: Broadcast, n: int):
    """Rows (OPEN): run 0 asks for a smaller document with the window; a positive run is known to go."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body", SLICE_BYTES):
                found = _slice_candidates(part, sketch.value, n)
                if found is not None:
                    yield found

    return rows


def _repeated(part: pa.RecordBatch, sketch: _sketch.Sketch, n: int) -> list[np.ndarray]:
    """Two hashes, row and place of the windows that may repeat."""
    words = words_of(part, "body")
    first, row = words.rows_of(n)
    hashes = words.hashes()
    some = sketch.repeated(anchors(hashes, first, n)) if len(first) else np.empty(0, dtype=bool)
    first, row = first[some], row[some]
    return [window_hashes(hashes, first, n, 1), window_hashes(hashes, first, n, 2), row, (first - words.first[row]).astype(np.int64)]


def _slice_candidates(part: pa.RecordBatch, sketch: _sketch.Sketch, n: int) -> pa.RecordBatch | None:
    found, before = [], 0
    for small in slices(part, "body"):
        h1, h2, row, place = _repeated(small, sketch, n)
        found.append((h1, h2, row + before, place))
        before += small.num_rows
    h1, h2, row, place = (np.concatenate(x) for x in zip(*found, strict=True))
    if not len(h1):
        return None
    own = {c: part.column(c).to_numpy() for c in ("row_key", "tie", "tie2")}
    key = own["row_key"][row]
    order = np.lexsort((key, h2, h1))
    a, b, k = h1[order], h2[order], key[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    least = k[np.flatnonzero(new)][np.cumsum(new) - 1]
    known = np.zeros(len(order), dtype=bool)
    known[order] = k > least
    # known windows as runs, for each row of the table
    go = np.flatnonzero(known)
    begin, length = _runs(row[go] * (1 << 40) + place[go]) if len(go) else (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    at = begin >> 40
    where = own["tie2"].astype(np.int64)[row] << np.int64(32) | place
    # of the windows that stay open the first row of each asks, and names the others of its key
    asks, others = order[new], order[~new & (k == least)]
    counts = np.bincount((np.cumsum(new) - 1)[~new & (k == least)], minlength=len(asks))
    # a known window meets no other: its row is dealt by where it is
    alike = mix(own["tie"][at].view(np.uint64) ^ mix(begin.astype(np.uint64)))
    ends = np.concatenate(([0], np.cumsum(counts), np.full(len(at), counts.sum()))).astype(np.int32)
    named = pa.StructArray.from_arrays([pa.array(own["tie"][row[others]]), pa.array(where[others])], ["tie", "place"])
    alone = np.concatenate((counts == 0, np.ones(len(at), dtype=bool)))
    return pa.RecordBatch.from_arrays(
        [
            signed(np.concatenate((h1[asks], alike))),
            signed(np.concatenate((h2[asks], np.zeros(len(at), dtype=np.uint64)))),
            pa.array(np.concatenate((key[asks], own["row_key"][at]))),
            pa.array(np.concatenate((own["tie"][row[asks]], own["tie"][at]))),
            pa.array(np.concatenate((where[asks], own["tie2"].astype(np.int64)[at] << np.int64(32) | begin & ((1 << 40) - 1)))),
            pa.array(np.concatenate((np.zeros(len(asks), dtype=np.int32), length.astype(np.int32)))),
            pa.ListArray.from_arrays(pa.array(ends), named, mask=pa.array(alone)),
        ],
        ["h1", "h2", "row_key", "tie", "place", "run", "more"],
    )


WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def gone(n_words: int, places: list[tuple[int, int]], n: int) -> np.ndarray:
    """Which words go; places are (window, run of windows)."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    at = np.array(places, dtype=np.int64).reshape(-1, 2)
    np.add.at(edge, at[:, 0], 1)
    np.add.at(edge, at[:, 0] + at[:, 1] + n - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def keep(body: bytes, places: list[tuple[int, int]], n: int, as_it_is: bool) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the kept words: joined by a space, or ``as_it_is`` spaced as they were."""
    words = body.split()
    if not places:
        return len(words), 0, body if as_it_is else b" ".join(words)
    lost = gone(len(words), places, n)
    if as_it_is:
        kept = _spaced(body, lost.tolist())
    else:
        kept = b" ".join([w for w, x in zip(words, lost.tolist(), strict=True) if not x])
    return len(words), int(lost.sum()), kept


def _spaced(body: bytes, lost: list[bool]) -> bytes:
    """The kept words with the white space between them; where words went, a line feed if there was one, else a space."""
    out, end, cut = [], 0, False
    for found, x in zip(WORD.finditer(body), lost, strict=True):
        if not x:
            between = body[end : found.start()]
            if cut:
                between = (b"\n" if b"\n" in between else b" ") if out else b""
            out += [between, found.group()]
            end = found.end()
        cut = x
    return b"".join(out)


def _remove(n: int, as_it_is: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, places = None, []
        for batch in batches:
            kept = []
            names = list(zip(*(batch.column(c).to_pylist() for c in ("row_key", "tie", "tie2")), strict=True))
            starts, runs = (batch.column(c).to_pylist() for c in ("place", "run"))
            bodies = batch.column("body")
            is_text = batch.column("is_text").to_numpy(zero_copy_only=False)
            rest = batch.column("rest")
            texts = np.flatnonzero(is_text)
            for k, name in enumerate(names):
                if name != now:
                    now, places = name, []
                if not is_text[k]:
                    places.append((starts[k], runs[k]))
                else:
                    kept.append(keep((bodies[k].as_py() or "").encode(), places, n, as_it_is))
            if kept:
                counts, removed, text = zip(*kept, strict=True)
                yield pa.RecordBatch.from_arrays([rest.take(pa.array(texts)), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(text, pa.binary()).cast(pa.string())], ["rest", "n_words", "n_removed", "kept_text"])

    return run


def _removed(docs: DataFrame, n: int, key: str, text: str, as_it_is: bool) -> DataFrame:
    """rest (all columns but the text, as a struct), n_words, n_removed and kept_text of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    # Two hashes, 96 bits, tell the texts of one key apart.
    name = [F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("row_key"), F.xxhash64(body).alias("tie"), F.hash(body).alias("tie2")]
    plain = docs.select(*name, body.alias("body"))
    size = plain.select(F.sum(F.octet_length("body"))).first()[0] or 0
    width = _sketch.log_width(size / ANCHOR_BYTES, PER_ANCHOR)
    sketch = _sketch.build(plain.select("body"), _anchor_keys(n), width)
    asked = plain.transform(map_arrow, _candidates(sketch, n), OPEN)
    rank = F.rank().over(Window.partitionBy("h1", "h2").orderBy("row_key"))
    gone = asked.withColumn("rank", rank).where((F.col("run") > 0) | (F.col("rank") > 1))
    who = F.concat(F.array(F.struct("tie", "place")), F.coalesce("more", F.array().cast("array<struct<tie:bigint,place:bigint>>")))
    gone = gone.select("row_key", F.greatest("run", F.lit(1)).alias("run"), F.explode(who).alias("who")).select(
        "row_key", "who.tie", F.shiftright("who.place", 32).cast("int").alias("tie2"), F.col("who.place").bitwiseAND(F.lit(2**32 - 1).cast("long")).cast("int").alias("place"), "run"
    )
    rest = row_struct(docs, without=(text,))
    whole = docs.select(rest.alias("rest"), *name, F.lit(True).alias("is_text"), F.lit(0).alias("place"), F.lit(0).alias("run"), F.col(text).alias("body"))
    none = F.lit(None)
    places = gone.select(none.cast(whole.schema["rest"].dataType).alias("rest"), "row_key", "tie", "tie2", F.lit(False).alias("is_text"), "place", "run", none.cast("string").alias("body"))
    met = whole.unionByName(places)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(partitions, "row_key", "tie").sortWithinPartitions("row_key", "tie", "tie2", "is_text")
    kind = whole.schema["rest"].dataType.simpleString()
    return met.transform(map_arrow, _remove(n, as_it_is), f"rest {kind}, n_words long, n_removed long, kept_text string")


def remove(docs: DataFrame, n: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_words, n_removed and kept_text (kept words joined by one space) of every row."""
    return _removed(docs.select(key, text), n, key, text, False).select(F.col("rest")["c0"].alias(key), "n_words", "n_removed", "kept_text")


def clean(docs: DataFrame, n: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, without their repeated words; the words that stay keep the white space between them.

    A document that loses all its words goes; one that had none stays.
    """
    made = _removed(docs, n, key, text, True).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return made.select(*unpacked(docs, "rest", **{text: F.col("kept_text")}))


def digests(removed: DataFrame, key: str = "doc_id") -> DataFrame:
    return removed.select(key, "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


CHECK = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS body FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc)),
gone AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY body) AS least FROM windows) WHERE doc_id > least),
covered AS (SELECT DISTINCT doc_id, i + k AS i FROM gone, (SELECT unnest(range(50)) AS k)),
listed AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
word AS (SELECT doc_id, i, w[i] AS one FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc SEMI JOIN listed USING (doc_id))),
left_over AS (SELECT doc_id, list(one ORDER BY i) AS kept FROM word ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE coalesce(kept, []) END, ' ')) AS kept_sha256
FROM doc LEFT JOIN listed USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""
