"""Benchmark decontamination with spaced seeds.

Texts become words in lower case, with ASCII punctuation as white space. A seed is a fixed mask; it hashes the words
at its ones and ignores the others, so words replaced at the ignored places do not hide a match. Seeds of the test
items and of the training documents are joined on their hash; around every hit the words of both are compared on the
same alignment, and an overlap counts when, in a window of ``window`` words (or the whole item, when shorter), at
least ``percent`` of 100 are equal.

Items shorter than the window are cut into one block more than words may differ: some block is then equal, so blocks
are their seeds, masks without a gap, and every alignment that counts is found. Documents are looked through with the
block lengths that some item has. Items of fewer than ``shortest`` words are not searched for: they are phrases.

Documents are read once. A filter of the test hashes (a sketch of bounded size, none is lost) leaves few places; the
words around those, and no others, leave the task. The joins are Spark's, on either side's size: an item that a third
of all documents quote is one row on the side of the tests.

Defined results: NULL and empty texts overlap with nothing. Rows with a NULL key, and items with a NULL id, are reported
under it. Keys and ids are numbers. Repeated documents or items are reported once; different texts of one key are
reported, and cleaned, each for itself; items of one id are one item of several texts. An empty table on either side
gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.llm import _sketch
from tiercraft.llm._carry import quoted, row_struct, unpacked
from tiercraft.llm._text import BASES, LOWER, U64, Words, bytes_of, mix, signed, slices
from tiercraft.llm._tasks import map_arrow
from tiercraft.session import stage

PLAIN = LOWER.copy()
PLAIN[[b for b in range(33, 128) if not chr(b).isalnum()]] = 0x20


@dataclass(frozen=True)
class Seeds:
    #: All have eight ones. The first finds quotes as they are, the next two words replaced at every fifth or sixth place,
    #: the others replacements without a rhythm. Together they hit a 13-word window whichever two of its words are replaced.
    masks: tuple[str, ...] = ("11111111", "111101111", "11111000111", "1101100101011", "1110010110101", "11100110111", "110101011011")
    window: int = 13
    percent: int = 80
    shortest: int = 5

    def block(self, words: int) -> int:
        """Length of the blocks of an item of so many words, one block more than words may differ."""
        return words // (words * (100 - self.percent) // 100 + 1)

    def all_masks(self) -> list[str]:
        """The spaced masks, then the blocks of every length that short items can have."""
        return [*self.masks, *["1" * n for n in sorted({max(1, self.block(m)) for m in range(self.shortest, self.window)})]]


def words_of(part: pa.RecordBatch) -> Words:
    data, rows = bytes_of(part.column("body"))
    return Words(PLAIN[data], rows)


def seed_hashes(hashes: np.ndarray, first: np.ndarray, mask: str, which: int) -> np.ndarray:
    """The hash of the masked words from each word in ``first``."""
    out = np.full(len(first), (which + 1) * 0x9E3779B97F4A7C15 % 2**64, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k, one in enumerate(mask):
            if one == "1":
                out = out * U64(BASES[1]) + hashes[first + k]
    return mix(out)


def _items(seeds: Seeds):
    """The seeds of items: all places of the spaced masks, or the disjoint blocks of a short item."""
    masks = seeds.all_masks()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                words = words_of(part)
                hashes = words.hashes()
                ids = part.column("item").to_numpy()
                size = np.diff(words.first)
                own = np.array([max(1, seeds.block(n)) if seeds.shortest <= n < seeds.window else 0 for n in size.tolist()], dtype=np.int64)
                for which, mask in enumerate(masks):
                    first, row = words.rows_of(len(mask))
                    place = first - words.first[row]
                    if which < len(seeds.masks):
                        some = size[row] >= seeds.window
                    else:
                        some = (own[row] == len(mask)) & (place % len(mask) == 0)
                    first, row, place = first[some], row[some], place[some]
                    if len(first):
                        seed = signed(seed_hashes(hashes, first, mask, which))
                        yield pa.RecordBatch.from_arrays([seed, pa.array(ids[row]), pa.array(place.astype(np.int32)), pa.array(np.full(len(first), which, dtype=np.int32))], ["seed", "item", "item_place", "which"])

    return rows


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "body"):
            words = words_of(part)
            hashes = words.hashes()
            cuts = [hashes[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("item"), part.column("item_key"), pa.array(cuts, pa.binary())], ["item", "item_key", "item_words"])


REGION = "row_key long, tie long, start int, doc_words binary, seeds array<bigint>, places array<int>"


def _regions(known: Broadcast, seeds: Seeds, used: list[int]):
    """Rows (REGION): the words around the places that may be hits, close ones together, and the seeds there.

    ``used`` are the masks that some item has.
    """
    masks = [(which, mask) for which, mask in enumerate(seeds.all_masks()) if which in used]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                found = []
                words = words_of(part)
                hashes = words.hashes()
                at, row, seed = [], [], []
                for which, mask in masks:
                    first, of = words.rows_of(len(mask))
                    if len(first):
                        made = seed_hashes(hashes, first, mask, which)
                        some = known.value.repeated(made)
                        at.append(first[some]), row.append(of[some]), seed.append(made[some])
                if not at or not sum(map(len, at)):
                    continue
                at, row, seed = np.concatenate(at), np.concatenate(row), np.concatenate(seed)
                order = np.argsort(at, kind="stable")
                at, row, seed = at[order], row[order], seed[order]
                reach = seeds.window + max(map(len, seeds.masks))
                new = np.flatnonzero(np.concatenate(([True], (np.diff(at) > reach) | (row[1:] != row[:-1]))))
                keys, ties = part.column("row_key"), part.column("tie")
                for a, b in zip(new, np.append(new[1:], len(at)), strict=True):
                    r = int(row[a])
                    begin = max(words.first[r], at[a] - reach)
                    end = min(words.first[r + 1], at[b - 1] + 2 * reach)
                    found.append((keys[r].as_py(), ties[r].as_py(), int(begin - words.first[r]), hashes[begin:end].tobytes(), seed[a:b].view(np.int64), (at[a:b] - begin).astype(np.int32)))
                names = ["row_key", "tie", "start", "doc_words", "seeds", "places"]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)

    return rows


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, seeds: Seeds) -> tuple[int, int, int] | None:
    """First and last word (after it) of the good windows and the equal words in them; item word k is doc word k + shift."""
    size = min(seeds.window, len(item))
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if high - low < size:
        return None
    equal = item[low:high] == doc[low + shift : high + shift]
    sums = np.concatenate(([0], np.cumsum(equal)))
    good = np.flatnonzero(100 * (sums[size:] - sums[:-size]) >= seeds.percent * size)
    if not len(good):
        return None
    cover = np.zeros(len(equal) + 1, dtype=np.int64)
    cover[good] += 1
    cover[good + size] -= 1
    inside = np.cumsum(cover[:-1]) > 0
    return int(low + shift + good[0]), int(low + shift + good[-1] + size), int(equal[inside].sum())


def _verify(seeds: Seeds):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                doc, item = np.frombuffer(x["doc_words"], dtype=np.uint64), np.frombuffer(x["item_words"], dtype=np.uint64)
                span = overlap(doc, item, x["shift"], seeds)
                if span is not None:
                    out.append((x["row_key"], x["tie"], x["item_key"], x["start"] + span[0], x["start"] + span[1], span[2], len(item)))
            if out:
                types = [pa.int64(), pa.int64(), pa.int64(), *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["row_key", "tie", "item_key", "first_word", "last_word", "equal_words", "item_words"])

    return rows


def _tie(text: str) -> Column:
    """Tells the texts of one key apart."""
    return F.xxhash64(F.coalesce(quoted(text), F.lit("")))


def _overlaps(docs: DataFrame, items: DataFrame, seeds: Seeds, key: str, text: str, item_key: str, item_text: str) -> DataFrame:
    """row_key, tie, item_key, first_word, last_word, equal_words and item_words, a row for each text of a key and item."""
    body = F.coalesce(F.col(item_text), F.lit(""))
    tests = items.select(F.col(item_key).cast("long").alias("item_key"), body.alias("body")).distinct()
    # A number of its own for each id and text, as an id may be NULL or have several texts.
    tests = tests.withColumn("item", F.xxhash64(F.col("item_key").isNull(), "item_key", "body"))
    index = stage(tests.transform(map_arrow, _items(seeds), "seed long, item long, item_place int, which int").distinct(), "seeds")
    n = index.count()
    used = [r["which"] for r in index.select("which").distinct().collect()]

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            found = batch.column("seed").to_numpy().view(np.uint64)
            yield np.concatenate((found, found))  # twice, as the sketch answers for keys that occur twice

    known = _sketch.build(index.select("seed"), seen, _sketch.log_width(n, 32))
    plain = docs.select(F.col(key).cast("long").alias("row_key"), _tie(text).alias("tie"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    regions = stage(plain.transform(map_arrow, _regions(known, seeds, used), REGION), "regions")
    name = ["row_key", "tie", "start"]
    hits = regions.select(*name, F.explode(F.arrays_zip("seeds", "places")).alias("hit")).select(*name, F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("place"))
    lined = hits.join(index.drop("which"), "seed").select(*name, "item", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    words = regions.select(*[F.col(c).alias(f"region_{c}") for c in name], "doc_words").dropDuplicates([f"region_{c}" for c in name])
    same = F.col("row_key").eqNullSafe(F.col("region_row_key")) & (F.col("tie") == F.col("region_tie")) & (F.col("start") == F.col("region_start"))
    of_items = tests.transform(map_arrow, _tokens, "item long, item_key long, item_words binary")
    met = lined.join(words, same).join(of_items, "item").select("row_key", "tie", "item_key", "start", "shift", "doc_words", "item_words")
    found = met.transform(map_arrow, _verify(seeds), "row_key long, tie long, item_key long, first_word int, last_word int, equal_words int, item_words int")
    return found.groupBy("row_key", "tie", "item_key").agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.max("equal_words").alias("equal_words"), F.max("item_words").alias("item_words"))


def overlaps(docs: DataFrame, items: DataFrame, seeds: Seeds = Seeds(), key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Key, item key, first_word, last_word (after it), equal_words (most of one alignment) and item_words, a row for each text of a key and item."""
    out = _overlaps(docs, items, seeds, key, text, item_key, item_text).drop("tie")
    return out.withColumnRenamed("row_key", key).withColumnRenamed("item_key", item_key)


def clean(docs: DataFrame, items: DataFrame, seeds: Seeds = Seeds(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, that overlap with no item; other texts of the same key, or without a key, stay."""
    bad = _overlaps(docs, items, seeds, key, text, "item_id", "text").select(F.col("row_key").alias("bad_key"), F.col("tie").alias("bad_tie")).distinct()
    whole = docs.select(row_struct(docs).alias("row"), quoted(key).cast("long").alias("row_key"), _tie(text).alias("tie"))
    same = F.col("row_key").eqNullSafe(F.col("bad_key")) & (F.col("tie") == F.col("bad_tie"))
    return whole.join(bad, same, "left_anti").select(*unpacked(docs))
