"""Quality classifier with learned subword vectors: a document is the mean of its words' vectors, a word the mean of
the vectors of its hashed form and hashed character n-grams; softmax on top, trained by numpy stochastic gradient
descent. Repetition is seen through two added words, one for a word said twice, one for words that go round in a loop.

The labelled rows used for training are a sample: those with the smallest hashes of their key, at most ``sample_rows``
rows and ``sample_bytes`` bytes of whole texts (a single text over ``longest_text`` bytes is not trained on), whatever
the size of the table. Training runs in one task on that sample; scoring reads every whole text, and a word's vector is
made once for each different word of a batch.

Defined results: NULL, empty and wordless texts get the score of a document without words (the model's bias). With no
labelled rows every score is 0.5. Labels other than 0 and 1, and NULL labels, are left out. Repeated rows get the same
answer each. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiercraft.llm._pieces import PieceRows, piece_numbers, sums
from tiercraft.llm._text import slices
from tiercraft.llm._tasks import map_arrow
from tiercraft.llm.word_language import below
from tiercraft.session import stage

SLICE_BYTES = 4 << 20
CLASSES = 2
#: Words of their own that stand for a word that repeats the one before it, and for a word that goes on repeating two
#: or more words of up to LAG words before. They are added to a document's words.
SAME, LOOP, LAG = "\x01", "\x02", 24


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 6_000
    sample_bytes: int = 64 << 20
    longest_text: int = 1 << 20
    buckets: int = 1 << 16
    dim: int = 8
    shortest: int = 2
    longest: int = 4
    epochs: int = 8
    rate: float = 1.0
    seed: int = 7


@dataclass
class Model:
    vectors: np.ndarray  # buckets x dim
    weights: np.ndarray  # classes x dim
    bias: np.ndarray
    settings: Settings

    def to_bytes(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, vectors=self.vectors, weights=self.weights, bias=self.bias)
        return file.getvalue()

    @staticmethod
    def of_bytes(data: bytes, settings: Settings) -> Model:
        got = np.load(io.BytesIO(data))
        return Model(got["vectors"], got["weights"], got["bias"], settings)


def subwords(word: str, settings: Settings) -> list[int]:
    """Buckets of a word and of its character n-grams, with ``<`` and ``>`` at its ends (FNV-1a over UTF-8)."""
    padded = f"<{word}>"
    out = []
    for part in [padded, *[padded[i : i + n] for n in range(settings.shortest, settings.longest + 1) for i in range(len(padded) - n + 1)]]:
        h = 2166136261
        for b in part.encode():
            h = (h ^ b) * 16777619 & 0xFFFFFFFF
        out.append((h ^ h >> 15) % settings.buckets)
    return out


def subword_table(words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words end to end, and how many each has; the same numbers as ``subwords``, for many words at once."""
    data = np.frombuffer(" ".join(f"<{w}>" for w in words).encode("utf-32-le"), dtype=np.uint32)
    # hashes over UTF-8 bytes, character by character
    breaks = np.flatnonzero(data == 32)
    begins = np.concatenate(([0], breaks + 1))
    ends = np.concatenate((breaks, [len(data)]))
    sizes = ends - begins

    def step(h: np.ndarray, code: np.ndarray) -> np.ndarray:
        wide = code.astype(np.uint64)
        one, two, three = code < 0x80, code < 0x800, code < 0x10000
        parts = [
            (~three, 0xF0 | wide >> 18),
            (~two, np.where(three, 0xE0 | wide >> 12, 0x80 | wide >> 12 & 0x3F)),
            (~one, np.where(two, 0xC0 | wide >> 6, 0x80 | wide >> 6 & 0x3F)),
            (np.ones(len(code), dtype=bool), np.where(one, wide, 0x80 | wide & 0x3F)),
        ]
        for some, byte in parts:
            h = np.where(some, (h ^ byte) * np.uint64(16777619) & np.uint64(0xFFFFFFFF), h)
        return h

    last = lambda h: ((h ^ h >> np.uint64(15)) % np.uint64(settings.buckets)).astype(np.int64)
    owners, found = [], []
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(begins, sizes) + place
    h = np.full(len(at), 2166136261, dtype=np.uint64)
    for n in range(1, settings.longest + 1):
        ok = place + n <= sizes[word]
        word, place, at, h = word[ok], place[ok], at[ok], h[ok]
        h = step(h, data[at + n - 1])
        if n >= settings.shortest:
            owners.append(word), found.append(last(h))
    whole, active = np.full(len(words), 2166136261, dtype=np.uint64), np.arange(len(words))
    for k in range(int(sizes.max()) if len(sizes) else 0):
        active = active[sizes[active] > k]
        whole[active] = step(whole[active], data[begins[active] + k])
    owners.append(np.arange(len(words))), found.append(last(whole))
    owner, bucket = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.bincount(owner, minlength=len(words))


def repeats(place: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often SAME and LOOP are added to each document; ``place`` has a number for each different word."""
    at = np.arange(len(place)) - np.repeat(offsets[:-1], np.diff(offsets))
    same, loop = np.zeros(len(place), dtype=bool), np.zeros(len(place), dtype=bool)
    for lag in range(1, min(LAG, len(place) - 1) + 1):
        equal = np.zeros(len(place), dtype=bool)
        equal[lag:] = (place[lag:] == place[:-lag]) & (at[lag:] >= lag)
        if lag == 1:
            same = equal
        else:
            loop[1:] |= equal[1:] & equal[:-1] & (at[1:] > lag)
    return sums(np.stack((same, loop), axis=1).astype(np.float64), offsets)


def fit(texts: list[str], labels: np.ndarray, settings: Settings) -> Model:
    """Stochastic gradient descent, a document a step; the rate falls to nothing over the epochs."""
    rng = np.random.default_rng(settings.seed)
    model = Model(rng.uniform(-1 / settings.dim, 1 / settings.dim, (settings.buckets, settings.dim)).astype(np.float32), np.zeros((CLASSES, settings.dim), dtype=np.float32), np.zeros(CLASSES, dtype=np.float32), settings)
    known: dict[str, int] = {SAME: 0, LOOP: 1}
    docs = []
    for text in texts:
        place = np.array([known.setdefault(w, len(known)) for w in _words(text)], dtype=np.int64)
        words, counts = np.unique(place, return_counts=True)
        marks = repeats(place, np.array([0, len(place)]))[0]
        docs.append((np.concatenate((words, [0, 1])), np.concatenate((counts, marks))) if len(words) else (words, counts))
    if not docs:
        return model
    buckets, sizes = subword_table([*known], settings)
    starts = np.cumsum(sizes) - sizes
    made = []
    for words, counts in docs:
        if not len(words):
            made.append((np.empty(0, dtype=np.int64), np.empty(0, dtype=np.float32)))
            continue
        n = sizes[words]
        index = np.repeat(starts[words] - np.cumsum(n) + n, n) + np.arange(n.sum())
        share = np.bincount(buckets[index], weights=np.repeat(counts / n / counts.sum(), n), minlength=settings.buckets)
        some = np.flatnonzero(share)
        made.append((some, share[some].astype(np.float32)))
    steps = settings.epochs * len(made)
    for step in range(steps):
        if step % len(made) == 0:
            order = rng.permutation(len(made))
        some, share = made[order[step % len(made)]]
        rate = settings.rate * (1 - step / steps)
        rows = model.vectors[some]
        mean = share @ rows
        error = softmax(model.weights @ mean + model.bias)
        error[labels[order[step % len(made)]]] -= 1
        pull = error @ model.weights
        model.weights -= rate * np.outer(error, mean)
        model.bias -= rate * 0.1 * error
        # a bucket's share of a document is small; scaled so that rare buckets learn at all
        model.vectors[some] = rows - (rate * len(some) ** 0.5) * np.outer(share, pull)
    return model


def _words(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The model of the labelled documents; ``labels`` has (key, label)."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    hashed = marked.withColumn("hashed", F.xxhash64(F.col(key).cast("string"), F.lit("sample")))
    # A key has one row here, so twice the rows are expected to be enough; they may go to every task.
    some = hashed.where(below(F.col("hashed"), F.lit((2.0 * settings.sample_rows + 100) / max(marked.count(), 1))))
    plain = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("body")).where(F.octet_length("body") <= settings.longest_text)
    rows = plain.join(F.broadcast(some), key).select(F.col(key).cast("string").alias("k"), "body", "y", "hashed")
    # Only what fits into the sample leaves its task; bytes are added up over those rows.
    order = ["hashed", "k", "body"]
    first = rows.orderBy(*order).limit(settings.sample_rows)
    running = F.sum(F.octet_length("body")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = first.withColumn("bytes", running).where(F.col("bytes") <= settings.sample_bytes).select("k", "body", "y")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([*batches] or [pa.RecordBatch.from_pylist([], schema=pa.schema([("k", pa.string()), ("body", pa.string()), ("y", pa.int32())]))])
        table = table.sort_by([("k", "ascending"), ("y", "ascending")])
        model = fit(table["body"].to_pylist(), table["y"].to_numpy(), settings)
        yield pa.RecordBatch.from_pylist([{"model": model.to_bytes()}])

    made = stage(rows.repartition(1).transform(map_arrow, train, "model binary"), "model")
    row = made.first()
    return Model.of_bytes(bytes(row["model"]), settings) if row else fit([], np.empty(0, dtype=np.int64), settings)


def _score(shared: Broadcast):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        # what a word adds to the two sides, before the mean over words
        sides = model.vectors @ model.weights.T

        def make(pieces: list[str]) -> np.ndarray:
            buckets, sizes = subword_table(pieces, model.settings)
            return (sums(sides[buckets], np.concatenate(([0], np.cumsum(sizes)))) / sizes[:, None]).astype(np.float32)

        table, marks = PieceRows(make, 500_000), make([SAME, LOOP])
        for batch in batches:
            for part in slices(batch, "body", SLICE_BYTES):
                offsets, place = piece_numbers(part.column("body"), table)
                added = repeats(place, offsets)
                n = np.diff(offsets) + added.sum(axis=1)
                total = (sums(table.rows[place], offsets) if len(place) else np.zeros((part.num_rows, CLASSES))) + added @ marks
                chance = softmax(total / np.maximum(n, 1)[:, None] + model.bias)[:, 1]
                yield pa.RecordBatch.from_arrays([part.column("row_key"), pa.array(chance.astype(np.float64))], ["row_key", "score"])

    return rows


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and score (chance of label 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.select(F.col(key).alias("row_key"), F.col(text).alias("body"))
    kind = plain.schema["row_key"].dataType.simpleString()
    return plain.transform(map_arrow, _score(shared), f"row_key {kind}, score double").withColumnRenamed("row_key", key)
