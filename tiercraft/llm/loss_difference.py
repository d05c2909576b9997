"""Cross-entropy difference: a target and a background bigram model over one vocabulary; their loss per token scores a document.

Tokens are words in lower case without punctuation at their ends. The vocabulary is every token of the corpus; a
setting can limit it to the ``words`` most frequent, any other token is then one of sixteen shapes (digits, signs,
capitals). Every document begins after a start token. Both models count all bigrams, the background over all documents,
the target over those marked.

Counts are exact and stay in Spark, so the models grow with the corpus. A slice is the documents of about
``SLICE_BYTES`` of text, as codes of its own distinct tokens. Every slice sends its distinct bigrams and tokens with
their counts, dealt by key, to be added up, and gets the sums of its own keys back: a key is one entry a slice, however
many documents hold it, and no table of the models is in one place. Keys are 64-bit hashes of tokens and of pairs.

p(b | a) = (n(a, b) + strength * p(b)) / (n(a) + strength), p(b) = (n(b) + 1) / (n + ids); ids are the vocabulary, the
shapes and the start token. A loss is the mean of -log2 p over a document's tokens; the difference is target minus
background, lower for what is more like the target.

Defined results: NULL, empty and wordless texts have 0 tokens and NULL losses. Without marked documents the target
model is uniform. A NULL key is never marked. Repeated rows count, and are scored, each. An empty table gives an empty
table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tiercraft.llm._pieces import PieceRows, piece_numbers, sums
from tiercraft.llm._text import BASES, U64, mix, slices
from tiercraft.llm._tasks import map_arrow
from tiercraft.session import stage

SLICE_BYTES = 16 << 20
#: A bucket of keys is added up in memory; it gets the keys of about so many tokens.
BUCKET_TOKENS = 2_000_000
START = 0
TOKEN_BYTES = 4 << 20
SHAPES = 16
EDGES = ".,;:!?\"'()[]{}«»„“”‚‘’¿¡…"


@dataclass(frozen=True)
class Settings:
    words: int | None = None
    strength: float = 100.0


def token(piece: str) -> str:
    return piece.lower().strip(EDGES) or piece.lower()


def shape(piece: str) -> int:
    """Which of the sixteen classes an unknown token is in."""
    core = piece.strip(EDGES) or piece
    digit = any(map(str.isdigit, core))
    return digit + 2 * (not core.isalnum()) + 4 * core[:1].isupper() + 8 * (core.isupper() and len(core) > 1)


def token_hash(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


class Ids:
    """Ids of pieces: the hash of the token, or 1 to 16 for the shapes of what is not in a given vocabulary."""

    def __init__(self, vocabulary: frozenset[str] | None):
        self.vocabulary = vocabulary
        self.table = PieceRows(self.make, 400_000)

    def make(self, pieces: list[str]) -> np.ndarray:
        known = self.vocabulary
        tokens = map(token, pieces)
        return np.array([[token_hash(t) if known is None or t in known else 1 + shape(p)] for p, t in zip(pieces, tokens, strict=True)], dtype=np.uint64).reshape(-1, 1)


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers as compressed byte planes."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "body", TOKEN_BYTES):
            counted = pc.value_counts(pc.ascii_split_whitespace(part.column("body")).flatten())
            tokens: dict[str, int] = {}
            for piece, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist(), strict=True):
                if piece:
                    name = token(piece)
                    tokens[name] = tokens.get(name, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array([*tokens], pa.string()), pa.array([*tokens.values()], pa.int64())], ["token", "n"])


def _slices(vocabulary: Broadcast | None, kind: pa.DataType, slice_bytes: int):
    """A row for about every ``slice_bytes`` of text: keys, tokens and marks of the documents, and the distinct tokens."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(vocabulary.value if vocabulary else None)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "body", slice_bytes):
                offsets, place = piece_numbers(part.column("body"), ids.table)
                made = ids.table.rows[place, 0] if len(place) else np.empty(0, dtype=np.uint64)
                names, codes = np.unique(made, return_inverse=True)
                n, flags = np.diff(offsets), part.column("marked").to_numpy(zero_copy_only=False).astype(np.int64)
                row = {"slice": number, "keys": part.column("row_key").to_pylist(), "lengths": pack(n), "flags": pack(flags), "names": pack(names)}
                row |= {"codes": zstandard.compress(codes.astype(np.int32).tobytes(), 3), "n": int(n.sum()), "n_marked": int((n * flags).sum())}
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.list_(kind) if k == "keys" else None) for k, v in row.items()], [*row])
                number += 1

    return rows


class Slice:
    """The keys of a slice in order: its distinct bigrams, and each of its tokens as the first and as the second of a bigram."""

    def __init__(self, lengths: bytes, names: bytes, codes: bytes):
        self.lengths = unpack(lengths)
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths)))
        ids = np.concatenate((np.array([START], dtype=np.uint64), unpack(names).view(np.uint64)))
        second = np.frombuffer(zstandard.decompress(codes), dtype=np.int32).astype(np.int64) + 1
        first = np.zeros_like(second)
        first[1:] = second[:-1]
        first[self.offsets[:-1][self.lengths > 0]] = 0
        self.size = len(ids)
        pairs, self.pair = np.unique(first * self.size + second, return_inverse=True)
        self.first, self.second = pairs // self.size, pairs % self.size
        with np.errstate(over="ignore"):
            kinds = (mix(ids) * U64(BASES[1]), mix(ids ^ U64(BASES[2])), mix(ids ^ U64(BASES[3])))
            keys = np.concatenate((mix(kinds[0][self.first] + mix(ids)[self.second]), kinds[1], kinds[2]))
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def counts(self, weight: np.ndarray | None = None) -> np.ndarray:
        """How often the slice has each key; ``weight`` (0 or 1) for each document."""
        every = None if weight is None else np.repeat(weight, self.lengths)
        of_pairs = np.bincount(self.pair, every, len(self.first))
        made = (of_pairs, np.bincount(self.first, of_pairs, self.size), np.bincount(self.second, of_pairs, self.size))
        return np.concatenate(made).astype(np.int64)[self.order]

    def losses(self, totals: np.ndarray, n: int, ids: int, strength: float) -> np.ndarray:
        """-log2 p of each distinct bigram, from the corpus' counts of each key."""
        count = np.empty(len(totals), dtype=np.int64)
        count[self.order] = totals
        of_pairs, of_first, of_second = np.split(count, [len(self.first), len(self.first) + self.size])
        of_b = (of_second[self.second] + 1) / (n + ids)
        return -np.log2((of_pairs + strength * of_b) / (of_first[self.first] + strength))


def dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of sorted keys that are not empty, and where each begins (one more at the end)."""
    of = ((keys >> U64(32)) * U64(buckets)) >> U64(32)
    found, begin = np.unique(of, return_index=True)
    return found.astype(np.int32), np.append(begin, len(keys))


def _parts(buckets: int):
    """Rows: the keys of a slice that are in a bucket, as differences, with their counts in both models."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in map(lambda k: batch.slice(k, 1).to_pylist()[0], range(batch.num_rows)):
                own = Slice(x["lengths"], x["names"], x["codes"])
                every, marked = own.counts(), own.counts(unpack(x["flags"]))
                found, begin = dealt(own.keys, buckets)
                cuts = [slice(a, b) for a, b in zip(begin[:-1], begin[1:], strict=True)]
                made = [[pack(np.diff(own.keys[c], prepend=U64(0))) for c in cuts], [pack(every[c]) for c in cuts], [pack(marked[c]) for c in cuts]]
                yield pa.RecordBatch.from_arrays([pa.array([x["slice"]] * len(cuts), pa.int64()), pa.array(found), *[pa.array(m, pa.binary()) for m in made]], ["slice", "bucket", "part_keys", "every", "marked"])

    return rows


def _names(buckets: int):
    """Rows (bucket, part_keys): the hashes of a slice's tokens that are in a bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("names").to_pylist():
                names = unpack(packed).view(np.uint64)
                found, begin = dealt(names, buckets)
                parts = [pack(np.diff(names[a:b], prepend=U64(0))) for a, b in zip(begin[:-1], begin[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(parts, pa.binary())], ["bucket", "part_keys"])

    return rows


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[dict]]:
    """Rows with the same value, which follow each other."""
    some: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if some and row[column] != some[0][column]:
                yield some
                some = []
            some.append(row)
    if some:
        yield some


def keys_of(part: dict) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(unpack(part["part_keys"]).view(np.uint64))


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some in runs(batches, "bucket"):
        n = len(np.unique(np.concatenate([keys_of(x) for x in some])))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some in runs(batches, "bucket"):
        keys = [keys_of(x) for x in some]
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        made = []
        for model in ("every", "marked"):
            total = np.zeros(len(found), dtype=np.int64)
            np.add.at(total, place, np.concatenate([unpack(x[model]) for x in some]))
            made.append([pack(t) for t in np.split(total[place], ends)])
        yield pa.RecordBatch.from_arrays([pa.array([x["slice"] for x in some], pa.int64()), pa.array([x["bucket"] for x in some], pa.int32()), *[pa.array(m, pa.binary()) for m in made]], ["slice", "bucket", "every", "marked"])


def _score(kind: pa.DataType, n: int, n_marked: int, ids: int, strength: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, *parts in runs(batches, "slice"):  # the slice itself has bucket -1
            own = Slice(x["lengths"], x["names"], x["codes"])
            mean = []
            for model, total in (("marked", n_marked), ("every", n)):
                totals = np.concatenate([np.empty(0, dtype=np.int64), *[unpack(p[model]) for p in parts]])
                each = own.losses(totals, total, ids, strength)[own.pair]
                mean.append(sums(each, own.offsets) / np.maximum(own.lengths, 1))
            made = [pa.array(m, mask=own.lengths == 0) for m in (*mean, mean[0] - mean[1])]
            yield pa.RecordBatch.from_arrays([pa.array(x["keys"], kind), pa.array(own.lengths), *made], ["row_key", "n_tokens", "target_loss", "background_loss", "difference"])

    return rows


def score(docs: DataFrame, marked: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_tokens, target_loss, background_loss and difference of every row; ``marked`` has the target's keys."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(key).alias("row_key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    vocabulary = None
    if settings.words is not None:
        counts = plain.select("body").transform(map_arrow, _token_counts, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
        top = counts.orderBy(F.desc("n"), "token").limit(settings.words)  # the vocabulary, where the caller limits it
        vocabulary = spark.sparkContext.broadcast(frozenset(r["token"] for r in top.collect()))
    target = marked.select(F.col(key).alias("marked_key")).where("marked_key IS NOT NULL").distinct().withColumn("marked", F.lit(True))
    # a merge join at every size: marked documents are as many as the corpus lets them be
    flagged = plain.join(target.hint("merge"), F.col("row_key") == F.col("marked_key"), "left").select("row_key", "body", F.coalesce("marked", F.lit(False)).alias("marked"))
    kind = plain.schema["row_key"].dataType.simpleString()
    arrow = to_arrow_type(plain.schema["row_key"].dataType)
    cut = "slice long, keys array<" + kind + ">, lengths binary, flags binary, names binary, codes binary"
    whole = stage(flagged.transform(map_arrow, _slices(vocabulary, arrow, SLICE_BYTES), f"{cut}, n long, n_marked long"), "slices")
    n, n_marked = (x or 0 for x in whole.agg(F.sum("n"), F.sum("n_marked")).first())
    buckets = max(4 * partitions, n // BUCKET_TOKENS)
    if vocabulary is None:
        names = whole.select("names").transform(map_arrow, _names(buckets), "bucket int, part_keys binary").repartition(partitions, "bucket").sortWithinPartitions("bucket")
        words = names.transform(map_arrow, _different, "n long").agg(F.sum("n")).first()[0] or 0
    else:
        words = len(vocabulary.value)
    parts = whole.select("slice", "lengths", "flags", "names", "codes").transform(map_arrow, _parts(buckets), "slice long, bucket int, part_keys binary, every binary, marked binary")
    totals = parts.repartition(partitions, "bucket").sortWithinPartitions("bucket").transform(map_arrow, _totals, "slice long, bucket int, every binary, marked binary")
    own = whole.select("slice", F.lit(-1).alias("bucket"), "keys", "lengths", "names", "codes")
    met = own.unionByName(totals, allowMissingColumns=True).repartition(partitions, "slice").sortWithinPartitions("slice", "bucket")
    out = met.transform(map_arrow, _score(arrow, n, n_marked, 1 + SHAPES + words, settings.strength), f"row_key {kind}, n_tokens long, target_loss double, background_loss double, difference double")
    return out.withColumnRenamed("row_key", key)
