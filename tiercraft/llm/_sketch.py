"""A count-min sketch that saturates at two: which keys may occur more than once.

Each task fills a sketch of its own and sends it as compressed pieces of 2**20 counters; pieces of the same place are
added up in Spark, saturating, so nothing passes through one task. The merged sketch has one bit a counter (counted
twice or more) and is at most ``2 * 2**MAX_LOG_WIDTH`` bits, which bounds what is broadcast. An estimate is never below
the true count: a key that occurs twice is always found. With more keys than the widest sketch has counters more
keys pass than need to, and none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tiercraft.llm._text import U64
from tiercraft.llm._tasks import map_arrow

ROWS = 2
PIECE = 20
MAX_LOG_WIDTH = 30
FLUSH = 4_000_000
FACTORS = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)]
SCHEMA = "slot int, one binary, two binary"
#: Counters of the frequency estimate (no saturation), and how many go in one piece.
COUNTERS, COUNTERS_PIECE = 1 << 20, 1 << 16


def log_width(keys: float, per_key: float) -> int:
    """Width for so many keys with ``per_key`` counters each, up to the widest."""
    return int(min(MAX_LOG_WIDTH, max(PIECE, np.ceil(np.log2(max(keys * per_key, 1))))))


def place(keys: np.ndarray, row: int, width: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (keys * FACTORS[row]) >> U64(64 - width)


def counter(keys: np.ndarray) -> np.ndarray:
    return (keys & U64(COUNTERS - 1)).astype(np.int64)


class PartitionSketch:
    """The sketch of one task's keys; holds at most FLUSH keys before their pieces are sent."""

    def __init__(self, width: int, counted: bool = False):
        self.width = width
        self.counts = np.zeros(COUNTERS, dtype=np.int64) if counted else None
        self.held: list[np.ndarray] = []
        self.n = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(keys)
        self.n += len(keys)
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        keys = np.concatenate(self.held)
        self.held, self.n = [], 0
        if self.counts is not None:
            self.counts += np.bincount(counter(keys), minlength=COUNTERS)
        packer = zstandard.ZstdCompressor(level=1)
        pack = lambda bits: packer.compress(np.packbits(bits).tobytes())
        for row in range(ROWS):
            at = np.sort(place(keys, row, self.width).astype(np.uint32))
            new = np.concatenate(([True], at[1:] != at[:-1]))
            once = at[new]
            twice = once[np.diff(np.append(np.flatnonzero(new), len(at))) > 1]
            pieces = 1 << (self.width - PIECE)
            cuts = np.searchsorted(once >> PIECE, np.arange(pieces + 1)), np.searchsorted(twice >> PIECE, np.arange(pieces + 1))
            for k in range(pieces):
                sent = []
                for found, cut in zip((once, twice), cuts, strict=True):
                    bits = np.zeros(1 << PIECE, dtype=bool)
                    bits[found[cut[k] : cut[k + 1]] & ((1 << PIECE) - 1)] = True
                    sent.append(pack(bits) if cut[k + 1] > cut[k] else None)
                if sent[0] is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([row * pieces + k], pa.int32()), pa.array([sent[0]], pa.binary()), pa.array([sent[1]], pa.binary())], ["slot", "one", "two"])

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self.flush()
        if self.counts is not None and self.counts.any():
            packer = zstandard.ZstdCompressor(level=1)
            for k in range(COUNTERS // COUNTERS_PIECE):
                part = self.counts[k * COUNTERS_PIECE : (k + 1) * COUNTERS_PIECE].astype("<i8")
                yield pa.RecordBatch.from_arrays([pa.array([-1 - k], pa.int32()), pa.array([packer.compress(part.tobytes())], pa.binary()), pa.nulls(1, pa.binary())], ["slot", "one", "two"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slot, once, twice = None, None, np.zeros(0)

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([twice.tobytes()], pa.binary())], ["slot", "bits"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != slot:
                if slot is not None and twice.any():
                    yield done()
                slot = row[0]
                once, twice = (np.zeros(1 << PIECE - 3, dtype=np.uint8) for _ in range(2)) if slot >= 0 else (None, np.zeros(COUNTERS_PIECE, dtype="<i8"))
            if slot < 0:
                twice += np.frombuffer(zstandard.decompress(row[1]), dtype="<i8")
                continue
            one = np.frombuffer(zstandard.decompress(row[1]), dtype=np.uint8)
            twice |= once & one
            once |= one
            if row[2] is not None:
                twice |= np.frombuffer(zstandard.decompress(row[2]), dtype=np.uint8)
    if slot is not None and twice.any():
        yield done()


class Sketch:
    """The merged sketch: whether keys are estimated to occur twice or more."""

    def __init__(self, width: int, pieces: Iterable[tuple[int, bytes]]):
        self.width = width
        size = 1 << PIECE - 3
        self.bits = np.zeros(ROWS << (width - 3), dtype=np.uint8)
        self.counts = np.zeros(COUNTERS, dtype=np.int64)
        for slot, bits in pieces:
            if slot < 0:
                self.counts[(-1 - slot) * COUNTERS_PIECE : -slot * COUNTERS_PIECE] = np.frombuffer(bits, dtype="<i8")
                continue
            self.bits[slot * size : (slot + 1) * size] = np.frombuffer(bits, dtype=np.uint8)

    def frequency(self, keys: np.ndarray) -> np.ndarray:
        """How often keys occur, never less than that; where frequencies were counted."""
        return self.counts[counter(keys)]

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for row in range(ROWS):
            at = place(keys, row, self.width).astype(np.int64)
            found &= (self.bits[(row << (self.width - 3)) + (at >> 3)] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return found


def build(docs: DataFrame, keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], width: int, counted: bool = False) -> Broadcast:
    """The broadcast sketch of the keys that ``keys_of`` finds in the batches of ``docs``."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = PartitionSketch(width, counted)
        for keys in keys_of(batches):
            yield from sketch.add(keys)
        yield from sketch.close()

    spark = docs.sparkSession
    slots = ROWS << (width - PIECE)
    parts = min(slots, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    merged = docs.transform(map_arrow, fill, SCHEMA).repartition(parts, "slot").sortWithinPartitions("slot").transform(map_arrow, _merge, "slot int, bits binary")
    # at most 2 * 2**MAX_LOG_WIDTH bits, whatever the input
    return spark.sparkContext.broadcast(Sketch(width, ((row["slot"], bytes(row["bits"])) for row in merged.toLocalIterator())))
