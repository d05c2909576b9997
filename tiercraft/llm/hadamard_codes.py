"""Vector codes: every vector as one codebook index a part, found exactly in whole numbers.

A component x becomes floor(256 * x). A vector is cut into equal consecutive parts, each with a codebook of its own
that starts as that part of the first vectors by key; a round assigns every part to its nearest entry and moves the
entries to the floored means of their parts.

The nearest entry is looked for in the integer Walsh-Hadamard transform of part and entries, zero-padded to a power of
two n. The transform keeps squared distances but for a factor of n, so squared differences of coefficients, added up in
sequency order (fewest sign changes first, where most of the distance is), are at any time a lower bound: entries above
the whole distance of one candidate go before the remaining coefficients are looked at. All of it is integers: 64 bits
where the largest component allows, else Python's unbounded ones.

Spark reads the vectors once for their range, once for the first entries, once a round and once for the codes. Tasks
return sums per entry and position; the codebook (64 entries of one vector's length) is all that the driver holds.

Defined results: a vector that is NULL or holds a NULL, NaN or infinite component is left out. A vector shorter than the
longest one has zeros at its end, and so has the longest one up to a multiple of the parts. The first entries are
ordered by key, NULL last, then by vector, so rows with one key are entries each; of fewer vectors than entries all are.
Repeated rows get one code. An error over 63 bits is NULL, and so is the sum over its label. Extra columns are not read.
An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.llm._carry import quoted
from tiercraft.llm._tasks import map_arrow
from tiercraft.operators.attach import attach, settled
from tiercraft.session import stage

SCALE = 256
LONGEST = (1 << 63) - 1
#: Bits of one limb in which sums of unbounded numbers travel, and the vectors worked on at once.
LIMB, BLOCK = 40, 4096


@dataclass(frozen=True)
class Settings:
    parts: int = 16
    entries: int = 64
    rounds: int = 2

    def __post_init__(self) -> None:
        if not 1 <= self.entries <= 256:
            raise ValueError("an index is one byte: 1 to 256 entries")


@dataclass(frozen=True)
class Codebooks:
    """``books[part][entry]`` is a tuple of whole numbers; ``wide`` when 64 bits do not hold the distances."""

    books: tuple
    wide: bool

    @property
    def part_length(self) -> int:
        return len(self.books[0][0])

    def digest(self) -> str:
        numbers = (str(x) for part in self.books for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def arrays(self) -> list[np.ndarray]:
        kind = object if self.wide else np.int64
        return [np.array(part, dtype=kind).reshape(len(part), self.part_length) for part in self.books]


def transform(rows: np.ndarray) -> np.ndarray:
    """The integer Walsh-Hadamard transform of zero-padded rows, coefficients in sequency order."""
    n = 1 << max(0, rows.shape[1] - 1).bit_length()
    made = np.zeros((len(rows), n), dtype=rows.dtype)
    made[:, : rows.shape[1]] = rows
    half = 1
    while half < n:
        pairs = made.reshape(len(rows), n // (2 * half), 2, half)
        a, b = pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]
        made = np.stack([a, b], axis=2).reshape(len(rows), n)
        half *= 2
    return made[:, sequency(n)]


def sequency(n: int) -> np.ndarray:
    """Places of the coefficients by their number of sign changes."""
    signs = np.ones((1, 1), dtype=np.int8)
    while len(signs) < n:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row the nearest entry, ties to the lower index, and its squared distance."""
    x, e = transform(parts), transform(entries)
    n = x.shape[1]
    first = max(1, n // 4)
    so_far = sum((x[:, c, None] - e[None, :, c]) ** 2 for c in range(first))
    likely = so_far.argmin(axis=1)
    bound = so_far[np.arange(len(x)), likely] + ((x[:, first:] - e[likely, first:]) ** 2).sum(axis=1)
    row, entry = np.nonzero(so_far <= bound[:, None])
    so_far = so_far[row, entry]
    at = first
    while at < n:
        to = min(n, 2 * at)
        so_far = so_far + ((x[row, at:to] - e[entry, at:to]) ** 2).sum(axis=1)
        left = so_far <= bound[row]
        row, entry, so_far = row[left], entry[left], so_far[left]
        at = to
    # Pairs are in order of row and entry, and every row has at least the one that gave its bound.
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(so_far, starts)
    hit = np.flatnonzero(so_far == least[row])
    chosen = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]
    return entry[chosen], least // n


def integers(vectors: pa.Array, length: int, wide: bool) -> np.ndarray:
    """floor(256 * x) of all components, a row for each vector, zeros up to ``length``."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if wide:
        numbers = np.array([whole(x) for x in flat.tolist()], dtype=object)
    else:
        numbers = np.floor(flat * SCALE).astype(np.int64)
    made = np.zeros((len(sizes), length), dtype=numbers.dtype if len(numbers) else np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    made[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = numbers
    return made.astype(object) if wide else made


def whole(x: float) -> int:
    """floor(256 * x), exact also where 256 * x is no longer a double."""
    return int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE)


def is_kept(vector: str) -> Column:
    """Not NULL, and all components finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return quoted(vector).isNotNull() & ~F.exists(quoted(vector).cast("array<double>"), bad)


def _kept(vectors: DataFrame, vector: str, *others: Column) -> DataFrame:
    return vectors.where(is_kept(vector)).select(*others, quoted(vector).cast("array<double>").alias("vector"))


def learn(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> Codebooks | None:
    """The codebooks after all rounds; None where no vector is kept."""
    kept = _kept(vectors, vector, quoted(key).alias("key"))
    largest = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))
    length, top = kept.agg(F.max(F.size("vector")), F.max(largest)).first()
    if length is None:
        return None
    size = -(-length // settings.parts)
    # Twice the largest component is the largest difference, and n times a squared distance the largest sum.
    reach = whole(top or 0.0) + 1
    padded = 1 << max(0, size - 1).bit_length()
    wide = padded * max(size, 1) * (2 * reach) ** 2 >= 1 << 62
    limbs = max(1, -(-(reach.bit_length() + 64) // LIMB)) if wide else 1
    first = [r["vector"] for r in kept.orderBy(F.col("key").asc_nulls_last(), "vector").limit(settings.entries).collect()]
    rows = integers(pa.array(first, pa.list_(pa.float64())), size * settings.parts, wide).tolist()
    books = Codebooks(tuple(tuple(tuple(r[p * size : (p + 1) * size]) for r in rows) for p in range(settings.parts)), wide)
    for _ in range(settings.rounds):
        books = _moved(kept, books, limbs)
    return books


def _moved(kept: DataFrame, books: Codebooks, limbs: int) -> Codebooks:
    """Every entry at the floored mean of the parts nearest to it."""
    parts, entries, size = len(books.books), len(books.books[0]), books.part_length

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = books.arrays()
        total = np.zeros((parts, entries, size), dtype=object if books.wide else np.int64)
        count = np.zeros((parts, entries), dtype=np.int64)
        for block in _blocks(batches):
            rows = integers(block.column("vector"), parts * size, books.wide)
            for p in range(parts):
                own = rows[:, p * size : (p + 1) * size]
                index, _ = nearest(own, arrays[p])
                np.add.at(total[p], index, own)
                count[p] += np.bincount(index, minlength=entries)
        used = np.flatnonzero(count)
        flat = total.reshape(parts * entries, size)[used]
        # Limbs of a number: its lowest LIMB bits and so on, the last one with the sign.
        cut = [(flat >> (LIMB * k)) & ((1 << LIMB) - 1) if k < limbs - 1 else flat >> (LIMB * k) for k in range(limbs)]
        numbers = np.concatenate([count.ravel()[used][:, None], *cut], axis=1).astype(np.int64)
        place = np.arange(numbers.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, len(place)), pa.int32()), pa.array(np.tile(place, len(used)), pa.int32()), pa.array(numbers.ravel())],
            ["slot", "place", "number"],
        )

    found = map_arrow(kept.select("vector"), sums, "slot int, place int, number long")
    added = found.groupBy("slot", "place").agg(F.sum(F.col("number").cast("decimal(20,0)")).alias("number")).collect()
    by_slot: dict[int, dict[int, int]] = {}
    for slot, place, number in added:
        by_slot.setdefault(slot, {})[place] = int(number)

    def entry(p: int, e: int) -> tuple:
        numbers = by_slot.get(p * entries + e)
        if numbers is None:
            return books.books[p][e]
        return tuple(sum(numbers[1 + k * size + i] << (LIMB * k) for k in range(limbs)) // numbers[0] for i in range(size))

    return Codebooks(tuple(tuple(entry(p, e) for e in range(entries)) for p in range(parts)), books.wide)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def encode(vectors: DataFrame, books: Codebooks | None, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``key``, ``label``, the code (a byte a part) and the squared distance of every kept vector, summed over its parts."""
    kinds = [vectors.select(quoted(c)).schema.fields[0].dataType.simpleString() for c in (key, label)]
    schema = f"key {kinds[0]}, label {kinds[1]}, code binary, error long"
    kept = _kept(vectors, vector, quoted(key).alias("key"), quoted(label).alias("label"))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = books.arrays()
        parts, size = len(arrays), books.part_length
        for block in _blocks(batches):
            rows = integers(block.column("vector"), parts * size, books.wide)
            found = [nearest(rows[:, p * size : (p + 1) * size], arrays[p]) for p in range(parts)]
            index = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
            error = sum(f[1] for f in found)
            code = pa.FixedSizeBinaryArray.from_buffers(pa.binary(parts), len(index), [None, pa.py_buffer(index.tobytes())])
            errors = pa.array([x if x <= LONGEST else None for x in error.tolist()], pa.int64()) if books.wide else pa.array(error)
            yield pa.RecordBatch.from_arrays([block.column("key"), block.column("label"), code.cast(pa.binary()), errors], ["key", "label", "code", "error"])

    if books is None:
        return kept.where("false").selectExpr("key", "label", "cast(null AS binary) AS code", "cast(null AS bigint) AS error")
    return map_arrow(kept, codes, schema)


def digests(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()) -> DataFrame:
    """vec_id, code in hex, error, the errors of all vectors with that label (NULL is one label), and the codebooks' hash."""
    books = learn(vectors, key, vector, settings)
    coded = stage(encode(vectors, books, key, vector, label), "vector-codes")
    same = [F.col("label").isNull().alias("unlabelled"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("name")]
    rows = coded.select(F.col("key"), F.lower(F.hex("code")).alias("code"), "error", *same)
    added = F.sum(F.col("error").cast("decimal(38,0)"))
    whole_sum = F.when(F.count_if(F.col("error").isNull()) == 0, added.try_cast("bigint"))
    by_label = settled(rows.groupBy("unlabelled", "name").agg(whole_sum.alias("label_error")))
    joined = attach(rows, by_label, ["unlabelled", "name"])
    return joined.select(F.col("key").alias(key), "code", "error", "label_error", F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))


def _round_sql(number: int) -> str:
    before = f"book{number - 1}"
    return f"""near{number} AS (
      SELECT vec_id, p, any_value(x) AS x, min({{'far': list_sum(list_transform(range(1, d + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i]))), 'e': e}}) AS best
      FROM (SELECT * FROM parts JOIN (SELECT p AS q, e, y FROM {before}) b ON parts.p = b.q) GROUP BY vec_id, p),
    mean{number} AS (
      SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS y FROM (
        SELECT p, best.e AS e, i, sum(x[i])::HUGEINT AS s, count(*) AS c FROM near{number}, (SELECT unnest(range(1, d + 1)) AS i FROM dims) GROUP BY ALL) GROUP BY p, e),
    book{number} AS (SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM {before} b LEFT JOIN mean{number} m ON m.p = b.p AND m.e = b.e)"""


#: The query in SQL: plain distances to all entries, for tables whose keys are unique.
CHECK = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, embedding AS v, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dims AS (SELECT max(len(v)) // 16 AS d FROM kept),
parts AS MATERIALIZED (
  SELECT vec_id, n, p, d, list_transform(v[p * d + 1 : (p + 1) * d], lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS x
  FROM kept, dims, (SELECT unnest(range(16)) AS p)),
book0 AS (SELECT p, n AS e, x AS y FROM parts WHERE n < 64),
{_round_sql(1)},
{_round_sql(2)},
{_round_sql(3)},
coded AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.far)::BIGINT AS error FROM near3 GROUP BY vec_id)
SELECT coded.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept ON kept.vec_id = coded.vec_id
"""
