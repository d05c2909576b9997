"""Words of whole Arrow batches as numpy arrays: boundaries, hashes and dictionaries, without a Python loop per word.

A word is a longest run of ``[^\\x20\\x09-\\x0D]``. Word hashes are 64-bit polynomials over the bytes (random byte
values, odd base, modulo 2**64) with a final mix; a sequence of words is hashed the same way over its word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.default_rng(20240229)
BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASES = [int(x) | 1 for x in _random.integers(2**62, 2**63, 4, dtype=np.uint64)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that makes every output bit depend on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and base**-k modulo 2**64 for k below n; kept in the worker until ``forget``, at most 2**20 of each."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.empty(size, dtype=np.uint64)
            p[0], done = 1, 1
            with np.errstate(over="ignore"):
                while done < size:
                    p[done : 2 * done] = p[:done] * U64(pow(b, done, 1 << 64))
                    done *= 2
            made.append(p)
        have = (made[0], made[1])
        if size <= 1 << 20:
            _powers[base] = have
    return have


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs of bytes from ``start`` to ``end``."""
    up, down = powers(BASES[0], max(1, len(data)))
    with np.errstate(over="ignore"):
        sums = np.empty(len(data) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
        # An empty run may begin behind the last byte, where there is no power to divide by.
        own = (sums[end] - sums[start]) * down[np.minimum(start, max(0, len(data) - 1))]
    return mix(own ^ (end - start).astype(np.uint64))


def forget() -> None:
    """Drop the powers that are kept, some 64 MB when all bases are in use."""
    _powers.clear()


class Words:
    """Words of several texts: row r has the words ``first[r]`` to ``first[r + 1]``; ``start`` and ``end`` are bytes.

    ``space`` says which bytes are between words.
    """

    def __init__(self, data: np.ndarray, rows: np.ndarray, space: np.ndarray = SPACE):
        self.data = data
        full = ~space[data]
        begins, ends = full.copy(), full.copy()
        begins[1:] &= ~full[:-1]
        ends[:-1] &= ~full[1:]
        cut = rows[(rows > 0) & (rows < len(data))]
        begins[cut] |= full[cut]
        ends[cut - 1] |= full[cut - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, rows)

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.empty(0, dtype=np.uint64)
        return byte_hashes(self.data, self.start, self.end)

    def rows_of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For every window of n words within a row: its first word and its row."""
        counts = np.maximum(np.diff(self.first) - n + 1, 0)
        row = np.repeat(np.arange(len(counts)), counts)
        before = np.concatenate(([0], np.cumsum(counts)))[:-1]
        return np.arange(counts.sum()) - before[row] + self.first[:-1][row], row


def window_hashes(words: np.ndarray, begin: np.ndarray, n: int, which: int = 1) -> np.ndarray:
    """Hash of the n words from each index in ``begin``; ``which`` (1 to 3) picks an independent function."""
    if not len(begin):
        return np.empty(0, dtype=np.uint64)
    up, down = powers(BASES[which], len(words))
    with np.errstate(over="ignore"):
        sums = np.empty(len(words) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(words * up[: len(words)], out=sums[1:])
        return mix((sums[begin + n] - sums[begin]) * down[begin])


def string_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column if not isinstance(column, pa.ChunkedArray) else pa.concat_arrays(column.chunks)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each row's offset in them, without a copy; NULL is empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    rows = rows.astype(np.int64)
    if data is None:
        return np.empty(0, dtype=np.uint8), rows - rows[0]
    return np.frombuffer(data, dtype=np.uint8)[rows[0] : rows[-1]], rows - rows[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose text has about ``limit`` bytes (a longer text is a run of its own)."""
    if not batch.num_rows:
        return
    _, rows = bytes_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(rows, rows[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def words_of(batch: pa.RecordBatch, column: str, lower: bool = False) -> Words:
    data, rows = bytes_of(batch.column(column))
    return Words(LOWER[data] if lower else data, rows)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one run after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
