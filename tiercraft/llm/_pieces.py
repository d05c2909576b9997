"""Texts as lists of pieces that can be encoded one by one, with every different piece encoded once.

Splitting and the dictionary of a batch are Arrow operations; what a piece encodes to is remembered in the worker, up
to ``most`` pieces. ``spread`` puts the pieces' ids together again for whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tiercraft.llm._text import ragged

MOST = 400_000


class Memo:
    """Ids of pieces, kept end to end in one array; emptied when it holds more than ``most`` pieces.

    ``encode`` gives the ids of a list of pieces end to end, and how many each has.

    ``notes`` has what ``note`` makes of each piece's ids, in the same order.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], note: Callable[[np.ndarray], object] | None = None, most: int = MOST):
        self.encode, self.note, self.most = encode, note, most
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.empty(1 << 16, dtype=np.uint32)
        self.starts, self.counts = np.empty(1 << 16, dtype=np.int64), np.empty(1 << 16, dtype=np.int64)
        self.used = 0
        self.notes: list = []

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """For each piece its place in ``starts`` and ``counts``."""
        if len(self.index) + len(pieces) > max(self.most, 2 * len(pieces)):
            self.clear()
        index = self.index
        new = [x for x in pieces if x not in index]
        if new:
            made, counts = self.encode(new)
            at, total = len(index), int(counts.sum())
            while self.used + total > len(self.ids):
                self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
            while at + len(new) > len(self.counts):
                self.starts = np.concatenate((self.starts, np.empty_like(self.starts)))
                self.counts = np.concatenate((self.counts, np.empty_like(self.counts)))
            self.ids[self.used : self.used + total] = made
            self.counts[at : at + len(new)] = counts
            self.starts[at : at + len(new)] = self.used + np.cumsum(counts) - counts
            self.used += total
            if self.note:
                self.notes.extend(map(self.note, np.split(made, np.cumsum(counts)[:-1])))
            index.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(index.__getitem__, pieces), dtype=np.int64, count=len(pieces))


def listed(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where each row's pieces begin, the piece at each place as a number, and the different pieces."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = pc.dictionary_encode(lists.values[offsets[0] : offsets[-1]])
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return offsets - offsets[0], flat.indices.to_numpy(), flat.dictionary.to_pylist()


def spread(offsets: np.ndarray, codes: np.ndarray, place: np.ndarray, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows end to end, and where each row's ids begin (one more at the end); ``place`` from the memo."""
    if not len(codes):
        return np.empty(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
    at = place[codes]
    counts = memo.counts[at]
    ends = np.concatenate(([0], np.cumsum(counts)))
    return memo.ids[ragged(memo.starts[at], counts)], ends[offsets]


class PieceRows:
    """A row of numbers for each piece, made once for each different piece; emptied when it holds more than ``most``."""

    def __init__(self, make: Callable[[list[str]], np.ndarray], most: int = MOST):
        self.make, self.most = make, most
        self.index: dict[str, int] = {}
        self.rows = np.empty((0, 0))

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """For each piece its row in ``rows``."""
        if len(self.index) + len(pieces) > max(self.most, 2 * len(pieces)):
            self.index.clear()
        index = self.index
        new = [x for x in pieces if x not in index]
        if new:
            made, at = self.make(new), len(index)
            if len(self.rows) < at + len(new) or self.rows.shape[1:] != made.shape[1:]:
                grown = np.empty((2 * (at + len(new)), *made.shape[1:]), dtype=made.dtype)
                grown[:at] = self.rows[:at] if at else 0
                self.rows = grown
            self.rows[at : at + len(new)] = made
            index.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(index.__getitem__, pieces), dtype=np.int64, count=len(pieces))


def piece_numbers(texts: pa.Array, rows: PieceRows) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's words begin (one more at the end), and each word's place in ``rows``; NULL is empty."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets, codes, pieces = listed(lists)
    if not len(codes):
        return offsets, np.empty(0, dtype=np.int64)
    full = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) > 0
    if not full.all():  # what white space at either end of a text leaves
        some = full[codes]
        offsets, codes = np.concatenate(([0], np.cumsum(some)))[offsets], codes[some]
    return offsets, rows.numbers(pieces)[codes]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows of ``values`` from offset to offset; an empty run sums to 0."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), dtype=np.float64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full], axis=0, dtype=np.float64)
    return out
