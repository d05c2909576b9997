"""BPE encoding and decoding with a contiguous rank array, for vocabularies with word ends.

A word is held as two short arrays side by side: the ids of its parts and the rank of the merge at each boundary. The
lowest rank is found by scanning, its boundary deleted, the ranks of the two neighbouring boundaries refreshed, until
no boundary has a rank. Words of similar length are rows of one numpy matrix and take their steps together. Words of
over ``SHORT`` bytes keep their boundaries in a linked list with a heap instead, so that a text without spaces costs
n log n. Every different word of a batch is encoded once.

The file is the JSON of the tokenizers library: NFC, white space, lower case; words by the file's pattern; bytes as
printable characters; special tokens found in the raw text. Nothing of that library is used here.

Defined results: NULL and empty texts have no ids and the decoded text ''. Repeated rows are encoded each. An empty
table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.llm._pieces import Memo, listed, spread
from tiercraft.llm._text import slices
from tiercraft.llm._tasks import map_arrow

SHORT = 64
NONE = np.int32(2**31 - 1)
SLICE_BYTES = 4 << 20


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else the next one from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class RankBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = dict(zip([*vocabulary.values(), *self.special.values()], [*vocabulary, *self.special], strict=True))
        self.symbol = np.array([vocabulary[c] for c in byte_characters()], dtype=np.int32)
        self.last = np.array([vocabulary[c + suffix] for c in byte_characters()], dtype=np.int32)
        merges = [(vocabulary[a], vocabulary[b]) for a, b in spec["model"]["merges"]]
        self.made = np.array([vocabulary[a + b] for a, b in spec["model"]["merges"]], dtype=np.int32)
        keys = np.array([a << 20 | b for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")["pattern"]["Regex"]
        self.pattern = regex.compile(split.replace(r"\s", r"\p{White_Space}"))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of merging left with right, NONE where there is no such merge or either is missing (-1)."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge_short(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of at most SHORT bytes; the words are rows that take their steps together."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = int(sizes.max())
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        row, column = np.repeat(np.arange(len(words)), sizes), np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        parts = np.full((len(words), width + 1), -1, dtype=np.int32)
        parts[row, column] = self.symbol[data]
        ends = np.cumsum(sizes) - 1
        parts[np.arange(len(words)), sizes - 1] = self.last[data[ends]]
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        done: list[np.ndarray | None] = [None] * len(words)
        which, columns = np.arange(len(words)), np.arange(width)
        while len(which):
            least = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(which)), least]
            over = rank == NONE
            if over.any():
                for i, ids, n in zip(which[over].tolist(), parts[over], (parts[over] >= 0).sum(axis=1).tolist(), strict=True):
                    done[i] = ids[:n].astype(np.uint32)
                go = ~over
                which, parts, ranks, least, rank = which[go], parts[go], ranks[go], least[go], rank[go]
                if not len(which):
                    break
            rows = np.arange(len(which))
            parts[rows, least] = self.made[rank]
            shift = columns[None, :] > least[:, None]
            parts[:, :-1] = np.where(shift, parts[:, 1:], parts[:, :-1])
            ranks[:, :-1] = np.where(shift[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            # the boundaries on either side of the new part
            after = np.minimum(least + 1, width)
            ranks[rows, least] = np.where(least < width, self.rank(parts[rows, least], parts[rows, after]), NONE)
            inner = np.flatnonzero(least > 0)
            before = least[inner] - 1
            ranks[inner, before] = self.rank(parts[inner, before], parts[inner, before + 1])
        return done

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: boundaries in a linked list, ranks in a heap; the leftmost lowest rank goes first."""
        data = np.frombuffer(word, dtype=np.uint8)
        parts = self.symbol[data].tolist()
        parts[-1] = int(self.last[data[-1]])
        n = len(parts)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        first = self.rank(np.array(parts[:-1], dtype=np.int32), np.array(parts[1:], dtype=np.int32)).tolist()
        heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def push(i: int, j: int) -> None:
            pair = parts[i], parts[j]
            if pair not in known:
                known[pair] = int(self.rank(np.array([pair[0]], dtype=np.int32), np.array([pair[1]], dtype=np.int32))[0])
            if known[pair] != NONE:
                heapq.heappush(heap, (known[pair], i, *pair))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if parts[i] == left else -1
            if j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return np.array([x for x in parts if x >= 0], dtype=np.uint32)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word (not empty), in any mixture of lengths."""
        out: list[np.ndarray | None] = [None] * len(words)
        groups: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            n = len(word)
            groups.setdefault(0 if n > SHORT else max(4, 1 << (n - 1).bit_length()), []).append(i)
        for width, members in groups.items():
            for at in range(0, len(members), 20_000):
                some = members[at : at + 20_000]
                ids = self.merge_short([words[i] for i in some]) if width else map(self.merge_long, (words[i] for i in some))
                for i, x in zip(some, ids, strict=True):
                    out[i] = x
        return out

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, end to end, and their numbers, of pieces that hold no white space at which texts were split; a special token is a piece of its own."""
        words: list[bytes] = []
        number: dict[bytes, int] = {}
        plan = []
        for piece in pieces:
            if piece in self.special:
                plan.append(self.special[piece])
                continue
            text = piece.lower() if piece.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", piece)))
            own = []
            for word in self.pattern.findall(text):
                word = word.encode()
                if word not in number:
                    number[word] = len(words)
                    words.append(word)
                own.append(number[word])
            plan.append(own)
        ids = self.merge(words)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        counts, parts = np.empty(len(plan), dtype=np.int64), []
        for k, own in enumerate(plan):
            if isinstance(own, int):
                parts.append(np.array([own], dtype=np.uint32))
                counts[k] = 1
            else:
                parts.extend([ids[i] for i in own])
                counts[k] = sizes[own[0]] if len(own) == 1 else sizes[own].sum() if own else 0
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint32), counts

    def pieces_of(self, texts: pa.Array) -> pa.Array:
        """Each text as a list of pieces: words at ASCII white space, special tokens taken out first."""
        lists = pc.ascii_split_whitespace(texts)
        if self.special:
            held = pc.match_substring_regex(texts, self.special_pattern.pattern).to_numpy(zero_copy_only=False)
            if held.any():
                plain = lists.to_pylist()
                for i in np.flatnonzero(held):
                    plain[i] = list(self._with_special(texts[i].as_py()))
                lists = pa.array(plain, type=lists.type)
        return lists

    def _with_special(self, text: str) -> Iterator[str]:
        at = 0
        for found in self.special_pattern.finditer(text):
            yield from pc.ascii_split_whitespace(text[at : found.start()]).as_py()
            yield found.group()
            at = found.end()
        yield from pc.ascii_split_whitespace(text[at:]).as_py()

    def decode(self, ids) -> str:
        """The tokens of the ids, joined by spaces (the file names no decoder)."""
        return " ".join([self.tokens[i] for i in ids])


#: Pieces that a worker remembers with their ids and decoded text, some 500 bytes each.
PIECES = 150_000
_open: dict[str, tuple[RankBpe, Memo]] = {}


def opened(path: str) -> tuple[RankBpe, Memo]:
    """The encoder of a file and what it has encoded, once in a worker."""
    if path not in _open:
        _open.clear()
        bpe = RankBpe(path)
        _open[path] = (bpe, Memo(bpe.encode_pieces, lambda ids: bpe.decode(ids.tolist()), most=PIECES))
    return _open[path]


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Ids of all texts end to end, where each text's ids begin, and the decoded texts."""
    bpe, memo = opened(path)
    offsets, codes, pieces = listed(bpe.pieces_of(texts))
    place = memo.numbers(pieces)
    ids, ends = spread(offsets, codes, place, memo)
    decoded = [memo.notes[i] for i in place.tolist()]
    some = memo.counts[place][codes] > 0 if len(codes) else np.empty(0, dtype=bool)
    kept = np.concatenate(([0], np.cumsum(some)))[offsets]
    taken = pa.array(decoded, type=pa.large_string()).take(pa.array(codes[some]))
    lists = pa.ListArray.from_arrays(pa.array(kept, type=pa.int32()), taken)
    return ids, ends, pc.binary_join(lists, pa.scalar(" ", type=pa.large_string()))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``ids`` (binary: little-endian unsigned 32-bit numbers) and ``decoded`` text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from encoded(batches)
        finally:
            if path in _open:
                _open[path][1].clear()  # what this task has encoded; the next may be of another kind

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "piece_text", SLICE_BYTES):
                texts = pc.fill_null(part.column("piece_text"), "")
                ids, ends, decoded = encode_texts(texts, path)
                # 64-bit offsets all the way: a long text has many more bytes of ids than of text
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([part.column("row_key"), packed.cast(pa.binary()), decoded.cast(pa.string())], ["row_key", "ids", "decoded"])

    taken = docs.select(F.col(key).alias("row_key"), F.col(text).alias("piece_text"))
    kind = taken.schema["row_key"].dataType.simpleString()
    return taken.transform(map_arrow, run, f"row_key {kind}, ids binary, decoded string").withColumnRenamed("row_key", key)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Numbers of tokens and SHA-256 of ids and decoded text."""
    return encoded.select(
        key,
        n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
