"""Token ids in shard files: fixed-size blocks, each transposed into bit or byte planes, each plane a zstandard frame.

Layout of a shard (all numbers little-endian)::

    "TPS1"                                             4 bytes
    planes of block 0, of block 1, ...                 zstandard frames, low plane first
    documents: keys (int64), has key (bytes), number of ids (int64)       one zstandard frame
    chunk index: per block place (u64), number of ids (u32), bytes of each plane (u32)    one zstandard frame
    footer: block size, planes a block, kind (0 bit, 1 byte), place and bytes of documents, place and bytes of the
    chunk index, number of documents, number of ids    9 x u64, then "TPS1"

Byte plane k holds the k-th byte of every id; bit plane k the k-th bit, eight ids a byte, first id in the highest bit.
The chunk index lets a reader decompress only the blocks that hold the ids it wants.

``write`` sorts by key: ranges of keys, and rows of equal keys by a hash of the text, so that no key has to fit into
one task. Every task writes one file under a name of its own and returns a row about it; the table of those rows, the
manifest, names the files that count, so a task that runs twice leaves an unused file and nothing else.

Defined results: NULL and empty texts have the end id alone. Keys are numbers, or text of numbers (other text is an error
in ANSI mode, else NULL). NULL keys come first. Repeated rows stay. An empty table gives an empty manifest and no files.
An id over 65,535 is an error unless ``width``, the bytes of an id, is 3 or 4. Other columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercraft.llm import _files
from tiercraft.llm._pieces import Memo, listed, spread
from tiercraft.llm._text import ragged, slices
from tiercraft.llm.rank_bpe import byte_characters
from tiercraft.llm._tasks import map_arrow
from tiercraft.session import shared_folder, stage

MAGIC = b"TPS1"
FOOTER = struct.Struct("<9Q4s")
BLOCK = 1 << 16
LEVEL = 1
SLICE_BYTES = 4 << 20
#: Pieces that a worker remembers, some 250 bytes each.
PIECES = 900_000
#: Pieces given to the library at once, and joined to one text.
BATCH, JOINED = 5000, 200


def to_planes(ids: np.ndarray, width: int, kind: str) -> list[bytes]:
    """The planes of one block of ids of ``width`` bytes, low plane first."""
    if kind == "byte":
        return [x.tobytes() for x in np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)[:width]]
    return [np.packbits((ids >> np.uint32(k)).astype(np.uint8) & 1).tobytes() for k in range(8 * width)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    ids = np.zeros(n, dtype=np.uint32)
    for k, plane in enumerate(planes):
        data = np.frombuffer(plane, dtype=np.uint8)
        part = data if kind == "byte" else np.unpackbits(data, count=n)
        ids |= part.astype(np.uint32) << np.uint32(8 * k if kind == "byte" else k)
    return ids


class ShardWriter:
    """Writes ids block by block; holds one block and the lengths of the documents."""

    def __init__(self, file, width: int = 2, kind: str = "byte", block: int = BLOCK):
        self.file, self.width, self.kind, self.block = file, width, kind, block
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.index: list[tuple[int, int, list[int]]] = []
        self.keys: list[np.ndarray] = []
        self.has: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.at = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.file.write(data)
        self.at += len(data)
        return len(data)

    def _block(self, ids: np.ndarray) -> None:
        place = self.at
        self.index.append((place, len(ids), [self._put(self.packer.compress(x)) for x in to_planes(ids, self.width, self.kind)]))

    def add(self, keys: np.ndarray, has: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Some documents: key, whether it has one, number of ids; and the ids of all of them."""
        if len(ids) and int(ids.max()) >> (8 * self.width):
            raise ValueError(f"id {ids.max()} needs more than {self.width} bytes")
        self.keys.append(keys), self.has.append(has), self.counts.append(counts)
        self.n_ids += len(ids)
        ids = np.concatenate([*self.held, ids])
        whole = len(ids) - len(ids) % self.block
        for at in range(0, whole, self.block):
            self._block(ids[at : at + self.block])
        self.held = [ids[whole:]]

    def close(self) -> tuple[int, int]:
        if len(self.held) and len(self.held[0]):
            self._block(self.held[0])
        join = lambda xs, kind: (np.concatenate(xs) if xs else np.empty(0)).astype(kind).tobytes()
        docs_at = self.at
        n_docs = sum(map(len, self.keys))
        docs = self._put(self.packer.compress(join(self.keys, "<i8") + join(self.has, "u1") + join(self.counts, "<i8")))
        index_at, planes = self.at, 8 * self.width if self.kind == "bit" else self.width
        index = self._put(self.packer.compress(b"".join(struct.pack(f"<QI{planes}I", a, n, *sizes) for a, n, sizes in self.index)))
        self._put(FOOTER.pack(self.block, planes, int(self.kind == "byte"), docs_at, docs, index_at, index, n_docs, self.n_ids, MAGIC))
        self.file.close()
        return n_docs, self.n_ids


class Footer(NamedTuple):
    block: int
    planes: int
    kind: int
    docs_at: int
    docs: int
    index_at: int
    index: int
    n_docs: int
    n_ids: int
    magic: bytes


class ShardReader:
    """Random access to a shard's ids through its chunk index."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        self.footer = Footer(*FOOTER.unpack(self._get(size - FOOTER.size, FOOTER.size)))
        if self.footer.magic != MAGIC:
            raise ValueError("not a shard, or cut short")
        one = struct.Struct(f"<QI{self.footer.planes}I")
        self.index = list(one.iter_unpack(zstandard.decompress(self._get(self.footer.index_at, self.footer.index))))

    def _get(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, n = zstandard.decompress(self._get(self.footer.docs_at, self.footer.docs)), self.footer.n_docs
        return np.frombuffer(data, "<i8", n), np.frombuffer(data, "u1", n, 8 * n), np.frombuffer(data, "<i8", n, 9 * n)

    def read_block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.index[k]
        data, planes = self._get(at, sum(sizes)), []
        for size in sizes:
            planes.append(zstandard.decompress(data[:size]))
            data = data[size:]
        return from_planes(planes, n, "byte" if self.footer.kind else "bit")

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` up to ``stop`` of the shard; only the blocks that hold them are read."""
        if stop <= start:
            return np.empty(0, dtype=np.uint32)
        first, last = start // self.footer.block, (stop - 1) // self.footer.block
        ids = np.concatenate([self.read_block(k) for k in range(first, last + 1)])
        return ids[start - first * self.footer.block : stop - first * self.footer.block]


class ByteTokenizer:
    """The tokenizers library on the pieces of a text, each different piece encoded once.

    The file's pattern never joins anything across the start of a run of white space, but for one space before a
    word. A text is therefore cut before and after a line feed and before a space, and what a piece encodes to does not
    depend on the others: new ones are given to the library as texts of many words, and their ids told apart again.
    Runs of white space need the pattern's own rule (all but the last character are one piece); texts with other than
    ASCII white space, or with a special token, go to the library whole.
    """

    MANY = r"[\t-\r ][\t-\r ]|\x00"
    ODD = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    RUNS = re.compile(r" ?[^\t-\r ]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]")

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.odd = "|".join([self.ODD, *map(re.escape, special)])
        self.memo = Memo(self.encode, most=PIECES)
        shown = byte_characters()
        vocabulary = self.library.get_vocab()
        # Only the first byte of what the pattern finds can be a space, so a token that begins with one begins a piece.
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(shown[32])]] = True
        self.feed = vocabulary.get(shown[10])
        self.joins = self.feed is not None and not any(x.isspace() for token in special for x in token)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end and their numbers. Pieces of one word are joined to texts, which the pattern cuts between them."""
        words: tuple[list[int], list[int]] = [], []
        rest = []
        for k, piece in enumerate(pieces):
            spaced = piece[:1] == " "
            (words[spaced] if self.joins and piece.split() == [piece[1:] if spaced else piece] else rest).append(k)
        groups = [self._joined(pieces, words[False], False), self._joined(pieces, words[True], True), self._alone(pieces, rest)]
        ids, counts = (np.concatenate(x) for x in zip(*groups, strict=True))
        starts, order = np.cumsum(counts) - counts, np.argsort(np.array([*words[False], *words[True], *rest], dtype=np.int64))
        return ids[ragged(starts[order], counts[order])], counts[order]

    def _joined(self, pieces: list[str], at: list[int], spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """Words with a space before each of them, or with none: these get a line feed, whose id is left out again."""
        mark, made = "" if spaced else "\n", []
        for i in range(0, len(at), BATCH):
            some = [mark + pieces[k] for k in at[i : i + BATCH]]
            texts = ["".join(some[j : j + JOINED]) for j in range(0, len(some), JOINED)]
            made += [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(made), dtype=np.uint32)
        first = self.spaced[ids] if spaced else ids == self.feed
        begins = np.flatnonzero(first)
        if len(begins) != len(at) or len(at) and begins[0]:
            return self._alone(pieces, at)
        counts = np.diff(begins, append=len(ids))
        return (ids, counts) if spaced else (ids[~first], counts - 1)

    def _alone(self, pieces: list[str], at: list[int]) -> tuple[np.ndarray, np.ndarray]:
        made = []
        for i in range(0, len(at), BATCH):
            made += [e.ids for e in self.library.encode_batch_fast([pieces[k] for k in at[i : i + BATCH]], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(made), dtype=np.uint32), np.fromiter(map(len, made), dtype=np.int64, count=len(made))

    def _spread(self, offsets: np.ndarray, codes: np.ndarray, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return spread(offsets, codes, self.memo.numbers(pieces), self.memo)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids begin (one more at the end)."""
        odd = pc.match_substring_regex(texts, self.odd)
        many = pc.and_not(pc.match_substring_regex(texts, self.MANY), odd)
        easy = pc.invert(pc.or_(odd, many))
        groups = [(easy, self._spread(*_cut(texts.filter(easy))))]
        if pc.any(many).as_py():
            runs = pa.array([self.RUNS.findall(t) for t in texts.filter(many).to_pylist()], type=pa.list_(pa.string()))
            groups.append((many, self._spread(*listed(runs))))
        if pc.any(odd).as_py():
            ids, counts = self.encode(texts.filter(odd).to_pylist())
            groups.append((odd, (ids, np.concatenate(([0], np.cumsum(counts))))))
        if len(groups) == 1:
            return groups[0][1]
        parts: list[np.ndarray] = [np.empty(0, dtype=np.uint32)] * len(texts)
        for where, (ids, ends) in groups:
            for k, row in enumerate(np.flatnonzero(where.to_numpy(zero_copy_only=False)).tolist()):
                parts[row] = ids[ends[k] : ends[k + 1]]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))


def _cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Texts cut before and after line feeds and before spaces, as :func:`listed` gives lists; nothing is copied."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(ends[-1])
    there = np.frombuffer(data, dtype=np.uint8, count=size) if size else np.empty(0, dtype=np.uint8)
    feeds = there == 10
    first = feeds | (there == 32)
    first[1:] |= feeds[:-1]
    first[ends[ends < size]] = True
    first[: ends[0]] = False
    starts = np.flatnonzero(first)
    pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, size)), data])
    pieces = pieces.dictionary_encode()
    return np.searchsorted(starts, ends), pieces.indices.to_numpy(), pieces.dictionary.to_pylist()


_open: dict[str, ByteTokenizer] = {}


def _tokenizer(path: str) -> ByteTokenizer:
    if path not in _open:
        _open.clear()
        _open[path] = ByteTokenizer(path)
    return _open[path]


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the end id after each text's ids."""
    return np.insert(ids, ends[1:], end_id).astype(np.uint32), ends + np.arange(len(ends))


MANIFEST = "path string, first_key long, first_tie long, n_docs long, n_ids long, n_bytes long"


def write(docs: DataFrame, path: str, end_id: int, folder: str | None = None, key: str = "doc_id", text: str = "text", width: int = 2, kind: str = "byte", block: int = BLOCK) -> DataFrame:
    """Encode every text, write shards in ascending order of the key, return their manifest (a stored table)."""
    folder = folder or f"{shared_folder(docs.sparkSession)}/shards/{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, writer, first, name, files = _tokenizer(path), None, None, f"{uuid.uuid4().hex}.tps", None
        for batch in batches:
            for part in slices(batch, "piece_text", SLICE_BYTES):
                if writer is None:
                    files, at = _files.opened(folder)
                    files.create_dir(at, recursive=True)
                    writer = ShardWriter(files.open_output_stream(f"{at}/{name}"), width, kind, block)
                    first = part.column("row_key")[0].as_py(), part.column("tie")[0].as_py()
                ids, ends = with_end(*tokenizer.texts(pc.fill_null(part.column("piece_text"), "")), end_id)
                keys = part.column("row_key")
                writer.add(pc.fill_null(keys, 0).to_numpy(), keys.is_valid().to_numpy(zero_copy_only=False), np.diff(ends), ids)
        if writer is not None:
            n_docs, n_ids = writer.close()
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "first_key": first[0], "first_tie": first[1], "n_docs": n_docs, "n_ids": n_ids, "n_bytes": writer.at}])

    taken = docs.select(F.col(key).cast("long").alias("row_key"), F.col(text).alias("piece_text"), F.xxhash64(text).alias("tie"))
    ordered = taken.repartitionByRange("row_key", "tie").sortWithinPartitions("row_key", "tie")
    return stage(ordered.transform(map_arrow, run, MANIFEST), "manifest")


def read(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every document from the shards: key, start (ids of all documents before it), n_tokens, ids_crc32."""
    # one row a shard, so the running total is over few rows
    before = Window.orderBy(F.asc_nulls_first("first_key"), "first_tie", "path").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, at = _files.opened(row["path"])
                with files.open_input_file(at) as file:
                    yield from _documents(ShardReader(file), row["before"])

    partitions = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = placed.repartition(partitions, "path").transform(map_arrow, run, "row_key long, start long, n_tokens long, ids_crc32 long")
    return read.withColumnRenamed("row_key", key)


def _documents(shard: ShardReader, before: int) -> Iterator[pa.RecordBatch]:
    keys, has, counts = shard.documents()
    ends = np.concatenate(([0], np.cumsum(counts)))
    checks = np.zeros(len(keys), dtype=np.int64)
    doc, check, at = 0, 0, 0
    for k in range(len(shard.index)):
        data = shard.read_block(k).astype("<u4")
        to = at + len(data)
        while doc < len(keys) and ends[doc] < to:
            a, b = max(ends[doc], at), min(ends[doc + 1], to)
            check = zlib.crc32(data[a - at : b - at].data, check)
            if ends[doc + 1] > to:
                break
            checks[doc], check, doc = check, 0, doc + 1
        at = to
    for i in range(0, len(keys), 10_000):
        cut = slice(i, i + 10_000)
        yield pa.RecordBatch.from_arrays([pa.array(keys[cut], mask=has[cut] == 0), pa.array(ends[:-1][cut] + before), pa.array(counts[cut]), pa.array(checks[cut])], ["row_key", "start", "n_tokens", "ids_crc32"])
