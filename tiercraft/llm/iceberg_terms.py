"""Source divergence audit: which sources of a language use its terms differently, and which terms set a source apart.

The terms that count are those in enough documents of their language. They are found by iceberg prefix refinement: level
by level the byte prefixes of terms grow (4, 8, 16, ... bytes), the distinct documents with a term of that prefix are
counted, and prefixes under the limit go, with every term below them. Terms that end at a level are counted as they
are, so what is kept is exact. The rare long tail of terms meets a shuffle as a few short prefixes, never whole.

Prefixes that stay are passed on as a set of bits by hash (at most 2**30 of them, whatever the input): a clash lets a
term through to the next level's exact count, and loses none. After a level only documents with longer terms go on, with
these terms alone. Occurrences are counted for kept terms in one more pass and joined with them.

Counts and sums are 64-bit or decimal integers. A pair of sources needs the differences over all kept terms: tasks hold
blocks of terms for tiles of 256 by 256 sources, and terms that neither source has are added as one product.

Defined results: NULL text, language and source are empty text. Rows are documents, repeated or not; keys and extra
columns are not read. A language without kept terms has pairs of value 0 and no terms. The result has a row for every
ordered pair of sources in a language. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiercraft.llm._carry import quoted
from tiercraft.llm._tasks import map_arrow
from tiercraft.llm._text import LOWER, U64, Words, byte_hashes, bytes_of, mix, ragged, slices
from tiercraft.operators.attach import attach, settled
from tiercraft.session import stage

#: Bytes between terms: ASCII that is no letter.
BETWEEN = np.array([b < 0x80 and not chr(b).isalpha() for b in range(256)])
MAX_LOG_BITS = 30
PIECE_BITS = 1 << 15
#: Bytes of text worked on at once, terms of a block, and shares of the terms of a tile.
SLICE, BLOCK, SHARES = 4_000_000, 512, 64
#: Rows of sums that a task holds before it sends them.
HELD = 1_500_000


@dataclass(frozen=True)
class Settings:
    documents: int = 30
    #: Bytes of the shortest prefix; each level doubles it.
    prefix: int = 4
    scale: int = 1_000_000_000
    smoothing: int = 5
    top: int = 50
    #: Sources along a side of a tile.
    tile: int = 256


class Terms:
    """The terms of a slice: exact dictionary codes of their first bytes, with the row of each."""

    def __init__(self, batch: pa.RecordBatch, longest: int | None = None, over: int = 0):
        data, rows = bytes_of(batch.column("text"))
        data = LOWER[data]
        words = Words(data, rows, BETWEEN)
        row = np.repeat(np.arange(batch.num_rows), np.diff(words.first))
        size = words.end - words.start
        start, end = words.start, words.end
        if over:
            start, end, row, size = (x[size > over] for x in (start, end, row, size))
        cut = size if longest is None else np.minimum(size, longest)
        self.row, self.open = row, size > cut
        offsets = np.concatenate(([0], np.cumsum(cut)))
        values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(offsets), pa.py_buffer(data[ragged(start, cut)])])
        coded = values.dictionary_encode()
        self.code, self.dictionary = coded.indices.to_numpy().astype(np.int64), coded.dictionary

    def hashes(self, langs: pa.Array, longest: int | None = None) -> np.ndarray:
        """Of language and key, or the key's first bytes, for every term."""
        own, lang = hashes_of(self.dictionary, longest), hashes_of(langs)
        return combined(lang[self.row], own[self.code])


def hashes_of(texts: pa.Array, longest: int | None = None) -> np.ndarray:
    data, at = bytes_of(texts)
    return byte_hashes(data, at[:-1], at[1:] if longest is None else np.minimum(at[1:], at[:-1] + longest))


def combined(lang: np.ndarray, key: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(key ^ (lang * U64(0x9E3779B97F4A7C15)))


def codes_of(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def distinct(numbers: np.ndarray) -> np.ndarray:
    """The different numbers in order; a sort, which is several times faster than hashing them."""
    if not len(numbers):
        return numbers
    numbers = np.sort(numbers)
    return numbers[np.concatenate(([True], numbers[1:] != numbers[:-1]))]


def added_up(parts: Iterator[pa.RecordBatch], number: str) -> Iterator[pa.RecordBatch]:
    """The sums of ``number`` over equal rows of several slices, at most HELD rows at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for part in parts:
        held.append(part)
        rows += part.num_rows
        if rows < HELD:
            continue
        summed = _summed(held, number)
        rows = summed.num_rows
        held = summed.to_batches()
        if rows > HELD // 2:
            yield from held
            held, rows = [], 0
    if held:
        yield from _summed(held, number).to_batches()


def _summed(held: list[pa.RecordBatch], number: str) -> pa.Table:
    table = pa.Table.from_batches(held)
    return table.group_by([c for c in table.column_names if c != number], use_threads=False).aggregate([(number, "sum")]).rename_columns({f"{number}_sum": number}).select(table.column_names)


def documents_of(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    named = {"text": text, "lang": lang, "source": source}
    return docs.select(*[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(name) for name, c in named.items()])


def prefix_counts(rows: DataFrame, longest: int, over: int) -> DataFrame:
    """(lang, key, open, docs): documents with a term of this prefix, or, not ``open``, with just this term."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                terms = Terms(batch, longest, over)
                langs, names = codes_of(batch.column("lang"))
                keys = 2 * max(1, len(terms.dictionary))
                key = 2 * terms.code + terms.open
                once = distinct(terms.row * keys + key)
                found, docs = np.unique(langs[once // keys] * keys + once % keys, return_counts=True)
                key = found % keys
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(found // keys)), terms.dictionary.take(pa.array(key // 2)).cast(pa.binary()), pa.array(key % 2 == 1), pa.array(docs)],
                    ["lang", "key", "open", "docs"],
                )

    found = map_arrow(rows.select("lang", "text"), lambda batches: added_up(task(batches), "docs"), "lang string, key binary, open boolean, docs long")
    # Tasks have added up already: dealt out first, the sums are not made a second time before the shuffle.
    return found.repartition("lang", "key", "open").groupBy("lang", "key", "open").agg(F.sum("docs").alias("docs"))


class Bits:
    """Whether (lang, key) may be in a set; never wrong about one that is."""

    def __init__(self, log_size: int, pieces: list[tuple[int, bytes]]):
        self.log_size = log_size
        self.bits = np.zeros(1 << (log_size - 3), dtype=np.uint8)
        for piece, bits in pieces:
            self.bits[piece * (PIECE_BITS // 8) : (piece + 1) * (PIECE_BITS // 8)] = np.frombuffer(bits, dtype=np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> U64(64 - self.log_size)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bits_of(keys: DataFrame, count: int) -> Broadcast:
    """The broadcast set of (lang, key); 16 bits a key, between 2**20 and 2**30 in all."""
    log_size = min(MAX_LOG_BITS, max(20, (16 * count).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = combined(hashes_of(batch.column("lang")), hashes_of(batch.column("key"))) >> U64(64 - log_size)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], ["at"])

    at = map_arrow(keys.select("lang", "key"), places, "at long")
    pieces = at.groupBy(F.shiftright("at", 15).alias("piece")).agg(F.bitmap_construct_agg(F.col("at") % PIECE_BITS).alias("bits"))
    return keys.sparkSession.sparkContext.broadcast(Bits(log_size, [(r["piece"], bytes(r["bits"])) for r in pieces.toLocalIterator()]))


def longer_terms(rows: DataFrame, longest: int, over: int, stays: Broadcast) -> DataFrame:
    """(lang, text): of every document the different terms over ``longest`` bytes whose prefix stays; none, no row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                terms = Terms(batch, None, over)
                size = max(1, len(terms.dictionary))
                left = (np.diff(bytes_of(terms.dictionary)[1]) > longest)[terms.code] & stays.value.has(terms.hashes(batch.column("lang"), longest))
                once = distinct(terms.row[left] * size + terms.code[left])
                row = once // size
                data, at = bytes_of(terms.dictionary)
                start, length = at[:-1][once % size], np.diff(at)[once % size]
                # Each term with the byte behind it, which becomes a space.
                spread = ragged(start, length + 1)
                ends = np.cumsum(length + 1)
                text = data[np.minimum(spread, max(0, len(data) - 1))] if len(spread) else np.empty(0, dtype=np.uint8)
                text[ends - 1] = 0x20
                rows_with, first = np.unique(row, return_index=True)
                offsets = np.concatenate((np.concatenate(([0], ends))[first], ends[-1:])) if len(ends) else np.zeros(1, dtype=np.int64)
                texts = pa.LargeStringArray.from_buffers(len(rows_with), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text))
                yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(rows_with)), texts.cast(pa.string())], ["lang", "text"])

    return map_arrow(rows.select("lang", "text"), task, "lang string, text string")


def kept_terms(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, key, docs) of all terms in enough documents of their language; ``rows`` has text and lang."""
    longest, over, complete = settings.prefix, 0, []
    while True:
        counts = stage(prefix_counts(rows, longest, over).where(F.col("docs") >= settings.documents), "term-prefixes")
        complete.append(counts.where(~F.col("open")).select("lang", "key", "docs"))
        still_open = counts.where("open")
        n = still_open.count()
        if not n:
            break
        rows = stage(longer_terms(rows, longest, over, bits_of(still_open, n)), "longer-terms")
        longest, over = 2 * longest, longest
    every = complete[0]
    for more in complete[1:]:
        every = every.unionByName(more)
    return every


def occurrences(rows: DataFrame, kept: DataFrame, n: int) -> DataFrame:
    """(lang, source, key, n) of the kept terms, where they occur."""
    may_be = bits_of(kept, n)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                terms = Terms(batch)
                left = may_be.value.has(terms.hashes(batch.column("lang")))
                (langs, lang_names), (sources, source_names) = codes_of(batch.column("lang")), codes_of(batch.column("source"))
                size = max(1, len(terms.dictionary))
                group = (langs * len(source_names) + sources)[terms.row[left]]
                found, times = np.unique(group * size + terms.code[left], return_counts=True)
                group = found // size
                yield pa.RecordBatch.from_arrays(
                    [
                        lang_names.take(pa.array(group // max(1, len(source_names)))),
                        source_names.take(pa.array(group % max(1, len(source_names)))),
                        terms.dictionary.take(pa.array(found % size)).cast(pa.binary()),
                        pa.array(times),
                    ],
                    ["lang", "source", "key", "n"],
                )

    found = map_arrow(rows.select("lang", "source", "text"), lambda batches: added_up(task(batches), "n"), "lang string, source string, key binary, n long")
    counted = found.repartition("lang", "source", "key").groupBy("lang", "source", "key").agg(F.sum("n").alias("n"))
    return attach(counted, settled(kept.select("lang", "key")), ["lang", "key"], "left_semi")


def share(n: Column, total: Column, terms: Column, settings: Settings) -> Column:
    """1 + floor(scale * (n + smoothing) / (total + smoothing * terms)), exactly; NULL without terms."""
    above = F.lit(settings.scale).cast("decimal(10,0)") * (n + settings.smoothing).cast("decimal(20,0)")
    below = (total + settings.smoothing * terms).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", above, below))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", settings: Settings = Settings()) -> DataFrame:
    """lang, source, part, item, value, rank."""
    rows = documents_of(docs, text, lang, source)
    kept = kept_terms(rows, settings)
    sizes = stage(kept.groupBy("lang").agg(F.count("*").alias("terms")), "term-languages")
    n = sizes.agg(F.sum("terms")).first()[0] or 0
    counts = stage(occurrences(rows, kept, n), "term-counts")
    groups = _groups(rows, counts, sizes, settings)
    terms = _terms(counts, groups, settings)
    return _pairs(terms, groups, settings).unionByName(_top_terms(terms, groups, settings))


def _groups(rows: DataFrame, counts: DataFrame, sizes: DataFrame, settings: Settings) -> DataFrame:
    """A row for every (lang, source) that occurs: its number in the language, totals, and the share of a term it lacks."""
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = rows.select("lang", "source").distinct().join(total, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "terms"])
    of_lang = Window.partitionBy("lang")
    numbered = every.select(
        "lang", "source", "total", "terms", F.sum("total").over(of_lang).alias("lang_total"), (F.row_number().over(of_lang.orderBy("source")) - 1).alias("number"), F.count("*").over(of_lang).alias("sources")
    )
    none = F.coalesce(share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"), settings), F.lit(0))
    return stage(numbered.withColumn("none", none), "term-groups")


def _terms(counts: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """A row for every kept term: its share in the language, and its shares in the sources that have it."""
    joined = attach(counts, settled(groups), ["lang", "source"], "inner")
    own = share(F.col("n"), F.col("total"), F.col("terms"), settings)
    entry = F.struct("number", own.alias("p"))
    by_term = joined.groupBy("lang", "key").agg(F.sum("n").alias("n"), F.collect_list(entry).alias("entries"), *[F.max(c).alias(c) for c in ("lang_total", "terms", "sources")])
    whole = share(F.col("n"), F.col("lang_total"), F.col("terms"), settings)
    return stage(by_term.select("lang", "key", "sources", whole.alias("q"), "entries"), "term-shares")


def _top_terms(terms: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    above = terms.select("lang", "key", "q", F.explode("entries").alias("e")).where("e.p > q")
    ranked = above.select("lang", F.col("e.number").alias("number"), F.col("key").cast("string").alias("item"), (F.col("e.p") - F.col("q")).alias("value"))
    first = Window.partitionBy("lang", "number").orderBy(F.col("value").desc(), "item")
    top = ranked.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= settings.top)
    return top.join(groups.select("lang", "number", "source"), ["lang", "number"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(terms: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """Every ordered pair of sources of a language, by the sum of their differences over all kept terms."""
    a = groups.select("lang", "source", "number", "none", "terms")
    b = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("other"), F.col("none").alias("other_none"))
    pairs = a.join(b, "lang").where("number != other")
    pairs = pairs.withColumns({"low": F.least("number", "other"), "high": F.greatest("number", "other")})
    found = pairs.join(_differences(terms, groups, settings.tile), ["lang", "low", "high"], "left")
    value = F.col("terms") * F.abs(F.col("none") - F.col("other_none")) + F.coalesce("more", F.lit(0))
    order = Window.partitionBy("lang", "number").orderBy(F.col("value").desc(), "item")
    valued = found.select("lang", "number", "source", "item", value.alias("value"))
    return valued.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _differences(terms: DataFrame, groups: DataFrame, side: int) -> DataFrame:
    """(lang, low, high, more): over terms, by how much two sources differ more than they do by a term both lack."""
    block = lambda e: F.floor(e / side).cast("int")
    last = (F.ceil(F.col("sources") / side) - 1).cast("int")
    present = F.array_distinct(F.transform("entries", lambda e: block(e["number"])))
    tiles = F.array_distinct(F.flatten(F.transform(present, lambda i: F.transform(F.sequence(F.lit(0), last), lambda j: F.struct(F.least(i, j).alias("i"), F.greatest(i, j).alias("j"))))))
    inside = F.filter("entries", lambda e: block(e["number"]).isin(F.col("tile.i"), F.col("tile.j")))
    dealt = F.pmod(F.xxhash64("key"), F.lit(SHARES)).cast("int").alias("share")
    rows = terms.select("lang", "key", "entries", F.explode(tiles).alias("tile")).select("lang", "tile.i", "tile.j", dealt, F.lit(1).alias("kind"), inside.alias("entries"))
    sides = groups.groupBy("lang", block(F.col("number")).alias("block")).agg(F.collect_list(F.struct("number", F.col("none").alias("p"))).alias("entries"))
    left, right = sides.select("lang", F.col("block").alias("i"), F.col("entries").alias("a")), sides.select("lang", F.col("block").alias("j"), F.col("entries").alias("b"))
    both = F.when(F.col("i") == F.col("j"), F.col("a")).otherwise(F.concat("a", "b"))
    heads = left.join(right, "lang").where("i <= j").select("lang", "i", "j", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"), F.lit(0).alias("kind"), both.alias("entries"))
    dealt_rows = rows.unionByName(heads).select("lang", "i", "j", "share", "kind", F.col("entries.number").alias("numbers"), F.col("entries.p").alias("shares"))
    ordered = dealt_rows.repartition("lang", "i", "j", "share").sortWithinPartitions("lang", "i", "j", "share", "kind")
    return map_arrow(ordered, lambda batches: _tile_sums(batches, side), "lang string, low int, high int, more long").groupBy("lang", "low", "high").agg(F.sum("more").alias("more"))


def _tile_sums(batches: Iterator[pa.RecordBatch], side: int) -> Iterator[pa.RecordBatch]:
    """Sums of one tile after the other; a tile's first row has all its sources with the share of a term they lack."""
    tile, numbers, none, total, dense, filled = None, None, None, None, None, 0

    def added() -> None:
        nonlocal filled
        rows = dense[:filled]
        for k in range(len(numbers)):
            total[k, k + 1 :] += np.abs(rows[:, k + 1 :] - rows[:, k, None]).sum(axis=0) - filled * np.abs(none[k + 1 :] - none[k])
        dense[:filled] = none
        filled = 0

    def done() -> Iterator[pa.RecordBatch]:
        if tile is None:
            return
        if filled:
            added()
        low, high = np.triu_indices(len(numbers), 1)
        wanted = (numbers[low] // side == tile[1]) & (numbers[high] // side == tile[2]) & (total[low, high] != 0)
        low, high = low[wanted], high[wanted]
        yield pa.RecordBatch.from_arrays(
            [pa.array([tile[0]] * len(low), pa.string()), pa.array(numbers[low], pa.int32()), pa.array(numbers[high], pa.int32()), pa.array(total[low, high])], ["lang", "low", "high", "more"]
        )

    for batch in batches:
        names = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "i", "j", "share")), strict=True))
        kinds = batch.column("kind").to_pylist()
        at = batch.column("numbers").offsets.to_numpy()
        own = batch.column("numbers").values.to_numpy().astype(np.int64)
        shares = batch.column("shares").values.to_numpy()
        for r, name in enumerate(names):
            entries = own[at[r] : at[r + 1]], shares[at[r] : at[r + 1]]
            if kinds[r] == 0:
                yield from done()
                order = np.argsort(entries[0])
                tile, numbers, none = name, entries[0][order], entries[1][order]
                total, dense, filled = np.zeros((len(numbers), len(numbers)), dtype=np.int64), np.tile(none, (BLOCK, 1)), 0
                continue
            dense[filled, np.searchsorted(numbers, entries[0])] = entries[1]
            filled += 1
            if filled == BLOCK:
                added()
    yield from done()


#: The query in SQL: every term of every document counted whole, every pair over all kept terms.
CHECK = r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
kept AS MATERIALIZED (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 30),
counts AS MATERIALIZED (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total, coalesce(any_value(s.v), 0)::HUGEINT AS v
  FROM (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents) g
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source LEFT JOIN sizes s ON s.lang = g.lang GROUP BY g.lang, g.source),
langs AS (SELECT lang, sum(total)::HUGEINT AS total FROM groups GROUP BY lang),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
lang_shares AS (
  SELECT lang, term, 1 + (1000000000 * (sum(s.n) + 5)::HUGEINT) // (any_value(l.total) + 5 * any_value(z.v)) AS q
  FROM shares s JOIN langs l USING (lang) JOIN sizes z USING (lang) GROUP BY lang, term),
differences AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN differences d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
tops AS (
  SELECT s.lang, s.source, s.term AS item, (p - q)::BIGINT AS value, row_number() OVER (PARTITION BY s.lang, s.source ORDER BY p - q DESC, s.term) AS rank
  FROM shares s JOIN lang_shares l ON l.lang = s.lang AND l.term = s.term WHERE s.n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, value, rank::INTEGER AS rank FROM tops WHERE rank <= 50
"""
