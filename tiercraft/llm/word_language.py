"""Language identification, words first: a known word is scored by its frequency in each language, an unknown one by
the longest character n-grams of it that are known.

Learning counts words, and n-grams of words between spaces, per language in Spark, over a sample of each language's
labelled rows: those with the smallest hashes of key and text, ``sample_rows`` at most, whatever the language's share of
the table and the size of the table. The sample does not depend on order. Of the counts the most frequent words and
n-grams of each language make the model: at most ``most_words + longest * most_grams`` rows a language, which is what
the driver holds and broadcasts; a word beyond them is unknown and goes to its n-grams, as the method has it. A frequency that is not known in a language costs ``penalty``. A text's cost in a language is the
mean over its words; the score is the share of the best language when costs are turned into probabilities.

Defined results: ``und`` and score 0 for NULL, empty texts and texts without a letter, and for all texts when nothing
could be learned. Equal costs go to the first language in alphabetical order. Repeated rows get the same answer each.
An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiercraft.llm._pieces import PieceRows, piece_numbers, sums
from tiercraft.llm._text import slices
from tiercraft.llm._tasks import map_arrow
from tiercraft.operators.attach import attach, settled
from tiercraft.session import stage

SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Settings:
    #: Labelled rows of one language that are learned from.
    sample_rows: int = 2_000
    most_words: int = 30_000
    most_grams: int = 5_000
    longest: int = 5
    penalty: float = 7.0
    sharpness: float = 10.0


@dataclass
class Model:
    """Costs per language (-log10 of the relative frequency) of words and of n-grams of each length."""

    languages: list[str]
    words: dict[str, np.ndarray] = field(default_factory=dict)
    grams: list[dict[str, np.ndarray]] = field(default_factory=list)


def letters(piece: str) -> str:
    """The letters of a piece, in lower case."""
    if piece.isalpha():
        return piece.lower()
    return "".join([c for c in piece if c.isalpha()]).lower()


def word_cost(word: str, model: Model) -> np.ndarray | None:
    """Cost of a word in every language: its own, or the mean of its longest known n-grams; None where none is known."""
    own = model.words.get(word)
    if own is not None:
        return own
    padded = f" {word} "
    for table, n in zip(reversed(model.grams), range(len(model.grams), 0, -1), strict=True):
        found = [c for i in range(len(padded) - n + 1) if (c := table.get(padded[i : i + n])) is not None]
        if found:
            return np.sum(found, axis=0) / len(found)
    return None


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "body", SLICE_BYTES):
            for lang in pc.unique(part.column("lang")):
                texts = part.column("body").filter(pc.equal(part.column("lang"), lang))
                counted = pc.value_counts(pc.ascii_split_whitespace(texts).flatten())
                words: dict[str, int] = {}
                for piece, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist(), strict=True):
                    if word := letters(piece):
                        words[word] = words.get(word, 0) + n
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(words)), pa.array([*words], pa.string()), pa.array([*words.values()], pa.int64())], ["lang", "word", "n"])


def _frequent(counts: DataFrame, kind: str, most: int) -> DataFrame:
    """The most frequent of each kind and language, with their cost; (lang, kind, item, cost)."""
    total = counts.groupBy("lang", *([kind] if kind else [])).agg(F.sum("n").alias("total"))
    on = ["lang", *([kind] if kind else [])]
    best = Window.partitionBy(*on).orderBy(F.desc("n"), "item")
    top = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most).drop("rank")
    return top.join(total, on).withColumn("cost", -F.log10(F.col("n") / F.col("total")))


def below(hashed: Column, share: Column) -> Column:
    """Whether a 64-bit hash is in the lowest ``share`` of its whole range, however small that is."""
    return hashed.cast("double") / 2.0**64 + 0.5 < share


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """Of each language the ``most`` rows with the smallest hashes of ``k`` and ``body``; (k, lang, body).

    A share that is expected to hold twice as many is taken first, so that few rows are ranked.
    """
    sizes = settled(rows.groupBy("lang").agg(F.count("*").alias("rows")))
    hashed = attach(rows, sizes, ["lang"], "inner").withColumn("hashed", F.xxhash64("k", "body", F.lit("sample")))
    some = hashed.where(below(F.col("hashed"), (F.lit(2.0 * most) + 100) / F.col("rows")))
    least = Window.partitionBy("lang").orderBy("hashed", "k")
    return some.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= most).select("k", "lang", "body")


def _cuts(padded: Column, size: int) -> Column:
    """All n-grams of one size."""
    return F.transform(F.sequence(F.lit(1), F.length(padded) - size + 1), lambda i: F.substring(padded, i, F.lit(size)))


def learn(labelled: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """The model of (key, text, lang) rows; rows without a language or text are left out."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("string").alias("k"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("body"))
    sample = sampled(rows, settings.sample_rows).select("lang", "body")
    words = stage(sample.transform(map_arrow, _word_counts, "lang string, word string, n long").groupBy("lang", F.col("word").alias("item")).agg(F.sum("n").alias("n")), "words")
    padded = F.concat(F.lit(" "), F.col("item"), F.lit(" "))
    grams = None
    for size in range(1, settings.longest + 1):
        cut = _cuts(padded, size)
        part = words.where(F.length(padded) >= size).select("lang", F.lit(size).alias("size"), "n", F.explode(cut).alias("item"))
        grams = part if grams is None else grams.unionByName(part)
    counted = grams.groupBy("lang", "size", "item").agg(F.sum("n").alias("n"))
    known = _frequent(counted, "size", settings.most_grams).select("lang", "size", "item", "cost")
    known = known.unionByName(_frequent(words, "", settings.most_words).select("lang", F.lit(0).alias("size"), "item", "cost"))
    # at most most_words + longest * most_grams rows a language
    found = known.collect()
    model = Model(sorted({r["lang"] for r in found}), {}, [{} for _ in range(settings.longest)])
    number = {x: i for i, x in enumerate(model.languages)}
    for r in found:
        table = model.grams[r["size"] - 1] if r["size"] else model.words
        table.setdefault(r["item"], np.full(len(number), settings.penalty, dtype=np.float32))[number[r["lang"]]] = r["cost"]
    return model


def _predict(shared: Broadcast, settings: Settings):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        n = len(model.languages)

        def make(pieces: list[str]) -> np.ndarray:
            """Costs, 1 for a word with a cost, 1 for a piece with a letter."""
            out = np.zeros((len(pieces), n + 2), dtype=np.float32)
            for i, piece in enumerate(pieces):
                if word := letters(piece):
                    out[i, n + 1] = 1
                    cost = word_cost(word, model)
                    if cost is not None:
                        out[i, :n], out[i, n] = cost, 1
            return out

        table = PieceRows(make, 300_000)
        for batch in batches:
            for part in slices(batch, "body", SLICE_BYTES):
                offsets, place = piece_numbers(part.column("body"), table)
                total = sums(table.rows[place], offsets) if len(place) else np.zeros((part.num_rows, n + 2))
                langs, scores = ["und"] * part.num_rows, np.zeros(part.num_rows)
                if n:
                    cost = total[:, :n] / np.maximum(total[:, n : n + 1], 1)
                    chance = np.exp(-settings.sharpness * (cost - cost.min(axis=1, keepdims=True)))
                    best = cost.argmin(axis=1)
                    seen = total[:, n + 1] > 0
                    langs = [model.languages[k] if s else "und" for k, s in zip(best, seen, strict=True)]
                    scores = np.where(seen, 1 / chance.sum(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays([part.column("row_key"), pa.array(langs, pa.string()), pa.array(scores)], ["row_key", "lang_pred", "score"])

    return rows


def predict(docs: DataFrame, model: Model, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.select(F.col(key).alias("row_key"), F.col(text).alias("body"))
    kind = plain.schema["row_key"].dataType.simpleString()
    return plain.transform(map_arrow, _predict(shared, settings), f"row_key {kind}, lang_pred string, score double").withColumnRenamed("row_key", key)


def remainder(key: str, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``; rows are held out by it."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(of))
