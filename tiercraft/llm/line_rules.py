"""Quality rules from a document's own text and from lines that many documents of a host share. DataFrame code only.

Own rules: too few words, or too many words inside 3-word windows that occur again. Cross-document rule: lines are
normalised (lower case, white space runs to one space, digits to 0) and hashed; the documents of a host that hold a
line are counted. Two limits make a line frequent in a host: more than ``least`` documents that are more than ``share``
of the host's, or, for lines of ``long_words`` words or more, more than ``many`` documents however large the host is.
Frequent lines are removed, and a document left with too few words, or too small a part of its words, is depleted and
rejected.

Defined results: NULL text is an empty text and fails for want of words; a NULL host is a host of its own; NULL keys
are kept. A document is a key with its text: repeated rows count once and get the same answer each, copies under other
keys count each. An empty table gives an empty table. Other columns stay out of the
work; names that clash with columns made here do no harm, as the inputs are renamed first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.llm._carry import quoted, row_struct, unpacked
from tiercraft.session import stage

SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class LineRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    least: int = 20
    share: float = 0.1
    many: int = 1000
    long_words: int = 8
    min_left: int = 50
    min_left_percent: int = 30


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def normal_line(line: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), SPACES, " ")), "[0-9]", "0")


def repeated_words(words: str) -> tuple[list[tuple[str, Column]], Column]:
    """Words inside 3-word windows that occur again, as named steps and a result; ``words`` is an array column.

    A window is a number: its hash above, its place below. In sorted order equal windows are neighbours; the words
    themselves are then compared. Everything is a sort of numbers, so a long text costs n log n.
    """
    w, bits = F.col(words), F.col("_bits")
    n = F.size(w)
    window = F.transform(
        F.slice(w, 1, F.greatest(n - 2, F.lit(0))),
        lambda x, i: F.call_function("shiftleft", F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), bits).bitwiseOR(i.cast("long")),
    )
    s = F.col("_sorted")
    place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")
    head = lambda x: F.call_function("shiftright", x, bits)

    def same(a: Column, b: Column) -> Column:
        p, q = place(a), place(b)
        equal = F.lit(True)
        for k in range(3):
            equal = equal & (F.get(w, p + k) == F.get(w, q + k))
        return (head(a) == head(b)) & equal

    again = F.filter(s, lambda x, i: F.coalesce(same(x, F.get(s, i + 1)), F.lit(False)) | F.coalesce((i > 0) & same(F.get(s, i - 1), x), F.lit(False)))
    p = F.col("_places")
    steps = [
        ("_bits", F.length(F.bin(F.greatest(n, F.lit(1))))),
        ("_sorted", F.sort_array(window)),
        ("_places", F.sort_array(F.transform(again, place))),
    ]
    covered = F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return steps, covered


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row a document: key, host, text_hash, the own figures, and its lines as hashes with their words."""
    taken = docs.select(F.col(key).alias("row_key"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.coalesce(text, F.lit("")).alias("body"))
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = taken.select("row_key", "host", "body", F.xxhash64("body").alias("text_hash"), words_of(F.col("body")).alias("words"), lines.alias("lines"))
    steps, covered = repeated_words("words")
    for name, column in steps:
        out = out.withColumn(name, column)
    line = F.transform("lines", lambda x: F.struct(F.xxhash64(normal_line(x)).alias("line"), F.size(words_of(x)).alias("n")))
    return out.select(
        "row_key",
        "host",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.octet_length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        line.alias("line_hashes"),
    )


def frequent_lines(rows: DataFrame, rules: LineRules) -> DataFrame:
    """(host, line) above the limits; ``rows`` from ``measured``. Distinct documents are counted after partial aggregation."""
    document = F.struct("row_key", "text_hash")
    hosts = rows.groupBy("host").agg(F.count_distinct(document).alias("host_documents"))
    held = rows.select("host", document.alias("document"), F.explode(F.array_distinct("line_hashes")).alias("held"))
    counts = held.groupBy("host", "held.line").agg(F.count_distinct("document").alias("documents"), F.max("held.n").alias("n")).where(F.col("documents") > min(rules.least, rules.many))
    share = (F.col("documents") > rules.least) & (F.col("documents") > rules.share * F.col("host_documents"))
    many = (F.col("documents") > rules.many) & (F.col("n") >= rules.long_words)
    return counts.join(hosts, "host").where(share | many).select("host", "line")


def judge(docs: DataFrame, rules: LineRules = LineRules(), key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Key, text_hash, the figures, base_failed, n_removed_words, frequent (hashes of removed lines) and kept."""
    rows = stage(measured(docs, key, text, host), "lines")
    found = rows.select("row_key", "text_hash", "host", F.explode(F.array_distinct(F.col("line_hashes.line"))).alias("line")).join(frequent_lines(rows, rules), ["host", "line"])
    found = found.groupBy(F.col("row_key").alias("found_key"), F.col("text_hash").alias("found_hash"), F.col("host").alias("found_host")).agg(F.collect_set("line").alias("frequent"))
    same = F.col("row_key").eqNullSafe(F.col("found_key")) & (F.col("text_hash") == F.col("found_hash")) & (F.col("host") == F.col("found_host"))
    joined = rows.join(found, same, "left")
    removed = F.aggregate(F.filter("line_hashes", lambda x: F.array_contains("frequent", x["line"])), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = joined.select("row_key", "text_hash", *figures, failed.alias("base_failed"), F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed_words"), F.coalesce("frequent", F.array().cast("array<bigint>")).alias("frequent"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < rules.min_left) | (100 * left < rules.min_left_percent * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted).withColumnRenamed("row_key", key)


def clean(docs: DataFrame, rules: LineRules = LineRules(), key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The kept documents, all columns, without their frequent lines; lines that stay are unchanged."""
    verdict = judge(docs, rules, key, text, host).where("kept").select(F.col(key).alias("kept_key"), F.col("text_hash").alias("kept_hash"), "frequent").dropDuplicates(["kept_key", "kept_hash"])
    body = quoted(text)
    whole = docs.select(row_struct(docs).alias("row"), quoted(key).alias("row_key"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("text_hash"), body.alias("body"))
    joined = whole.join(verdict, F.col("row_key").eqNullSafe(F.col("kept_key")) & (F.col("text_hash") == F.col("kept_hash")))
    lines = F.filter(F.split("body", "\n"), lambda x: ~F.array_contains("frequent", F.xxhash64(normal_line(x))))
    cleaned = F.when(F.size("frequent") == 0, F.col("body")).otherwise(F.array_join(lines, "\n"))
    return joined.select(*unpacked(docs, **{text: cleaned}))


CHECK = r"""
WITH doc AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS body FROM documents),
worded AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM doc),
windows AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
line AS (
  SELECT doc_id, host, body, l, regexp_replace(trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]', '0', 'g') AS norm,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, host, body, unnest(string_split(body, chr(10))) AS l FROM doc)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM line GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT doc_id) AS documents FROM doc GROUP BY host),
frequent AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT doc_id) AS held, max(n) AS words FROM line GROUP BY host, norm) JOIN hosts USING (host)
  WHERE held > {least} AND held > {share} * documents OR held > {many} AND words >= {long_words}),
removed AS (SELECT doc_id, sum(n) AS n FROM line JOIN frequent USING (host, norm) GROUP BY doc_id),
figures AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
  FROM worded LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)),
failed AS (SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {max_repeat_percent} * n_words AS base_failed FROM figures)
SELECT *, NOT base_failed AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < {min_left}
       OR 100 * (n_words - n_removed_words) < {min_left_percent} * n_words)) AS kept
FROM failed
"""


def check_sql(rules: LineRules = LineRules()) -> str:
    text = CHECK
    for name, value in vars(rules).items():
        text = text.replace("{" + name + "}", str(value))
    return text
