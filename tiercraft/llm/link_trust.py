"""URL verdicts from rules, and for hosts without a rule from trust that flows along links. DataFrame code only.

Rules name a host and a path, such as ``example.com/en/``; a rule fits its host and all subdomains where the url's
path starts with the rule's, and the longest rule wins. A host is a trusted seed when more than half of its pages
fall under allow rules, a blocked seed when more than half fall under block rules. Trust is personalised PageRank
from the trusted seeds along host links; distrust is the same from the blocked seeds along reversed links (who links
to a bad host is worse for it). A host's pages without a rule are blocked when distrust is at least ``threshold`` of
trust and distrust together, and allowed otherwise, also where neither reached the host.

Links are counted per pair of hosts before anything is joined, so the work of a step grows with pairs of hosts and
not with pages; each step is one join and one sum, combined before the shuffle. Scores are written to the shared
folder every few steps. With a ``tolerance`` they are compared with those written before: steps go on until the absolute
changes of all hosts add up to that share of all scores at most and no further host was reached. So a host counts however
many links it is away from a seed; only verdicts of hosts within the tolerance of the threshold may be either. Scores that
do not stand after ``most_steps`` are an error. Without a tolerance ``steps`` are taken, and hosts further away are not
reached.

Defined results: a NULL url, or one without ``://``, has an empty host and path, no rule, and is allowed. NULL pages
have no links. Links to the own host are left out. Repeated rows get the same answer each and add to the weight of
their links. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*([^"'\s>]+)"""


@dataclass(frozen=True)
class TrustFlow:
    damping: float = 0.85
    steps: int = 8
    threshold: float = 0.5
    steps_between_writes: int = 4
    #: None: exactly ``steps``, as ``check_sql`` writes them out. A number: until the scores stand, after ``steps`` at least.
    tolerance: float | None = None
    most_steps: int = 2000


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits; ``rules`` has the verdict (allow or block) of each rule."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules.items():
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, links): links from pages of one host to another host."""
    target = lambda x: F.when(x.startswith("//"), host_of(F.concat(F.lit("x:"), x))).otherwise(host_of(x))
    out = pages.select(host_of(F.col(url)).alias("src"), F.explode(F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)), target)).alias("dst"))
    out = out.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return out.groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread(seeds: DataFrame, links: DataFrame, flow: TrustFlow, label: str) -> DataFrame:
    """Personalised PageRank: (host, score). Every seed holds 1; what reaches a host without links ends there."""
    total = links.groupBy(F.col("src").alias("total_src")).agg(F.sum("links").alias("total"))
    edges = stage(links.join(total, F.col("src") == F.col("total_src")).select("src", "dst", (F.col("links") / F.col("total")).alias("part")), f"{label}-edges")
    start = seeds.select("host", F.lit(1.0).alias("score"))
    kept = seeds.select("host", F.lit(1.0 - flow.damping).alias("score"))
    scores = written = start
    step, moving = 0, True
    while moving:
        step += 1
        if step > max(flow.most_steps, flow.steps):
            raise RuntimeError(f"{label} scores do not stand after {flow.most_steps} steps")
        moved = edges.join(scores, edges["src"] == scores["host"]).select(F.col("dst").alias("host"), (flow.damping * F.col("part") * F.col("score")).alias("score"))
        scores = kept.unionByName(moved).groupBy("host").agg(F.sum("score").alias("score"))
        last = flow.tolerance is None and step == flow.steps
        if step % flow.steps_between_writes == 0 or last:
            scores = stage(scores, f"{label}-scores")
            moving = not last and (flow.tolerance is None or step < flow.steps or still_moving(written, scores, flow.tolerance))
            written = scores
    return scores


def still_moving(before: DataFrame, after: DataFrame, tolerance: float) -> bool:
    """Whether scores changed by more than that share of them all, or a host was reached that had none."""
    both = before.select("host", (-F.col("score")).alias("score"), F.lit(1).alias("old")).unionByName(after.select("host", "score", F.lit(0).alias("old")))
    change = both.groupBy("host").agg(F.abs(F.sum("score")).alias("change"), F.max("old").alias("old"))
    found = change.agg(F.sum("change").alias("change"), F.count_if(F.col("old") == 0).alias("reached")).first()
    mass = after.agg(F.sum("score")).first()[0] or 0.0
    return (found["change"] or 0.0) > tolerance * mass or found["reached"] > 0


def judge(pages: DataFrame, rules: dict[str, str], flow: TrustFlow = TrustFlow(), key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Key, host, path, rule and verdict of every page."""
    placed = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    placed = placed.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    placed = placed.withColumn("ruled", verdict_of(F.col("rule"), rules))
    of_host = placed.where(F.col("host") != "").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked"))
    seeds = stage(of_host.where((2 * F.col("allowed") > F.col("n")) | (2 * F.col("blocked") > F.col("n"))), "seeds")
    links = stage(host_links(pages, url, html), "links")
    trust = spread(seeds.where(2 * F.col("allowed") > F.col("n")), links, flow, "trust")
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    distrust = spread(seeds.where(2 * F.col("blocked") > F.col("n")), back, flow, "distrust")
    both = trust.select("host", F.col("score").alias("trust"), F.lit(0.0).alias("distrust")).unionByName(distrust.select("host", F.lit(0.0).alias("trust"), F.col("score").alias("distrust")))
    bad = both.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).where((F.col("distrust") > 0) & (F.col("distrust") >= flow.threshold * (F.col("trust") + F.col("distrust"))))
    judged = placed.join(bad.select(F.col("host").alias("bad_host")), F.col("host") == F.col("bad_host"), "left")
    own = F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow")
    return judged.select(key, "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"))


def check_sql(rules: dict[str, str], flow: TrustFlow = TrustFlow()) -> str:
    """The same in SQL for DuckDB, with the steps written out."""
    host = lambda x: f"coalesce(translate(regexp_extract({x}, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '')"
    rule = "NULL"
    for r in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = r.partition("/")
        rule = f"CASE WHEN (host = '{name}' OR suffix(host, '.{name}')) AND prefix(path, '/{rest}') THEN '{r}' ELSE {rule} END"
    ruled = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in rules.items())
    link = LINK.replace("'", "''")
    sql = f"""
WITH placed AS (SELECT page_id, html, {host("url")} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (SELECT *, CASE rule {ruled} END AS ruled FROM (SELECT page_id, host, path, {rule} AS rule FROM placed)),
of_host AS (SELECT host, count(*) AS n, count_if(ruled = 'allow') AS allowed, count_if(ruled = 'block') AS blocked FROM ruled WHERE host <> '' GROUP BY host),
target AS (SELECT host AS src, CASE WHEN prefix(t, '//') THEN {host("'x:' || t")} ELSE {host("t")} END AS dst
           FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS t FROM placed)),
links AS (SELECT src, dst, count(*) AS links FROM target WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
trust_edges AS (SELECT src, dst, links / sum(links) OVER (PARTITION BY src) AS part FROM links),
distrust_edges AS (SELECT dst AS src, src AS dst, links / sum(links) OVER (PARTITION BY dst) AS part FROM links),
trust_seeds AS (SELECT host FROM of_host WHERE 2 * allowed > n), distrust_seeds AS (SELECT host FROM of_host WHERE 2 * blocked > n),
"""
    for kind in ("trust", "distrust"):
        sql += f"{kind}0 AS (SELECT host, 1.0::DOUBLE AS score FROM {kind}_seeds),\n"
        for k in range(1, flow.steps + 1):
            sql += (
                f"{kind}{k} AS MATERIALIZED (SELECT host, sum(score) AS score FROM (SELECT host, {1.0 - flow.damping}::DOUBLE AS score FROM {kind}_seeds UNION ALL "
                f"SELECT e.dst, {flow.damping}::DOUBLE * part * score FROM {kind}_edges e JOIN {kind}{k - 1} s ON e.src = s.host) GROUP BY host),\n"
            )
    return sql + f"""bad AS (SELECT d.host FROM distrust{flow.steps} d LEFT JOIN trust{flow.steps} t ON d.host = t.host
        WHERE d.score > 0 AND d.score >= {flow.threshold} * (coalesce(t.score, 0) + d.score))
SELECT page_id, host, path, rule, CASE WHEN ruled IS NOT NULL THEN ruled WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""
