"""Matching usage rows to people by e-mail address.

The outcome depends on the address alone. Whether a row has a person is a look-up in the addresses of the identity
table, so rows with and without one come out of a single pass over the usage table (``outcomes``). Who that is, is
worked out for the distinct addresses of the matched rows (which combine map-side: a mailbox with a third of all rows
is one row per task) and attached to them in one join.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.functions.columns import Headers, quoted, trim_lower
from tiercraft.functions.email import email_variants, local_part
from tiercraft.operators.attach import Side, attach, settled
from tiercraft.operators.quality import Figures
from tiercraft.session import stage

# Identity columns in their two spellings.
PERSON = (
    "OktaUserId",
    "OktaUserEmail",
    "OktaUserFullEmail",
    "OktaUserEmployeeNumber",
    "OktaUserFullName",
    "OktaUserRegion",
    "OktaUserCountry",
)
PERSON_SNAKE = (
    "okta_user_id",
    "okta_user_email",
    "okta_user_full_email",
    "okta_user_employee_number",
    "okta_user_full_name",
    "okta_user_region",
    "okta_user_country",
)
# The priority rules in order, and what each compares: a whole address or the part before the @.
PRIORITY_RULES = (
    (1, "normalized", "address"),
    (2, "without_10", "address"),
    (3, "without_st", "address"),
    (4, "without_domain", "local"),
    (5, "without_st_domain", "local"),
)


class Split(NamedTuple):
    """The two outcomes of matching a table."""

    matched: DataFrame
    rejects: DataFrame


def people(identity: DataFrame) -> DataFrame:
    """The seven identity columns, found under either spelling, with both addresses normalised."""
    headers = Headers(identity.columns)
    found = {name: headers.column(name, snake) for name, snake in zip(PERSON, PERSON_SNAKE, strict=True)}
    for address in PERSON[1:3]:
        found[address] = trim_lower(found[address])
    return identity.select(*[value.alias(name) for name, value in found.items()])


def identity_slim(identity: DataFrame) -> DataFrame:
    """Normalised identities with the local parts of both addresses, without rows that have no id."""
    short, full = quoted(PERSON[1]), quoted(PERSON[2])
    columns = [quoted(name).alias(snake) for name, snake in zip(PERSON, PERSON_SNAKE, strict=True)]
    return (
        people(identity)
        .filter(quoted(PERSON[0]).isNotNull())
        .select(
            *columns[:3],
            local_part(short).alias("okta_user_email_without_domain"),
            local_part(full).alias("okta_user_full_email_without_domain"),
            *columns[3:],
        )
    )


def _addresses(identity: DataFrame) -> DataFrame:
    """(address, position, person): position 0 for the short address, 1 for the full one."""
    entry = F.posexplode(F.array(quoted(PERSON[1]), quoted(PERSON[2]))).alias("position", "address")
    person = F.struct(*PERSON).alias("person")
    return people(identity).select(person, entry).filter(F.col("address").isNotNull())


def either_links(addresses: DataFrame, identity: DataFrame, email: str) -> DataFrame:
    """``addresses`` (distinct) with every person whose short or full address equals ``email``."""
    known = _addresses(identity).select(F.col("address").alias(email), "person.*").distinct()
    return addresses.join(known, [email], "inner")


_FOUND = "_found"


def known_addresses(identity: DataFrame, with_id: bool = False) -> Side:
    """Every address of the identity table once; ``with_id`` takes those of people who have an id."""
    rows = _addresses(identity)
    rows = rows.filter(F.col("person.OktaUserId").isNotNull()) if with_id else rows
    return settled(rows.select("address").distinct())


def outcomes(base: DataFrame, known: Side, columns: Sequence[str], label: str, seen: Figures | None = None) -> Split:
    """The rows of ``base`` with a known address in one of ``columns``, and the others, from one pass.

    The flag is computed once and one job writes both outcomes, a folder for each; it counts them for ``seen``.
    """
    flagged, flags = base, []
    for i, column in enumerate(columns):
        flags.append(f"{_FOUND}{i}")
        side = known.table.select(F.col("address").alias(column), F.lit(True).alias(flags[-1]))
        flagged = attach(flagged, Side(side, known.small), [column], "left")
    found = F.coalesce(*map(quoted, flags), F.lit(False))
    flagged = flagged.select(*map(quoted, base.columns), found.alias(_FOUND))
    rows = stage(flagged if seen is None else seen.outcomes(flagged, quoted(_FOUND)), label, by=_FOUND)
    return Split(rows.filter(quoted(_FOUND)).drop(_FOUND), rows.filter(~quoted(_FOUND)).drop(_FOUND))


def match_either(base: DataFrame, identity: DataFrame, email: str) -> DataFrame:
    """Distinct base rows x people whose short or full address is ``email``; several people give several rows."""
    links = settled(either_links(base.select(email).distinct(), identity, email))
    return attach(base.distinct(), links, [email], "inner")


def split_either(base: DataFrame, identity: DataFrame, email: str) -> Split:
    """Matched rows as :func:`match_either`; rejects are the base rows whose address nobody has. ``base`` runs once."""
    rows = outcomes(base, known_addresses(identity), [email], "either")
    return Split(match_either(rows.matched, identity, email), rows.rejects)


def fallback_links(
    addresses: DataFrame, identity: DataFrame, email: str, fallback: str, mode: str = "coalesce"
) -> DataFrame:
    """``addresses`` (distinct) that lead to a person, with that person.

    Candidates in order: short address, full address, then both for the fallback address. Of several people with
    one address the lowest id counts. ``mode="coalesce"`` takes each attribute from the first candidate that has
    it; ``mode="winner"`` takes all of them from the first candidate.
    """
    book = _person_book(identity)
    probe = F.posexplode(F.array(quoted(email), quoted(fallback))).alias("attempt", "address")
    hits = addresses.select("*", probe).filter(F.col("address").isNotNull()).join(book, ["address"], "inner")
    order = [(attempt, position) for attempt in (0, 1) for position in (0, 1)]
    found = hits.groupBy(*addresses.columns).agg(
        *[_least(f"person_{p}", F.col("attempt") == a).alias(f"candidate_{a}{p}") for a, p in order]
    )
    return found.select(*addresses.columns, *_chosen([F.col(f"candidate_{a}{p}") for a, p in order], mode))


def _person_book(identity: DataFrame) -> DataFrame:
    """(address, person_0, person_1): the person with the lowest id whose short, or full, address it is."""
    rows = _addresses(identity).filter(F.col("person.OktaUserId").isNotNull())
    return rows.groupBy("address").agg(*[_least("person", F.col("position") == p).alias(f"person_{p}") for p in (0, 1)])


def _chosen(candidates: Sequence[Column], mode: str) -> list[Column]:
    if mode == "winner":
        candidates = [F.coalesce(*candidates)]
    return [F.coalesce(*[c.getField(name) for c in candidates]).alias(name) for name in PERSON]


def _least(person: str, test: Column) -> Column:
    # A person struct starts with the id, so the least struct is the lowest id with a fixed tie-break.
    return F.min(F.when(test, F.col(person)))


def match_fallback(
    base: DataFrame, identity: DataFrame, email: str, fallback: str, mode: str = "coalesce"
) -> DataFrame:
    """Base rows with the identity columns of the person found by ``email``, else by ``fallback``.

    One pass over ``base``: each address is looked up in the book of addresses.
    """
    book, rows, candidates = settled(_person_book(identity)), base, []
    for attempt, column in enumerate((email, fallback)):
        names = [f"_candidate_{attempt}{p}" for p in (0, 1)]
        side = book.table.select(F.col("address").alias(column), *[F.col(f"person_{p}").alias(n) for p, n in enumerate(names)])
        rows = attach(rows, Side(side, book.small), [column], "left")
        candidates += map(F.col, names)
    return rows.select(*map(quoted, base.columns), *_chosen(candidates, mode))


def split_fallback(
    base: DataFrame, identity: DataFrame, email: str, fallback: str, mode: str = "coalesce"
) -> Split:
    """Rows with a person, and the base columns of rows without one. ``base`` runs once."""
    rows = outcomes(base, known_addresses(identity, with_id=True), [email, fallback], "fallback")
    return Split(match_fallback(rows.matched, identity, email, fallback, mode), rows.rejects)


def priority_links(addresses: DataFrame, identity: DataFrame, email: str) -> DataFrame:
    """``addresses`` with the person of the lowest-numbered rule that fits, the lowest id within a rule.

    Identities are reduced to one person per key first, so a local part shared by many people and many addresses
    never pairs them all. Each task sorts its entries for that, so the identities are dealt out before they are
    exploded: a table that is read in few tasks makes no large ones. An address that is both of a person's is one entry.
    """
    slim = identity_slim(identity).repartition("okta_user_id")
    person = F.struct(*PERSON_SNAKE).alias("person")
    entries = [
        (kind, key)
        for kind, suffix in (("address", ""), ("local", "_without_domain"))
        for short, full in [(quoted(f"okta_user_email{suffix}"), quoted(f"okta_user_full_email{suffix}"))]
        for key in (short, F.nullif(full, short))
    ]
    book = (
        slim.select(person, _exploded((F.lit(kind).alias("kind"), key.alias("key")) for kind, key in entries))
        .select("person", "entry.*")
        .filter(F.col("key").isNotNull())
        .groupBy("kind", "key")
        .agg(F.min("person").alias("person"))
    )
    variants = email_variants(quoted(email))
    probes = (
        addresses.select(
            quoted(email),
            _exploded(
                (F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), variants[name].alias("key"))
                for rule, name, kind in PRIORITY_RULES
            ),
        )
        .select(quoted(email), "entry.*")
        .filter(F.col("key").isNotNull())
    )
    return (
        probes.join(book, ["kind", "key"], "inner")
        .groupBy(quoted(email))
        .agg(F.min_by(F.struct("person", "rule"), "rule").alias("best"))
        .select(quoted(email), "best.person.*", F.col("best.rule").alias("match_rule"))
    )


def _exploded(entries) -> Column:
    return F.explode(F.array(*[F.struct(*entry) for entry in entries])).alias("entry")


def match_priority(base: DataFrame, identity: DataFrame, email: str, record_id: str) -> DataFrame:
    """Base rows with the identity columns of the best match; rows without a record id match nobody."""
    key = "_match_address"
    keyed = base.withColumn(key, F.when(quoted(record_id).isNotNull(), quoted(email)))
    seen = keyed.select(key).filter(quoted(key).isNotNull()).distinct()
    links = settled(priority_links(seen, identity, key).drop("match_rule"))
    return attach(keyed, links, [key], "left").drop(key)


def split_matched(joined: DataFrame, person_id: str, base_columns: Sequence[str] | None = None) -> Split:
    """Rows with and without a person."""
    found = quoted(person_id).isNotNull()
    rejects = joined.filter(~found)
    return Split(joined.filter(found), rejects.select(*map(quoted, base_columns)) if base_columns else rejects)
