import random
from collections import defaultdict
from datetime import date

import pytest
from rows import rows
from pyspark.sql import functions as F

from tiercraft.operators import attach as attaching
from tiercraft.operators import filters, matching, quality
from tiercraft.operators.attach import attach, measured, settled
from tiercraft.operators.dedupe import dedupe_by_key, first_present, keep_one, latest_per, unique_lookup
from tiercraft.operators.enrich import headcount_attach, headcount_of_people, lookup_normalize
from tiercraft.operators.periods import distinct_months, frozen_months

IDENTITY = (
    "OktaUserId string, OktaUserEmail string, OktaUserFullEmail string, OktaUserEmployeeNumber string, "
    "OktaUserFullName string, OktaUserRegion string, OktaUserCountry string"
)


def person(uid, short, full, number="E", name="N", region="R", country="C"):
    return (uid, short, full, number, name, region, country)


@pytest.fixture(params=["broadcast", "shuffle"])
def either_way(request, monkeypatch):
    """Both ways of attaching: within the broadcast limit, and beyond it."""
    if request.param == "shuffle":
        monkeypatch.setattr(attaching, "BROADCAST_ROWS", 0)
    return request.param


def hot_base(spark):
    """A third of the rows has one key, a fifth has none, the rest spreads out; whole rows repeat."""
    random.seed(7)
    data = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else None if i % 5 == 0 else f"k{random.randrange(900)}"
        data.append((key, i % 1000))
    return spark.createDataFrame(data, "k string, v int").repartition(5), data


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_attach_equals_brute_force(spark, either_way, how):
    base, data = hot_base(spark)
    side_rows = [("hot", "h1"), ("hot", "h2")] + [(f"k{i}", f"s{i}") for i in range(0, 900, 2)]
    side = spark.createDataFrame(side_rows, "k string, s string")
    by_key = defaultdict(list)
    for key, value in side_rows:
        by_key[key].append(value)
    want = []
    for key, v in data:
        hits = by_key.get(key, [])
        if how in ("left", "inner"):
            want += [(key, v, s) for s in hits] or ([(key, v, None)] if how == "left" else [])
        elif bool(hits) == (how == "left_semi"):
            want.append((key, v))
    got = rows(attach(base, measured(side), ["k"], how))
    assert got == sorted(want, key=lambda r: [(x is not None, str(x)) for x in r])


def test_a_large_side_is_joined_in_one_pass_and_hot_keys_are_split(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(attaching, "BROADCAST_ROWS", 0)
    data, _ = hot_base(spark)
    wide = data.withColumn("pad", F.sha2(F.monotonically_increasing_id().cast("string"), 512))
    wide.repartition(8).write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    side = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(900)]], "k string, s int")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.shuffle.partitions": "50",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = attach(base, measured(side), ["k"], "left")
        assert joined.count() == base.count()
        rows = joined.select("k", "s", "pad")
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "skew=true" in plan
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_settled_measures_while_it_computes(spark, monkeypatch):
    df = spark.range(100).withColumn("t", F.lit("x" * 50))
    assert settled(df).small
    monkeypatch.setattr(attaching, "BROADCAST_BYTES", 100 * 50)
    assert not settled(df).small
    assert settled(df).table.count() == 100
    assert settled(spark.range(0)).small


USERS = [
    person("u1", "ann@x.y", "ann.b@x.y"),
    person("u2", "bob@x.y", "bob@x.y", number=None),
    person("u3", "ann@x.y", "carl@x.y"),
    person("u4", " DAN@X.Y ", None, region=None),
    person(None, "ghost@x.y", "ghost@x.y"),
]


def usage(spark, addresses):
    return spark.createDataFrame([(i, a, None) for i, a in enumerate(addresses)], "i int, user string, n string")


def test_either_keeps_every_person_and_rejects_by_address(spark, either_way):
    base = usage(spark, ["ann@x.y", "bob@x.y", "ann.b@x.y", "dan@x.y", "who@x.y", None] + ["bob@x.y"] * 50)
    base = base.unionByName(base.filter("i = 1"))
    identity = spark.createDataFrame(USERS, IDENTITY)
    split = matching.split_either(base, identity, "user")
    got = rows(split.matched, "i", "OktaUserId")
    assert [g for g in got if g[0] < 6] == [(0, "u1"), (0, "u3"), (1, "u2"), (2, "u1"), (3, "u4")]
    assert len(got) == 55  # the repeated row counts once
    # A row with a NULL column is no reject when its address is known.
    assert rows(split.rejects, "i", "user") == [(4, "who@x.y"), (5, None)]
    assert split.rejects.columns == base.columns


def test_fallback_order_and_modes(spark, either_way):
    identity = spark.createDataFrame(
        [
            person("u5", "pat@x.y", "pat@x.y", number=None, name=None),
            person("u2", "other@x.y", "pat@x.y", number="E2", name=None),
            person("u1", "10pat@x.y", "z@x.y", number=None, name="Ten"),
            person("u0", "pat@x.y", "q@x.y", number="E0", name=None),
        ],
        IDENTITY,
    )
    base = spark.createDataFrame(
        [(1, "10pat@x.y", "pat@x.y"), (2, "pat@x.y", None), (3, "none@x.y", "nope@x.y"), (4, None, None)],
        "i int, a string, b string",
    )
    got = rows(
        matching.match_fallback(base, identity, "a", "b"), "i", "OktaUserId", "OktaUserEmployeeNumber", "OktaUserFullName"
    )
    # 1: found by its own address, the missing number comes from the fallback's short address (lowest id u0).
    assert got == [(1, "u1", "E0", "Ten"), (2, "u0", "E0", None), (3, None, None, None), (4, None, None, None)]
    winner = rows(matching.match_fallback(base, identity, "a", "b", mode="winner"), "i", "OktaUserEmployeeNumber")
    assert winner[0] == (1, None)
    split = matching.split_fallback(base, identity, "a", "b")
    assert rows(split.matched, "i") == [(1,), (2,)] and rows(split.rejects, "i") == [(3,), (4,)]


def brute_priority(address, people):
    local = address.split("@")[0]
    rules = [(1, address, 0)]
    if local.startswith("10") and local[2:].isdigit():
        rules.append((2, address[2:], 0))
    if local.endswith(".st"):
        rules.append((3, address.replace(".st@", "@"), 0))
    rules.append((4, local, 1))
    if local.endswith(".st"):
        rules.append((5, local[:-3], 1))
    for _, key, part in rules:
        hits = [
            uid for uid, short, full, *_ in people
            if key in ((short, full) if part == 0 else (short.split("@")[0], full.split("@")[0]))
        ]
        if hits:
            return min(hits)
    return None


def test_priority_equals_brute_force_with_a_hot_local_part(spark, either_way):
    random.seed(3)
    people = [
        person(f"u{i:03}", f"{random.choice(['info', 'p%d' % i])}@d{i}.z", f"{random.choice(['10', ''])}{i}@full.z")
        for i in range(120)
    ]
    addresses = []
    for i in range(900):
        n = random.randrange(150)
        addresses.append(
            random.choice([f"info@q{i}.z", f"p{n}@d{n}.z", f"p{n}.st@d{n}.z", f"10{n}@full.z", f"p{n}.st@else.z", f"{n}@u.z"])
            if i % 3 else "info@hot.z"
        )
    base = spark.createDataFrame([(i if i else None, a) for i, a in enumerate(addresses)], "id int, address string")
    got = matching.match_priority(base, spark.createDataFrame(people, IDENTITY), "address", "id")
    want = [(i or None, brute_priority(a, people) if i else None) for i, a in enumerate(addresses)]
    assert rows(got, "id", "okta_user_id") == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])


def test_priority_deals_identities_out_before_it_sorts_their_entries(spark):
    """Read in one task, the identities are still sorted in several, and equal addresses of a person once."""
    people = [person(f"u{i:04}", f"p{i}@x.z", f"p{i}@{'x' if i % 2 else 'y'}.z") for i in range(4000)]
    identity = spark.createDataFrame(people, IDENTITY).coalesce(1)
    addresses = spark.createDataFrame([(f"p{i}@x.z",) for i in range(10)], "address string")
    links = matching.priority_links(addresses, identity, "address")
    plan = links._jdf.queryExecution().executedPlan().toString()
    generates = [i for i, line in enumerate(plan.splitlines()) if "Generate explode" in line and "okta_user_id" in line]
    below = "\n".join(plan.splitlines()[generates[0]:])
    assert "Exchange hashpartitioning(okta_user_id" in below
    assert rows(links, "address", "okta_user_id") == [(f"p{i}@x.z", f"u{i:04}") for i in range(10)]


def test_identity_slim_accepts_both_spellings(spark):
    identity = spark.createDataFrame(USERS, IDENTITY)
    slim = matching.identity_slim(identity)
    assert slim.count() == 4
    assert rows(matching.identity_slim(slim)) == rows(slim)


HEADCOUNT = (
    "Month_No int, OktaUserEmail string, OktaUserEmployeeNumber string, HCBusinessUnit string, HCBusinessUnitCode string, "
    "HCDivision string, HCJobTitle string, HCOffice string, HCTalentSegment string, OktaUserCountry string, "
    "HCDivisionINC string"
)


def test_headcount_short_then_full_address(spark, either_way):
    def card(month, address, number, unit, division=None):
        return (month, address, number, unit, None, None, None, None, None, "X", division)

    headcount = spark.createDataFrame(
        [
            card(202401, "a@x.y", "2", "second"),
            card(202401, "a@x.y", "1", "first"),
            card(202401, "full@x.y", "3", "full", "D1"),
            card(202402, "a@x.y", "1", "later"),
            card(None, "a@x.y", "0", "no month"),
        ],
        HEADCOUNT,
    )
    base = spark.createDataFrame(
        [(1, 202401, "a@x.y", "full@x.y"), (2, 202401, "q@x.y", "full@x.y"), (3, 202403, "a@x.y", None), (4, None, "a@x.y", None)]
        + [(i, 202402, "a@x.y", None) for i in range(5, 300)],
        "i int, m int, short string, full string",
    )
    for function in (headcount_attach, headcount_of_people):
        got = rows(function(base, headcount, "m", "short", "full"), "i", "HCBusinessUnit", "HCMonthNo", "HCDivisionINC")
        assert len(got) == 299
        by_id = {g[0]: g[1:] for g in got}
        assert by_id[1] == ("first", 202401, "D1")
        assert by_id[2] == ("full", 202401, "D1")
        assert by_id[3] == by_id[4] == (None, None, "Others")
        assert by_id[77] == ("later", 202402, "Others")


def test_lookup_adds_no_rows(spark, either_way):
    lookup = spark.createDataFrame(
        [("a", "2"), ("a", "1"), (None, "9"), ("b", None)], "lookup_key string, lookup_value string"
    )
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "i int, c string")
    got = lookup_normalize(base, "c", lookup, "out", "none")
    assert rows(got, "i", "out") == [(1, "1"), (2, "none"), (3, "none"), (4, "none")]
    assert rows(unique_lookup(lookup, "lookup_key", "lookup_value")) == [("a", "1"), ("b", None)]


def test_keep_one_ignores_input_order(spark):
    data = [(1, "b", 5), (1, "a", 5), (1, "z", 9), (2, None, None), (2, "y", None), (None, "n", 1), (None, "m", 1)]
    for seed in range(3):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k int, t string, v int").repartition(3)
        assert rows(keep_one(df, [F.col("k")], [F.col("v")])) == [(None, "m", 1), (1, "a", 5), (2, None, None)]
        assert rows(latest_per(df, ["k"], "v")) == [(None, "m", 1), (1, "z", 9), (2, None, None)]


def test_keep_one_reduces_before_the_shuffle(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    plan = keep_one(df, [F.col("k")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_composite_key_takes_null_as_empty_text(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "", 2), (None, "a", 3)], "x string, y string, v int")
    assert rows(dedupe_by_key(df, F.col("x"), F.col("y")), "v") == [(1,), (3,)]


def test_first_present_is_by_order_and_skips_null(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, None), (1, 2, "b"), (2, 1, None)], "k int, o int, v string")
    assert rows(df.groupBy("k").agg(first_present("v", F.col("o")))) == [(1, "b"), (2, None)]


def test_month_filters(spark):
    df = spark.createDataFrame([(202401, date(2024, 1, 31)), (202402, date(2024, 2, 1)), (None, None)], "m int, d date")
    assert filters.only_month(df, "m", None).count() == 3
    assert rows(filters.only_month(df, "m", 202401), "m") == [(202401,)]
    assert rows(filters.through_month(df, "d", 202401), "m") == [(202401,)]
    assert rows(filters.without_months(df, "m", [202401]), "m") == [(202402,)]
    assert filters.without_months(df, "m", []).count() == 3
    text = spark.createDataFrame([("2024-01-31 23:59:59",), ("2024-02-01",), ("bad",)], "d string")
    assert filters.through_month(text, "d", 202401).count() == 1


def test_exclusions_drop_unknown_regions(spark):
    df = spark.createDataFrame([("R", "T"), ("bad", "T"), (None, "T"), ("R", None), ("R", " WORSE ")], "r string, t string")
    kept = df.filter(filters.outside(F.col("r"), F.col("t"), ["BAD"], ["worse"]))
    assert rows(kept) == [("R", "T")]


def test_scan_predicate(spark):
    df = spark.createDataFrame(
        [("2024-01-31", "it's"), ("2024-02-01", "b"), ("2024-02-29", "it's"), ("2024-03-01", "b")],
        "CreationDate string, FileName string",
    )
    month = filters.scan_predicate("CreationDate", month="2024-02", min_date="2024-03-01")
    assert df.filter(month).count() == 2
    assert df.filter(filters.scan_predicate("CreationDate", min_date="2024-02-29", files=["it's"])).count() == 1
    assert filters.scan_predicate("CreationDate") is None


def test_months_and_ledger(spark):
    ledger = spark.createDataFrame(
        [(" Cursor", 202403), ("ALL", 202401), ("copilot", 202402), ("cursor", 202403), ("cursor", None)],
        "product string, Month_No int",
    )
    assert frozen_months(ledger, "CURSOR ") == [202401, 202403]
    assert distinct_months(ledger, "Month_No") == [202401, 202402, 202403]


def test_quality_figures(spark):
    df = spark.createDataFrame([(1, "NULL"), (1, None), (2, "null")], "i int, t string")
    assert quality.unique_id(df, "i").first()[:] == (3, 2)
    assert quality.unique_id(df, "i", approximate=True).first()[:] == (3, 2)
    assert quality.text_null(df, "t").first()[:] == (3, 2)
    parsed = F.col("t").try_cast("int")
    assert quality.null_after_cast(df, F.col("t"), parsed).first()[:] == (3, 3, 2)
    assert quality.row_delta(df, df.filter("i = 1")).first()[:] == (3, 2, 1)
    rejects = df.withColumn("why", F.lit("miss"))
    assert rows(quality.reject_rate(df, rejects, "why")) == [("matched", 3), ("miss", 3)]


def test_keep_one_sorts_by_key_and_order_alone(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id % 3 AS o", "cast(id AS string) AS wide", "map('a', id) AS extra")
    kept = keep_one(df, [F.col("k")], [F.col("o").desc()])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "- Sort [" in line or ":- Sort [" in line or "Sort [" in line]
    assert sorts and not any("wide" in line for line in sorts)
    assert plan.count("Exchange hashpartitioning") == 1
    assert rows(kept, "k", "o", "wide", "extra") == [(0, 2, "2", {"a": 2}), (1, 2, "5", {"a": 5})]
