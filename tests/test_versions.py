"""Versioned tables: one commit a write, the key index, moved keys, what a run reads."""

import shutil

import pytest
from pyspark.sql import functions as F
from rows import rows
from test_plans import AUDIT, CHAT, GOLDEN, RUN, USAGE, audit_row, load, usage_row
from test_plans import headcount, identity  # noqa: F401  (fixtures)

from tiercraft.operators import attach as attaching
from tiercraft.operators import matching
from tiercraft.plans import audit, runs, usage
from tiercraft.plans.dimensions import Exclusions
from tiercraft.sources.catalogue import Catalogue, Table
from tiercraft.sources.versions import KEPT, Versions

T = "silver.t"
START = [(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, 3, "d"), (5, None, "e")]


def frame(spark, data, schema="k int, m int, v string"):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def filled(spark, store):
    store.overwrite(frame(spark, START), T, "m")
    return store


def table(store, name=T):
    return rows(store.read(name), "k", "m", "v")


def lose_month(store, name, month):
    """Remove the files of a month, so that whoever reads them fails."""
    manifest = store.versions.current(store.name(name))
    for piece in manifest.pieces:
        if piece.month == month:
            shutil.rmtree(piece.data.removeprefix("file:"))


WRITES = {
    "replace": lambda s, df: s.replace_months(df, T, "m", [1, 3, None]),
    "upsert": lambda s, df: s.upsert(df, T, ["k"], ["v"], "m", fixed_month=False),
    "rebuild": lambda s, df: s.preserve_frozen(df, T, "m", [2], ["k"], ["v"], mode="rebuild_open", fixed_month=False),
    "overwrite": lambda s, df: s.overwrite(df, T, "m"),
    "columns": lambda s, df: s.overwrite(df.withColumn("other", F.lit(1)).drop("v"), T, "m"),
    "append": lambda s, df: s.append(df, T, "m"),
}


@pytest.mark.parametrize("write", WRITES)
@pytest.mark.parametrize("fails", ["point", "_create", "index_all"])
def test_a_write_that_fails_before_its_commit_changes_nothing(filled, spark, monkeypatch, write, fails):
    before, columns = table(filled), filled.read(T).columns
    batch = frame(spark, [(3, 1, "moved"), (9, 3, "new")])
    with monkeypatch.context() as broken:
        broken.setattr(Versions, fails, lambda *a, **k: 1 / 0)
        if fails != "index_all" or write in ("upsert", "rebuild"):
            with pytest.raises(ZeroDivisionError):
                WRITES[write](filled, batch)
            assert table(filled) == before and filled.read(T).columns == columns
            assert rows(spark.table(filled.name(T)), "k", "m", "v") == before
    WRITES[write](filled, batch)
    assert filled.read(T).filter("k = 9").count() == 1


def test_all_months_of_a_write_are_one_commit(filled, spark, monkeypatch):
    """Whatever is seen while a write runs is the table before it or after it."""
    seen = []
    point = Versions.point

    def watched(self, name, manifest):
        seen.append(rows(spark.table(name), "k", "m"))
        point(self, name, manifest)
        seen.append(rows(spark.table(name), "k", "m"))

    monkeypatch.setattr(Versions, "point", watched)
    filled.replace_months(frame(spark, [(7, 1, "z"), (8, 2, "y")]), T, "m", [1, 2, 3, None])
    assert seen == [sorted([(k, m) for k, m, _ in START], key=lambda r: [(v is not None, str(v)) for v in r]), [(7, 1), (8, 2)]]


def test_readers_of_the_version_before_go_on(filled, spark):
    old = filled.read(T)
    filled.replace_months(frame(spark, [(7, 1, "z")]), T, "m", [1, 2, 3])
    assert old.count() == 5 and filled.read(T).count() == 2


def test_folders_of_old_versions_go(filled, spark):
    name = filled.name(T)
    first = filled.versions.current(name).pieces
    for k in range(KEPT + 1):
        filled.replace_months(frame(spark, [(7, 1, f"z{k}")]), T, "m", [1])
    there = lambda piece: __import__("os").path.isdir(piece.data.removeprefix("file:"))
    assert {p.month: there(p) for p in first} == {1: False, 2: True, 3: True, None: True}
    versions = [t.name for t in spark.catalog.listTables(name.split(".")[0]) if t.name.startswith("t__v")]
    assert len(versions) == KEPT and table(filled)[-1] == (7, 1, f"z{KEPT}")


@pytest.mark.parametrize("limit", [None, 0])
def test_a_moved_key_is_found_without_reading_other_months(filled, spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(attaching, "BROADCAST_ROWS", limit)
    filled.upsert(frame(spark, [(9, 3, "x")]), T, ["k"], ["v"], "m", fixed_month=False)
    lose_month(filled, T, 2)
    filled.upsert(frame(spark, [(1, 3, "moved")]), T, ["k"], ["v"], "m", fixed_month=False)
    got = rows(filled.read(T).filter("m <> 2 OR m IS NULL"), "k", "m", "v")
    assert got == [(1, 3, "moved"), (2, 1, "b"), (4, 3, "d"), (5, None, "e"), (9, 3, "x")]
    assert filled.versions.current(filled.name(T)).keys == ("k",)


def test_the_index_follows_every_kind_of_write(filled, spark):
    move = lambda k: filled.upsert(frame(spark, [(k, 4, "moved")]), T, ["k"], ["v"], "m", fixed_month=False)
    move(1)
    filled.append(frame(spark, [(20, 2, "appended")]), T, "m")
    filled.replace_months(frame(spark, [(30, 3, "replaced")]), T, "m", [3])
    filled.overwrite_preserve_frozen(frame(spark, [(40, 1, "full"), (50, 5, "full")]), T, "m", [2, 3])
    for k in (20, 30, 40, 50):
        move(k)
    assert [r for r in table(filled) if r[0] in (20, 30, 40, 50)] == [(k, 4, "moved") for k in (20, 30, 40, 50)]
    assert filled.read(T).groupBy("k").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("limit", [None, 0])
def test_no_mode_stores_a_key_twice(filled, spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(attaching, "BROADCAST_ROWS", limit)
    batch = frame(spark, [(1, 2, "lies in closed month 1"), (3, 3, "moved"), (6, 4, "new")])
    assert filled.preserve_frozen(batch, T, "m", [1], ["k"], ["v"], mode="rebuild_open", fixed_month=False) == 1
    assert table(filled) == [(1, 1, "a"), (2, 1, "b"), (3, 3, "moved"), (6, 4, "new")]
    # A close of month 5: key 1 lies in a closed month, key 3 in an open one.
    close = frame(spark, [(1, 5, "closed"), (3, 5, "here now"), (8, 5, "new")])
    assert filled.replace_months(close, T, "m", [5], keys=["k"], frozen=[1]) == 1
    assert table(filled) == [(1, 1, "a"), (2, 1, "b"), (3, 5, "here now"), (6, 4, "new"), (8, 5, "new")]


def test_changed_months(filled, spark):
    first = filled.version(T)
    assert filled.changed_months(T, first) == set() and filled.changed_months(T, None) is None
    filled.replace_months(frame(spark, [(7, 1, "z")]), T, "m", [1, None])
    filled.upsert(frame(spark, [(3, 2, "c2")]), T, ["k"], ["v"], "m")
    assert filled.changed_months(T, first) == {1, 2, None}
    assert filled.changed_months(T, 10**6) is None and filled.changed_months("silver.absent", 1) is None


def test_a_plain_table_takes_part_from_its_first_write(store, spark):
    spark.createDataFrame(START, "k int, m int, v string").write.partitionBy("m").saveAsTable(store.name(T))
    assert rows(store.read(T), "k", "m", "v") == rows(frame(spark, START))
    store.replace_months(frame(spark, [(7, 1, "z")]), T, "m", [1])
    assert table(store) == [(3, 2, "c"), (4, 3, "d"), (5, None, "e"), (7, 1, "z")]


def test_declared_columns_hold_no_null(store, spark):
    store.create(T, "k int NOT NULL, m int, v string", "m")
    store.append(frame(spark, [(1, 1, "a")]), T, "m")
    with pytest.raises(Exception, match="NULL in column k"):
        store.append(frame(spark, [(None, 1, "a")]), T, "m")
    assert table(store) == [(1, 1, "a")]


def test_both_outcomes_come_from_one_scan(spark, identity, tmp_path, monkeypatch):  # noqa: F811
    """The base table's files go after the first job that reads them; both outcomes are there all the same."""
    place = str(tmp_path / "base")
    spark.createDataFrame([(i, a) for i, a in enumerate(["bob.smith@corp.com", "x@y.z", None, "x@y.z", "bob.smith@corp.com"])], "i int, user string").withColumn("other", F.col("user")).write.parquet(place)
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(user):
        reads.add(1)
        return user

    for split_of, columns in ((matching.split_either, ["user"]), (matching.split_fallback, ["user", "other"])):
        base = spark.read.parquet(place).withColumn("user", counted.asNondeterministic()("user"))
        before = reads.value
        split = split_of(base, identity, *columns)
        assert rows(split.matched, "i") == [(0,), (4,)] and rows(split.rejects, "i") == [(1,), (2,), (3,)]
        assert rows(split.rejects, "i") and reads.value - before == 5


def test_a_daily_run_makes_only_the_changed_months(spark, store, identity, headcount, monkeypatch):  # noqa: F811
    load(store, identity, headcount)
    day = lambda *days: spark.createDataFrame([usage_row(d, "bob.smith@corp.com") for d in days], USAGE)
    runs.run_usage(store, day("2026-09-10", "2026-10-02"), RUN)
    runs.run_usage_gold(store, RUN)
    runs.run_usage(store, day("2026-10-03"), RUN)
    assert store.changed_months(runs.USAGE, store.notes(runs.USAGE_ACTIVE)[runs.BUILT_FROM]) == {202610}
    lose_month(store, runs.USAGE, 202609)
    lose_month(store, runs.USAGE_ACTIVE, 202609)
    runs.run_usage_gold(store, RUN)
    assert store.read(runs.USAGE_ACTIVE).filter("Month_No = 202610").count() == 2
    version = store.version(runs.USAGE_ACTIVE)
    runs.run_usage_gold(store, RUN)  # nothing has changed
    assert store.version(runs.USAGE_ACTIVE) == version


def test_a_run_that_failed_is_made_up_for(spark, store, identity, headcount):  # noqa: F811
    load(store, identity, headcount)
    day = lambda d: spark.createDataFrame([usage_row(d, "bob.smith@corp.com")], USAGE)
    runs.run_usage(store, day("2026-09-10"), RUN)
    runs.run_usage_gold(store, RUN)
    for d in ("2026-10-02", "2026-11-02"):  # the facts of the first of these days were not made
        runs.run_usage(store, day(d), RUN)
    runs.run_usage_gold(store, RUN)
    assert rows(store.read(runs.USAGE_ACTIVE), "Month_No") == [(202609,), (202610,), (202611,)]


def test_audit_records_that_move(spark, store, identity, headcount):  # noqa: F811
    from dataclasses import replace

    load(store, identity, headcount)
    record = lambda r, day: audit_row(r, day, "bob.smith@corp.com", CHAT)
    runs.run_audit(store, spark.createDataFrame([record("r1", "2026-09-15"), record("r2", "2026-09-16"), record("r5", "2026-10-01")], AUDIT), RUN)
    store.freeze_append(runs.AUDIT_PRODUCT, 202609)
    moved = spark.createDataFrame([record("r1", "2026-10-15"), record("r5", "2026-11-01"), record("r6", "2026-10-05")], AUDIT)
    where = lambda: rows(store.read(runs.AUDIT), audit.RECORD_ID, audit.MONTH)
    runs.run_audit(store, moved, RUN, mode="rebuild_open")
    assert where() == [("r1", 202609), ("r2", 202609), ("r5", 202611), ("r6", 202610)]
    again = spark.createDataFrame([record("r2", "2026-10-20"), record("r5", "2026-10-21")], AUDIT)
    runs.run_audit(store, again, replace(RUN, close_month=202610))
    assert where() == [("r1", 202609), ("r2", 202609), ("r5", 202610)]
    figures = [r.value for r in store.read(runs.METRICS).filter(f"table_name = '{runs.AUDIT}' AND figure = 'left_in_closed_months'").orderBy("measured_at").collect()]
    assert figures == [0, 1, 1]


def test_figures_of_a_run(spark, store, identity, headcount):  # noqa: F811
    load(store, identity, headcount)
    runs.run_usage(store, spark.createDataFrame([usage_row("2026-09-10", a) for a in ("bob.smith@corp.com", "q@corp.com", "z@corp.com")], USAGE), RUN)
    figures = {r.figure: r.value for r in store.read(runs.METRICS).filter(f"table_name = '{runs.USAGE}'").collect()}
    assert figures == {"rows_matched": 1, "rows_rejected": 2}


def test_alerts_read_bronze_once(spark, store, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        reads.add(1)
        return text

    names = "NotificationID string, notification_type string, description string, IsActive string, publication_date string, severity string, execution_date string"
    bronze = spark.createDataFrame([(str(k % 4), "t", "d", "true", "2026-02-01", "hi", "2026-01-02") for k in range(10)], names)
    runs.run_alerts(store, bronze.withColumn("severity", counted.asNondeterministic()("severity")))
    figures = {r.figure: r.value for r in store.read(runs.METRICS).collect()}
    assert figures == {"rows_in": 10, "rows_out": 4, "rows_dropped": 6, "row_count": 4, "distinct_ids": 4}
    assert reads.value == 10


def test_catalogue(spark, store, identity, headcount, tmp_path):  # noqa: F811
    path = str(tmp_path / "usage")
    spark.createDataFrame([usage_row("2026-09-10", "bob.smith@corp.com")], USAGE).write.parquet(path)
    schema = store.schemas["silver"] + "_bronze"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{tmp_path}/bronze'")
    spark.createDataFrame([("ES", "Spain")], "Country string, DisplayName string").write.saveAsTable(f"{schema}.country_lookup")
    spark.createDataFrame(GOLDEN, AUDIT).write.saveAsTable(f"{schema}.audit")
    tables = runs.catalogue(store, schema, {"bronze.usage": path, "bronze.countries": f"{schema}.country_lookup"})
    assert tables.table("bronze.usage").form == "parquet" and not tables.exists("bronze.priority")
    assert tables.table(runs.AUDIT).key == (audit.RECORD_ID,) and tables.table(runs.USAGE).month_col == usage.MONTH
    load(store, identity, headcount)
    runs.run_daily(store, tables, RUN, Exclusions())
    assert store.read(runs.USAGE_ACTIVE).count() == 1 and store.read(runs.AUDIT_ACTIVE).count() == 2
    assert tables.read("silver.purview_copilot_usage").count() == 2
    with pytest.raises(KeyError, match="no table bronze.usagge"):
        runs.catalogue(store, schema, {"bronze.usagge": path})
    with pytest.raises(LookupError, match="country lookup"):
        runs.run_daily(store, Catalogue(spark, [Table("countries", "bronze", f"{schema}.absent"), *[Table(n, "bronze", f"{schema}.{n}") for n in ("usage",)]]), RUN, Exclusions())


def test_merge_statement_is_one_that_spark_knows(spark):
    from tiercraft.sources.merge import merge, merge_statement

    text = merge_statement("db.t", "s", ["k", "m", "odd `name"], ["k"], "m", [202401, 202402])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in plan and "202402" in plan
    assert "WHEN MATCHED THEN" in merge_statement("db.t", "s", ["k", "v"], ["k"])
    with pytest.raises(Exception, match="(?i)merge|table|not found|unsupported"):  # plain Parquet tables have no merge
        merge(frame(spark, START), "absent_db.t", ["k"], ["v"], "m", [1])
    assert "merge_source" not in [t.name for t in spark.catalog.listTables()]
