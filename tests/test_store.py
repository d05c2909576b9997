from datetime import datetime

import pytest
from rows import rows
from pyspark.sql import functions as F

from tiercraft.operators import attach as attaching
from tiercraft.session import shared_folder, stage
from tiercraft.sources import scan

T = "silver.t"


def frame(spark, data, schema="k int, m int, v string"):
    return spark.createDataFrame(data, schema)


@pytest.fixture
def filled(spark, store):
    store.overwrite(frame(spark, [(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, 3, "d"), (5, None, "e")]), T, "m")
    return store


def table(store):
    return rows(store.read(T), "k", "m", "v")


def files_of(store, month):
    return {r[0] for r in store.read(T).filter(f"m = {month}").select(F.col("_metadata.file_path")).collect()}


def test_overwrite_replaces_the_schema(filled, spark):
    filled.overwrite(frame(spark, [(1, "x")], "k int, other string"), T)
    assert filled.read(T).columns == ["k", "other"]


def test_append_creates_then_adds(store, spark):
    store.append(frame(spark, [(1, 1, "a")]), T, "m")
    store.append(frame(spark, [(2, 1)], "k int, m int"), T, "m")
    assert table(store) == [(1, 1, "a"), (2, 1, None)]


@pytest.mark.parametrize("limit", [None, 0])
def test_upsert_is_idempotent_and_touches_only_its_months(filled, spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(attaching, "BROADCAST_ROWS", limit)
    untouched = files_of(filled, 2)
    batch = frame(spark, [(1, 1, "new", 1), (1, 1, "older", 0), (9, 3, "add", 1), (5, None, "e2", 1)], "k int, m int, v string, o int")
    for _ in range(2):
        filled.upsert(batch, T, ["k"], ["o"], "m")
        assert table(filled) == [(1, 1, "new"), (2, 1, "b"), (3, 2, "c"), (4, 3, "d"), (5, None, "e2"), (9, 3, "add")]
    assert files_of(filled, 2) == untouched
    assert "o" in filled.read(T).columns  # a new column is added, older rows have NULL


def test_upsert_moves_a_key_to_its_new_month(filled, spark):
    filled.upsert(frame(spark, [(3, 3, "moved")]), T, ["k"], ["v"], "m", fixed_month=False)
    assert table(filled) == [(1, 1, "a"), (2, 1, "b"), (3, 3, "moved"), (4, 3, "d"), (5, None, "e")]


def test_upsert_rejects_null_keys(filled, spark):
    before = table(filled)
    with pytest.raises(Exception, match="NULL in merge key"):
        filled.upsert(frame(spark, [(None, 1, "x")]), T, ["k"], ["v"], "m")
    assert table(filled) == before


def test_upsert_does_not_depend_on_row_order(spark, store):
    data = [(i % 7, i % 7 % 3, f"v{i:03}") for i in range(200)]
    for n, order in enumerate((data, data[::-1])):
        store.upsert(frame(spark, order).repartition(n + 2), f"silver.t{n}", ["k"], ["v"], "m")
    assert rows(store.read("silver.t0")) == rows(store.read("silver.t1"))


def test_replace_months(filled, spark):
    untouched = files_of(filled, 2)
    assert filled.stored_months(T) == {1, 2, 3, None}
    filled.replace_months(frame(spark, [(7, 1, "z")]), T, "m", [1, 3])
    assert table(filled) == [(3, 2, "c"), (5, None, "e"), (7, 1, "z")]
    assert files_of(filled, 2) == untouched
    filled.replace_months(frame(spark, []), T, "m", [1, None])
    assert table(filled) == [(3, 2, "c")]
    filled.replace_months(frame(spark, [(8, 2, "q")]), T, "m", [])
    assert table(filled) == [(3, 2, "c")]


def test_replace_months_refuses_other_months(filled, spark):
    before = table(filled)
    for stray in (2, None):
        with pytest.raises(Exception, match="month outside the replaced ones"):
            filled.replace_months(frame(spark, [(7, 1, "z"), (8, stray, "y")]), T, "m", [1])
    assert table(filled) == before


def test_replace_months_creates_a_missing_table(store, spark):
    store.replace_months(frame(spark, [(7, 1, "z")]), T, "m", [1, 2])
    assert table(store) == [(7, 1, "z")]


def test_preserve_frozen_modes(filled, spark):
    batch = frame(spark, [(1, 1, "frozen"), (3, 2, "c2"), (6, 4, "new")])
    closed = files_of(filled, 1)
    filled.preserve_frozen(batch, T, "m", [1], ["k"], ["v"])
    assert table(filled) == [(1, 1, "a"), (2, 1, "b"), (3, 2, "c2"), (4, 3, "d"), (5, None, "e"), (6, 4, "new")]
    filled.preserve_frozen(batch, T, "m", [1], mode="rebuild_open")
    assert table(filled) == [(1, 1, "a"), (2, 1, "b"), (3, 2, "c2"), (6, 4, "new")]
    assert filled.stored_months(T) == {1, 2, 4}
    assert files_of(filled, 1) == closed


def test_overwrite_preserve_frozen(filled, spark):
    filled.overwrite_preserve_frozen(frame(spark, [(1, 1, "x"), (8, 2, "y")]), T, "m", [1])
    assert table(filled) == [(1, 1, "a"), (2, 1, "b"), (8, 2, "y")]
    filled.overwrite_preserve_frozen(frame(spark, [(1, 1, "x")]), T, "m", [])
    assert table(filled) == [(1, 1, "x")]


def test_freeze_ledger(store):
    assert store.frozen_months("cursor") == []
    at = datetime(2024, 1, 1)
    assert store.freeze_append(" Cursor", 202401, at=at)
    assert not store.freeze_append("cursor", 202401, at=at)
    assert store.freeze_append("all", 202402, by="someone", notes="signed off", at=at)
    assert not store.freeze_append("cursor", 202402, at=at)
    assert store.frozen_months("CURSOR") == [202401, 202402]
    assert store.frozen_months("copilot") == [202402]
    ledger = rows(store.read("gold.ingest_freeze_control"), "product", "Month_No", "frozen_by", "notes")
    assert ledger == [
        ("all", 202402, "someone", "signed off"),
        ("cursor", 202401, "cursor_pipeline", "Month-close auto-freeze"),
    ]


def test_create_from_ddl(store):
    from tiercraft.plans.audit import MONTH, reject_ddl

    store.create("silver.rejects", reject_ddl(), MONTH)
    columns = store.read("silver.rejects").dtypes
    assert len(columns) == 34
    assert reject_ddl().count("NOT NULL") == 4


def test_stage_and_snapshots(spark, tmp_path):
    df = frame(spark, [(1, 1, "a")])
    staged = stage(df, "x")
    assert rows(staged) == rows(df)
    assert shared_folder(spark) in staged.inputFiles()[0].replace("file://", "")
    scan.snapshot_save(df, "s")
    scan.snapshot_save(df.limit(0), "s", "k > 1")
    assert scan.snapshot_load(spark, "s").count() == 1
    assert scan.snapshot_load(spark, "s", "k > 1", df.schema).count() == 0


def test_scans(spark, store, tmp_path):
    path = str(tmp_path / "files")
    frame(spark, [(1, 1, "a"), (2, 2, "b")]).write.json(path)
    assert rows(scan.read_json_lines(spark, path, "k int, v string")) == [(1, "a"), (2, "b")]
    assert rows(scan.read_path(spark, path, "json", "v string")) == [("a",), ("b",)]
    store.overwrite(frame(spark, [(1, 1, "a"), (2, 2, "b")]), T)
    assert scan.read_table(spark, store.name(T)).count() == 2
    one = scan.scan(store.read(T), ["k"], F.col("v") == "b")
    assert rows(one) == [(2,)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(v,b)" in plan and "ReadSchema: struct<k:int,v:string>" in plan
    assert scan.empty_table(spark, "a int").isEmpty()


@pytest.mark.parametrize("month", [None, "m"])
def test_a_full_load_that_fails_leaves_the_table(spark, store, month):
    store.overwrite(frame(spark, [(1, 1, "a"), (2, 2, "b")]), T, month)
    broken = frame(spark, [(9, 1, "z")]).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    for bad in (broken, broken.withColumn("extra", F.lit(1))):
        with pytest.raises(Exception, match="broken"):
            store.overwrite(bad, T, month)
        assert table(store) == [(1, 1, "a"), (2, 2, "b")]


@pytest.mark.parametrize("month", [None, "m"])
def test_a_full_load_may_read_the_table_itself(spark, store, month):
    store.overwrite(frame(spark, [(1, 1, "a"), (2, 2, "b"), (3, None, "c")]), T, month)
    store.overwrite(store.read(T).filter("k > 1").withColumn("v", F.upper("v")), T, month)
    assert table(store) == [(2, 2, "B"), (3, None, "C")]
    store.overwrite(store.read(T).withColumn("more", F.lit(1)), T, month)
    assert rows(store.read(T), "k", "more") == [(2, 1), (3, 1)]


@pytest.mark.parametrize("limit", [None, 0])
def test_a_key_of_a_closed_month_stays_there(filled, spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(attaching, "BROADCAST_ROWS", limit)
    batch = frame(spark, [(1, 2, "moved"), (3, 3, "moved"), (7, 2, "new")])
    assert filled.preserve_frozen(batch, T, "m", [1], ["k"], ["v"], fixed_month=False) == 1
    assert table(filled) == [(1, 1, "a"), (2, 1, "b"), (3, 3, "moved"), (4, 3, "d"), (5, None, "e"), (7, 2, "new")]


def test_a_cluster_must_name_its_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tiercraft.session import shared_folder as folder_of

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        folder_of(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None)))
