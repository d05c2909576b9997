import pytest
from rows import rows

from tiercraft.operators import matching
from tiercraft.plans.priority import priority_base
from tiercraft.session import METHOD_BYTES, METHOD_SETTING
from tiercraft.sources.store import Warehouse
from tiercraft.workload import tables
from tiercraft.workload.adapters import DEALT_BY, Bronze
from tiercraft.workload.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_wide_rows_are_compiled_unless_the_deployment_says_otherwise(spark, tmp_path):
    session = spark.newSession()
    for make in (lambda: Warehouse(session, "silver_m", "gold_m", str(tmp_path)), lambda: Bronze(session, FOLDER)):
        session.conf.unset(METHOD_SETTING)
        make()
        assert session.conf.get(METHOD_SETTING) == METHOD_BYTES
    session.conf.set(METHOD_SETTING, "20000")
    Warehouse(session, "silver_m", "gold_m", str(tmp_path))
    assert session.conf.get(METHOD_SETTING) == "20000"


@pytest.mark.parametrize("name", DEALT_BY)
def test_wide_bronze_rows_are_made_in_several_tasks(spark, monkeypatch, name):
    """The given table lies in one row group, so one task reads it; the bronze rows are the same either way."""
    table, columns = DEALT_BY[name]
    dealt = Bronze(spark, FOLDER).table(name)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert f"Exchange hashpartitioning({columns[0]}#" in plan and "REPARTITION_BY_COL" in plan
    monkeypatch.setattr("tiercraft.workload.adapters.DEALT_BY", {})
    assert rows(dealt) == rows(Bronze(spark, FOLDER).table(name))


def test_usage_addresses_are_dealt_out_before_they_are_sorted(spark):
    """The task that reads the given rows sorts none of them: they are ranked within a record id after they are dealt out."""
    plan = priority_base(Bronze(spark, FOLDER).table("usage_digits"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    below = plan[plan.rindex("WindowGroupLimit"):]
    assert "Sort [" in below and "Exchange hashpartitioning(event_id#" in below


def _sorted_where_read(node, above=()):
    """Sorting steps of a plan that run in the task that reads a given table, each with the steps up to the last exchange."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _sorted_where_read(node.initialPlan())
    if name.startswith("Scan parquet"):
        return [above] if any(step.startswith(("Sort", "WindowGroupLimit")) for step in above) else []
    above = () if "Exchange" in name else (*above, name)
    children = node.children()
    return [found for i in range(children.size()) for found in _sorted_where_read(children.apply(i), above)]


@pytest.mark.parametrize("name", ["identity_priority", "left_attach_winner", "priority_match_log"])
def test_priority_queries_sort_nothing_in_the_task_that_reads_it(spark, monkeypatch, name):
    """With a table in one row group that task has all its rows; the sides that are settled on the way count as well."""
    frames = []

    def settled(df, inner=matching.settled):
        frames.append(df)
        return inner(df)

    for module in (matching, tables):
        monkeypatch.setattr(module, "settled", settled)
    frames.append(QUERIES[name](spark, FOLDER))
    assert len(frames) == 2
    for df in frames:
        assert _sorted_where_read(df._jdf.queryExecution().executedPlan()) == []
