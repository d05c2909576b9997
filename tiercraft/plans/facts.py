"""Gold facts: daily activity and onboarding, for streams A ("usage") and B ("audit")."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.context import RunContext
from tiercraft.functions.columns import quoted
from tiercraft.functions.dates import month_no
from tiercraft.functions.interactions import hours_saved, hours_total
from tiercraft.functions.keys import surrogate_key
from tiercraft.operators.dedupe import first_present, latest_per
from tiercraft.operators.filters import only_month, required, through_month, without_months
from tiercraft.plans import layouts
from tiercraft.plans.layouts import FACT_SOURCES

# The attributes a fact row takes from the first silver row that has them.
ATTRIBUTES = (
    "month",
    "full_name",
    "employee_number",
    "email",
    "full_email",
    "region",
    "country",
    "business_unit",
    "job_title",
    "headcount_country",
    "office",
    "talent_segment",
    "division",
    "business_unit_code",
)


def active_daily(silver: DataFrame, stream: str = "usage") -> DataFrame:
    """Requests per (day, person): the number of rows. Attributes: the first present one by ingestion and key."""
    source = FACT_SOURCES[stream]
    return silver.groupBy(source["day"], source["user_id"]).agg(
        F.count(F.lit(1)).cast("int").alias("Request"), *_first_attributes(source)
    )


def active_by_type(silver: DataFrame, stream: str = "audit", at_least: int = 1) -> DataFrame:
    """Requests per (day, person, kind): the sum of prompts; groups under ``at_least`` are left out."""
    source = FACT_SOURCES[stream]
    grouped = silver.groupBy(source["day"], source["user_id"], source["kind"]).agg(
        F.sum(quoted(source["prompts"])).cast("int").alias("Request"), *_first_attributes(source)
    )
    return grouped.filter(quoted("Request") >= at_least)


def _first_attributes(source: Mapping[str, str]) -> list[Column]:
    order = F.struct(quoted(source["ingestion"]), quoted(source["record_key"]))
    return [first_present(source[name], order) for name in ATTRIBUTES]


def usage_active_fact(silver: DataFrame, run: RunContext) -> DataFrame:
    """Stream A activity: one row per day and person."""
    source = FACT_SOURCES["usage"]
    daily = active_daily(_in_scope(silver, source, run))
    asset_id, asset_name = layouts.USAGE_ASSET
    code, name = layouts.USAGE_USE_CASE
    measures = _measures(_amount(layouts.USAGE_HOURS), _amount(layouts.USAGE_AUTOMATION))
    values = {
        "asset_id": F.lit(asset_id),
        "asset_name": F.lit(asset_name),
        "use_case_code": F.lit(code),
        "use_case_name": F.lit(name),
        "key": surrogate_key(daily, source["day"], source["user_id"]),
        **measures,
    }
    return _active_fact(daily, source, values, run)


def audit_active_fact(silver: DataFrame, run: RunContext) -> DataFrame:
    """Stream B activity: one row per day, person and kind of interaction."""
    source = FACT_SOURCES["audit"]
    daily = active_by_type(_in_scope(silver, source, run))
    kind = quoted(source["kind"])
    asset_id, asset_name = layouts.AUDIT_ASSET
    values = {
        "asset_id": F.lit(asset_id),
        "asset_name": F.lit(asset_name),
        "use_case_code": run.interactions.use_case_code(kind),
        "use_case_name": kind,
        "key": surrogate_key(daily, source["day"], source["user_id"], source["kind"]),
        **_measures(run.interactions.hours_saved_factor(kind), run.interactions.automation_factor(kind)),
    }
    return _active_fact(daily, source, values, run)


def onboard_fact(silver: DataFrame, stream: str, run: RunContext) -> DataFrame:
    """One row per day and person: the last ingested one. Frozen months are left out."""
    source = FACT_SOURCES[stream]
    latest = latest_per(
        _in_scope(silver, source, run), [source["day"], source["user_id"]], source["ingestion"], source["record_key"]
    )
    key = surrogate_key(latest, source["day"], source["user_id"])
    fact = _filled(latest, layouts.ONBOARD_FACT, source, {"key": key})
    return required(fact, *layouts.ONBOARD_FACT_REQUIRED)


def with_month(onboard: DataFrame) -> DataFrame:
    """The onboarding fact with the month it is stored under."""
    return onboard.withColumn("Month_No", month_no(quoted("LastModification")))


def _in_scope(silver: DataFrame, source: Mapping[str, str], run: RunContext) -> DataFrame:
    # Month filters come first: the silver table is partitioned by month, so other months are not read.
    rows = without_months(silver, source["month"], run.months_to_skip)
    return through_month(only_month(rows, source["month"], run.close_month), source["day"], run.close_month)


def _active_fact(
    daily: DataFrame, source: Mapping[str, str], values: Mapping[str, Column], run: RunContext
) -> DataFrame:
    fact = _filled(daily, layouts.ACTIVE_FACT, source, {"requests": quoted("Request"), **values})
    fact = required(fact, *layouts.ACTIVE_FACT_REQUIRED)
    fact = through_month(only_month(fact, "Month_No", run.close_month), "LastModification", run.close_month)
    return without_months(fact, "Month_No", run.months_to_skip)


def _filled(
    rows: DataFrame, layout: tuple, source: Mapping[str, str], values: Mapping[str, Column]
) -> DataFrame:
    """The fact's columns: computed values, columns of the rows, or NULL text."""
    columns = []
    for out, name in layout:
        if name is None:
            column = F.lit(None).cast("string")
        else:
            column = values[name] if name in values else quoted(source[name])
        columns.append(column.alias(out))
    return rows.select(*columns)


def _amount(text: str) -> Column:
    return F.lit(text).cast("decimal(18,8)")


def _measures(hours: Column, automation: Column) -> dict[str, Column]:
    multiplier = _amount(layouts.MULTIPLIER)
    return {
        "hours_saved": hours_saved(quoted("Request"), hours, multiplier),
        "hours_total": hours_total(quoted("Request"), hours, automation),
        "active_users": F.lit(1),
        "multiplier": multiplier,
        "automation": automation,
        "hours": hours,
    }
