"""Whole runs over a warehouse: read the inputs, build the tables, write them.

``run_daily`` and ``run_close`` do a whole day or month close in order, from a catalogue of bronze tables or from given
ones; the other functions are their parts. A stored fact has its month as the last column, where partitions are; the
view ``<fact>_columns`` has the fact's own columns. The facts of a daily run are made again for the months whose silver
rows have changed since the facts were last made, and for no others.

Quality figures are observed by the jobs that write, so they cost no further read of the bronze tables.

Daily runs upsert into the open months. A month close replaces the month everywhere, and writes the month to the
ledger as its last step, so a close that fails half-way can simply be run again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercraft.context import RunContext
from tiercraft.operators import quality
from tiercraft.operators.enrich import load_lookup
from tiercraft.operators.filters import in_months
from tiercraft.operators.matching import Split
from tiercraft.plans import audit, core, dimensions, facts, notices, priority, reference, usage
from tiercraft.plans.layouts import ACTIVE_KEY, ONBOARD_KEY
from tiercraft.session import stage, staging
from tiercraft.sources.catalogue import Catalogue, Table
from tiercraft.sources.store import Warehouse

# Table names, and the products the ledger closes months for.
HEADCOUNT = "silver.hc_silver_historical"
IDENTITY = "silver.okta_user_for_ai"
USAGE = "silver.cursor_usage"
USAGE_REJECTS = "silver.cursor_usage_okta_reject"
AUDIT = "silver.purview_copilot_usage"
AUDIT_REJECTS = "silver.purview_copilot_usage_okta_reject"
PRIORITY = "silver.codex_usage"
PRIORITY_LOG = "silver.codex_usage_matching_log"
ALERTS = "silver.dynamic_alerts"
SECURITY = "silver.security"
USAGE_ACTIVE = "gold.fact_cursor_active"
USAGE_ONBOARD = "gold.fact_cursor_onboard"
AUDIT_ACTIVE = "gold.fact_copilot_active"
AUDIT_ONBOARD = "gold.fact_copilot_onboard"
ALERTS_DIM = "gold.dim_dynamic_alerts"
SECURITY_DIM = "gold.dim_security"
METRICS = "gold.run_quality"
METRICS_SCHEMA = "measured_at timestamp not null, table_name string not null, figure string not null, value long"
USAGE_PRODUCT = "cursor"
AUDIT_PRODUCT = "copilot"


def context_for(store: Warehouse, product: str, run: RunContext) -> RunContext:
    """The run with the months its product has closed."""
    return replace(run, frozen=tuple(store.frozen_months(product)))


def run_headcount(store: Warehouse, bronze: DataFrame, countries: DataFrame, run: RunContext) -> None:
    run = context_for(store, USAGE_PRODUCT, run)
    rows = dimensions.headcount_silver(bronze, load_lookup(countries), run)
    if run.close_month is not None:
        store.replace_months(rows, HEADCOUNT, "Month_No", [run.close_month])
    else:
        store.overwrite_preserve_frozen(rows, HEADCOUNT, "Month_No", run.months_to_skip)


def run_identity(
    store: Warehouse, bronze: DataFrame, countries: DataFrame, run: RunContext, without: dimensions.Exclusions
) -> None:
    store.overwrite(dimensions.identity_silver(bronze, load_lookup(countries), run, without), IDENTITY)


def run_usage(
    store: Warehouse, bronze: DataFrame, run: RunContext, files: tuple[str, ...] = (), mode: str = "upsert_open"
) -> None:
    """Stream A silver and its rejects, from one read of the rows."""
    with staging(store.spark):
        _run_usage(store, bronze, context_for(store, USAGE_PRODUCT, run), files, mode)


def _run_usage(store: Warehouse, bronze: DataFrame, run: RunContext, files: tuple[str, ...], mode: str) -> None:
    seen = quality.Figures()
    rows = usage.usage_outcomes(bronze, store.read(IDENTITY), run, files, seen)
    split = usage.usage_split(rows, store.read(IDENTITY), store.read(HEADCOUNT), run)
    store.replace_months(split.rejects, USAGE_REJECTS, usage.MONTH, _months_of_batch(rows, usage.MONTH, run))
    if run.close_month is not None:
        store.replace_months(split.matched, USAGE, usage.MONTH, [run.close_month])
    else:
        store.preserve_frozen(
            split.matched,
            USAGE,
            usage.MONTH,
            run.months_to_skip,
            keys=[ACTIVE_KEY],
            order=["CursorUsageIngestionDate"],
            mode=mode,
        )
    _record(store, USAGE, seen.values())


def run_audit(
    store: Warehouse, bronze: DataFrame, run: RunContext, files: tuple[str, ...] = (), mode: str = "upsert_open"
) -> None:
    """Stream B silver and its rejects, from one parse of the payloads."""
    with staging(store.spark):
        _run_audit(store, bronze, context_for(store, AUDIT_PRODUCT, run), files, mode)


def _run_audit(store: Warehouse, bronze: DataFrame, run: RunContext, files: tuple[str, ...], mode: str) -> None:
    predicate = audit.audit_scan_predicate(run, bronze)
    scoped = bronze if predicate is None else bronze.filter(predicate)
    seen = quality.Figures()
    rows = audit.audit_outcomes(scoped, store.read(IDENTITY), run, files, seen)
    split = audit.audit_split(rows, store.read(IDENTITY), store.read(HEADCOUNT), run)
    store.replace_months(split.rejects, AUDIT_REJECTS, audit.MONTH, _months_of_batch(rows, audit.MONTH, run))
    key, order = [audit.RECORD_ID], [audit.AUDIT_PREFIX + "ingestion_date"]
    if run.close_month is not None:
        left_out = store.replace_months(split.matched, AUDIT, audit.MONTH, [run.close_month], keys=key, frozen=run.months_to_skip)
    else:
        left_out = store.preserve_frozen(
            split.matched, AUDIT, audit.MONTH, run.months_to_skip, keys=key, order=order, mode=mode, fixed_month=False
        )
    _record(store, AUDIT, {**seen.values(), "left_in_closed_months": left_out})


def run_priority(store: Warehouse, bronze: DataFrame, run: RunContext) -> None:
    """Stream C silver and its match log, from one match of the records."""
    with staging(store.spark):
        joined = stage(priority.priority_joined(bronze, store.read(IDENTITY)), "priority-joined")
        split = priority.priority_split(joined, run)
        store.overwrite(split.matched, PRIORITY)
        store.overwrite(split.rejects, PRIORITY_LOG)


def run_usage_gold(store: Warehouse, run: RunContext, replace_onboard: bool = False, freeze: bool = True, whole: bool = False) -> None:
    """Stream A facts; ``whole`` makes all open months again, as new factors need it."""
    run = context_for(store, USAGE_PRODUCT, run)
    for table, fact in ((USAGE_ACTIVE, facts.usage_active_fact), (USAGE_ONBOARD, _onboard("usage"))):
        _refresh(store, USAGE, usage.MONTH, table, fact, run, replace_onboard, whole)
    if freeze and run.close_month is not None:
        store.freeze_append(USAGE_PRODUCT, run.close_month, at=run.load_ts)


def run_audit_gold(store: Warehouse, run: RunContext, replace_onboard: bool = False, freeze: bool = True, whole: bool = False) -> None:
    """Stream B facts; ``whole`` makes all open months again, as new factors need it."""
    run = context_for(store, AUDIT_PRODUCT, run)
    for table, fact in ((AUDIT_ACTIVE, facts.audit_active_fact), (AUDIT_ONBOARD, _onboard("audit"))):
        _refresh(store, AUDIT, audit.MONTH, table, fact, run, replace_onboard, whole)
    if freeze and run.close_month is not None:
        store.freeze_append(AUDIT_PRODUCT, run.close_month, at=run.load_ts)


def _onboard(stream: str):
    return lambda silver, run: facts.onboard_fact(silver, stream, run)


#: Note on a fact: the version of its silver table up to which all changed months are in it.
BUILT_FROM = "built_from"


def _refresh(store: Warehouse, silver: str, month_col: str, table: str, fact, run: RunContext, replace_onboard: bool, whole: bool) -> None:
    """A close makes its month's fact; a daily run the months that changed since the fact was last made."""
    version = store.version(silver)
    rows, notes = store.read(silver), None
    if run.close_month is None:
        changed = None if whole else store.changed_months(silver, store.notes(table).get(BUILT_FROM))
        if changed is not None:
            changed -= set(run.months_to_skip)
            if not changed:
                return
            rows = rows.filter(in_months(month_col, changed))
        notes = {BUILT_FROM: version}
    made = fact(rows, run)
    if "Month_No" in made.columns:
        _write_active(store, made, table, run, notes)
    else:
        _write_onboard(store, made, table, run, replace_onboard, notes)


def run_alerts(store: Warehouse, bronze: DataFrame) -> None:
    seen = quality.Figures()
    store.overwrite(seen.rows_out(notices.alerts_silver(seen.rows_in(bronze))), ALERTS)
    unique = quality.unique_id(store.read(ALERTS), "dynamic_alerts_notification_id").first().asDict()
    _record(store, ALERTS, seen.values() | unique)
    store.overwrite(notices.alerts_gold(store.read(ALERTS)), ALERTS_DIM)


def run_security(store: Warehouse, bronze: DataFrame) -> None:
    seen = quality.Figures()
    text_null = F.count_if(F.upper("security_email") == "NULL").alias("text_null")
    silver = seen.rows_out(notices.security_silver(seen.rows_in(bronze)), F.count(F.lit(1)).alias("row_count"), text_null)
    store.overwrite(silver, SECURITY)
    _record(store, SECURITY, seen.values())
    store.overwrite(notices.security_gold(store.read(SECURITY)), SECURITY_DIM)


def _record(store: Warehouse, table: str, figures: Mapping[str, int]) -> None:
    """Quality figures of a run: a row a figure in the metrics table."""
    now = datetime.now(UTC)
    rows = [(now, table, name, int(value)) for name, value in figures.items()]
    store.append(store.spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1), METRICS)


def run_reference(store: Warehouse, bronze: Mapping[str, DataFrame]) -> None:
    """Every reference table there is bronze data for."""
    for name, (silver, plan) in reference.REFERENCE_TABLES.items():
        if name in bronze:
            store.overwrite(plan(bronze[name]), f"silver.{silver}")


def run_core(store: Warehouse, bronze: Mapping[str, DataFrame], without: dimensions.Exclusions) -> None:
    """Core entities, after the reference tables, and the project dimension after both."""
    core_names = store.read("silver.normalization_countries_core")
    identity_names = store.read("silver.normalization_countries_okta")
    plans = {
        "core_asset": core.core_asset,
        "core_country": lambda rows: core.core_country(rows, core_names),
        "core_billing": core.core_billing,
        "core_project": core.core_project,
        "core_okta_user": lambda rows: core.core_identity(rows, identity_names, without),
        "core_use_case_implementation": core.use_case_implementation,
        "core_use_case_adjustment": core.use_case_adjustment,
    }
    for name, plan in plans.items():
        if name in bronze:
            store.overwrite(plan(bronze[name]), f"silver.{name}")
    parts = [f"silver.core_{name}" for name in ("project", "billing", "country")]
    if all(store.exists(part) for part in parts):
        store.overwrite(core.dim_project(*[store.read(part) for part in parts]), "silver.dim_project")


class Inputs(NamedTuple):
    """The bronze tables of a run; a part whose table is None is left out."""

    countries: DataFrame
    headcount: DataFrame | None = None
    identity: DataFrame | None = None
    usage: DataFrame | None = None
    audit: DataFrame | None = None
    priority: DataFrame | None = None
    alerts: DataFrame | None = None
    security: DataFrame | None = None
    reference: Mapping[str, DataFrame] = {}
    core: Mapping[str, DataFrame] = {}


# The bronze tables of the streams and dimensions by what runs call them; a deployment says where its own ones are.
STREAM_TABLES = ("countries", "headcount", "identity", "usage", "audit", "priority", "alerts", "security")
CORE_TABLES = (
    "core_asset",
    "core_country",
    "core_billing",
    "core_project",
    "core_okta_user",
    "core_use_case_implementation",
    "core_use_case_adjustment",
)
SILVER_KEYS = {
    USAGE: ((ACTIVE_KEY,), usage.MONTH),
    USAGE_REJECTS: ((), usage.MONTH),
    AUDIT: ((audit.RECORD_ID,), audit.MONTH),
    AUDIT_REJECTS: ((), audit.MONTH),
    HEADCOUNT: ((), "Month_No"),
    USAGE_ACTIVE: ((ACTIVE_KEY,), "Month_No"),
    USAGE_ONBOARD: ((ONBOARD_KEY,), "Month_No"),
    AUDIT_ACTIVE: ((ACTIVE_KEY,), "Month_No"),
    AUDIT_ONBOARD: ((ONBOARD_KEY,), "Month_No"),
    ALERTS: (("dynamic_alerts_notification_id",), None),
    **dict.fromkeys((IDENTITY, PRIORITY, PRIORITY_LOG, SECURITY, ALERTS_DIM, SECURITY_DIM, METRICS), ((), None)),
}


def catalogue(store: Warehouse, bronze: str, places: Mapping[str, str] | None = None) -> Catalogue:
    """Every table of the data model: bronze ones in the catalog schema ``bronze``, or where ``places`` says."""
    names = (*STREAM_TABLES, *reference.REFERENCE_TABLES, *CORE_TABLES)
    tables = [Table(name, "bronze", f"{bronze}.{name}") for name in names]
    for name, (key, month_col) in SILVER_KEYS.items():
        tier, _, short = name.partition(".")
        tables.append(Table(short, tier, store.name(name), key, month_col))
    return Catalogue(store.spark, tables, places)


def inputs_of(tables: Catalogue) -> Inputs:
    """The bronze tables there are; the country lookup has to be there."""
    found = {name: tables.find(f"bronze.{name}") for name in tables.names("bronze")}
    if found["countries"] is None:
        raise LookupError("the catalogue has no country lookup (bronze.countries)")
    there = lambda names: {n: found[n] for n in names if found[n] is not None}
    return Inputs(**{n: found[n] for n in STREAM_TABLES}, reference=there(reference.REFERENCE_TABLES), core=there(CORE_TABLES))


def run_daily(store: Warehouse, inputs: Inputs | Catalogue, run: RunContext, without: dimensions.Exclusions) -> None:
    """Dimensions, streams and facts of one day, in the order in which they read each other."""
    if run.close_month is not None:
        raise ValueError("a daily run closes no month; use run_close")
    _run_all(store, inputs_of(inputs) if isinstance(inputs, Catalogue) else inputs, run, without)


def run_close(store: Warehouse, inputs: Inputs | Catalogue, run: RunContext, without: dimensions.Exclusions) -> None:
    """Everything for the closing month, then the ledger entries: a close that fails before them can be repeated."""
    if run.close_month is None:
        raise ValueError("which month is closed? set close_month")
    inputs = inputs_of(inputs) if isinstance(inputs, Catalogue) else inputs
    _run_all(store, inputs, run, without)
    for product, rows in ((USAGE_PRODUCT, inputs.usage), (AUDIT_PRODUCT, inputs.audit)):
        if rows is not None:
            store.freeze_append(product, run.close_month, at=run.load_ts)


def _run_all(store: Warehouse, inputs: Inputs, run: RunContext, without: dimensions.Exclusions) -> None:
    if inputs.reference:
        run_reference(store, inputs.reference)
    if inputs.core:
        run_core(store, inputs.core, without)
    if inputs.alerts is not None:
        run_alerts(store, inputs.alerts)
    if inputs.security is not None:
        run_security(store, inputs.security)
    if inputs.headcount is not None:
        run_headcount(store, inputs.headcount, inputs.countries, run)
    if inputs.identity is not None:
        run_identity(store, inputs.identity, inputs.countries, run, without)
    if inputs.usage is not None:
        run_usage(store, inputs.usage, run)
    if inputs.audit is not None:
        run_audit(store, inputs.audit, run)
    if inputs.priority is not None:
        run_priority(store, inputs.priority, run)
    if inputs.usage is not None:
        run_usage_gold(store, run, freeze=False)
    if inputs.audit is not None:
        run_audit_gold(store, run, freeze=False)


def _months_of_batch(rows: Split, month_col: str, run: RunContext) -> list[int | None]:
    """Months whose rejects are replaced: those of the whole batch, matched or not.

    A month whose rows all match loses its old rejects. Rows without a month are replaced only by a run that takes
    such rows in: neither a close nor a run that skips closed months does.
    """
    found = {row[0] for one in rows for row in one.select(month_col).distinct().collect()}
    takes_rows_without = run.close_month is None and not run.months_to_skip
    return [*(found - {None}), *([None] if found and takes_rows_without else [])]


def _write_active(store: Warehouse, fact: DataFrame, table: str, run: RunContext, notes: dict | None) -> None:
    if run.close_month is not None:
        store.replace_months(fact, table, "Month_No", [run.close_month], notes=notes)
    else:
        store.upsert(fact, table, [ACTIVE_KEY], ["LastModification"], "Month_No", notes=notes)
    store.view(f"{table}_columns", table, fact.columns)


def _write_onboard(store: Warehouse, fact: DataFrame, table: str, run: RunContext, replace_month: bool, notes: dict | None) -> None:
    """An upsert also on close; ``replace_month`` drops the month's stale keys instead."""
    rows = facts.with_month(fact)
    if run.close_month is not None and replace_month:
        store.replace_months(rows, table, "Month_No", [run.close_month], notes=notes)
    else:
        store.upsert(rows, table, [ONBOARD_KEY], ["LastModification"], "Month_No", notes=notes)
    store.view(f"{table}_columns", table, fact.columns)
