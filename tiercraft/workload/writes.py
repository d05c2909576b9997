"""Queries of table maintenance: each writes a fresh warehouse in the shared folder and reads the table back."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercraft.context import RunContext
from tiercraft.operators.periods import distinct_months
from tiercraft.plans import audit, facts, runs, usage
from tiercraft.plans.layouts import ACTIVE_KEY
from tiercraft.session import shared_folder, stage
from tiercraft.sources.store import LEDGER, LEDGER_SCHEMA, Warehouse, upsert_source
from tiercraft.workload.adapters import Bronze
from tiercraft.workload.expected import PERSON
from tiercraft.workload.registry import RUN, headcount, identity, query
from tiercraft.workload.tables import usage as usage_split

KEY, MONTH = "o_orderkey", "month_no"
CLOSED = (199501, 199502, 199503)
REDONE = (199612, 199701)
LOAD_TIME = datetime(2024, 6, 1)


def fresh_warehouse(b: Bronze) -> Warehouse:
    tag = uuid.uuid4().hex[:12]
    return Warehouse(b.spark, f"silver_{tag}", f"gold_{tag}", f"{shared_folder(b.spark)}/warehouse")


def _orders(b: Bronze) -> DataFrame:
    return b.rows("monthly").select(KEY, "o_orderstatus", "o_totalprice", MONTH)


def _batch(b: Bronze) -> DataFrame:
    """Finished orders come again with status X and a note, the urgent ones under a new key."""
    moved = F.when(F.col("o_orderpriority") == "1-URGENT", -F.col(KEY) - 1).otherwise(F.col(KEY))
    rows = b.rows("monthly").filter(F.col("o_orderstatus") == "F")
    return rows.select(
        moved.alias(KEY), F.lit("X").alias("o_orderstatus"), "o_totalprice", F.lit("again").alias("note"), MONTH
    )


_BATCH = """SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey,
    'X' AS o_orderstatus, o_totalprice, 'again' AS note, month_no FROM b_monthly WHERE o_orderstatus = 'F'"""
_ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice, month_no FROM b_monthly"
_ORDERS_NOTED = "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS note, month_no FROM b_monthly"
_CLOSED = ", ".join(map(str, CLOSED))
_REDONE = ", ".join(map(str, REDONE))


@query("write_overwrite", _ORDERS)
def write_overwrite(b: Bronze) -> DataFrame:
    store = fresh_warehouse(b)
    store.overwrite(b.given("customer"), "silver.orders")
    store.overwrite(_orders(b), "silver.orders", MONTH)
    return store.read("silver.orders")


@query("write_append", f"{_ORDERS_NOTED} UNION ALL {_BATCH}")
def write_append(b: Bronze) -> DataFrame:
    store = fresh_warehouse(b)
    store.append(_orders(b), "silver.orders", MONTH)
    store.append(_batch(b), "silver.orders", MONTH)
    return store.read("silver.orders")


@query(
    "upsert",
    f"""SELECT * FROM ({_ORDERS_NOTED}) t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_BATCH}) s)
    UNION ALL {_BATCH}""",
)
def upsert(b: Bronze) -> DataFrame:
    store = fresh_warehouse(b)
    store.overwrite(_orders(b), "silver.orders", MONTH)
    store.upsert(_batch(b), "silver.orders", [KEY], ["o_totalprice"], MONTH)
    return store.read("silver.orders")


@query(
    "upsert_source_dedupe",
    """SELECT o_custkey, month_no, o_orderkey, o_totalprice FROM b_monthly
    QUALIFY row_number() OVER (PARTITION BY o_custkey, month_no ORDER BY o_totalprice DESC, o_orderkey) = 1""",
)
def upsert_source_dedupe(b: Bronze) -> DataFrame:
    rows = b.rows("monthly").select("o_custkey", MONTH, KEY, "o_totalprice")
    return upsert_source(rows, ["o_custkey", MONTH], ["o_totalprice"])


_REPLACED = f"""SELECT * FROM ({_ORDERS_NOTED}) t WHERE month_no NOT IN ({_REDONE})
    UNION ALL SELECT * FROM ({_BATCH}) s WHERE month_no IN ({_REDONE})"""


@query("replace_months", _REPLACED)
def replace_months(b: Bronze) -> DataFrame:
    store = fresh_warehouse(b)
    store.overwrite(_orders(b), "silver.orders", MONTH)
    store.replace_months(_batch(b).filter(F.col(MONTH).isin(*REDONE)), "silver.orders", MONTH, REDONE)
    return store.read("silver.orders")


@query("replace_one_month", f"SELECT * FROM ({_ORDERS}) t WHERE month_no <> {REDONE[0]}")
def replace_one_month(b: Bronze) -> DataFrame:
    """The batch for the month is empty, so the month ends up empty."""
    store = fresh_warehouse(b)
    store.overwrite(_orders(b), "silver.orders", MONTH)
    nothing = _orders(b).filter((F.col(MONTH) == REDONE[0]) & (F.col("o_orderstatus") == "none"))
    store.replace_months(nothing, "silver.orders", MONTH, REDONE[:1])
    return store.read("silver.orders")


@query(
    "write_preserve_frozen",
    f"""SELECT * FROM ({_ORDERS_NOTED}) t WHERE month_no IN ({_CLOSED})
      OR o_orderkey NOT IN (SELECT o_orderkey FROM ({_BATCH}) s WHERE month_no NOT IN ({_CLOSED}))
    UNION ALL SELECT * FROM ({_BATCH}) s WHERE month_no NOT IN ({_CLOSED})""",
)
def write_preserve_frozen(b: Bronze) -> DataFrame:
    store = fresh_warehouse(b)
    store.overwrite(_orders(b), "silver.orders", MONTH)
    store.preserve_frozen(_batch(b), "silver.orders", MONTH, CLOSED, [KEY], ["o_totalprice"])
    return store.read("silver.orders")


_REBUILT = f"""SELECT * FROM ({_ORDERS_NOTED}) t WHERE month_no IN ({_CLOSED})
    UNION ALL SELECT * FROM ({_BATCH}) s WHERE month_no NOT IN ({_CLOSED})"""


@query("write_rebuild_open", _REBUILT)
def write_rebuild_open(b: Bronze) -> DataFrame:
    store = fresh_warehouse(b)
    store.overwrite(_orders(b), "silver.orders", MONTH)
    store.preserve_frozen(_batch(b), "silver.orders", MONTH, CLOSED, mode="rebuild_open")
    return store.read("silver.orders")


@query("overwrite_preserve_frozen", _REBUILT)
def overwrite_preserve_frozen(b: Bronze) -> DataFrame:
    store = fresh_warehouse(b)
    store.overwrite_preserve_frozen(_orders(b), "silver.orders", MONTH, [])
    store.overwrite_preserve_frozen(_batch(b), "silver.orders", MONTH, CLOSED)
    return store.read("silver.orders")


@query("write_rejects", "SELECT *, 'okta_join_miss' AS \"OktaRejectReason\" FROM u_rejects")
def write_rejects(b: Bronze) -> DataFrame:
    """Written twice: the second batch replaces the first one's months."""
    store = fresh_warehouse(b)
    base = usage.usage_base(b.table("usage"), RUN)
    months = [*distinct_months(base, usage.MONTH), None]
    rejects = usage_split(b).rejects.drop("OktaRejectLoadedAt")
    for _ in range(2):
        store.replace_months(rejects, runs.USAGE_REJECTS, usage.MONTH, months)
    return store.read(runs.USAGE_REJECTS)


@query(
    "freeze_append",
    """SELECT product, month_no AS "Month_No", product || '_pipeline' AS frozen_by, 'Month-close auto-freeze' AS notes
    FROM (SELECT 'cursor' AS product, max(month_no) AS month_no FROM b_monthly
          UNION ALL SELECT 'cursor' AS product, min(month_no) AS month_no FROM b_monthly) m""",
)
def freeze_append(b: Bronze) -> DataFrame:
    """The first and last order month are closed; closing them again adds nothing."""
    store = fresh_warehouse(b)
    months = distinct_months(b.rows("monthly"), MONTH)
    for month in (months[0], months[-1], months[0]):
        store.freeze_append("Cursor ", month, at=LOAD_TIME)
    return store.read(f"gold.{LEDGER}").drop("frozen_at")


@query("ddl_freeze", """SELECT 'all' AS product, month_no AS "Month_No", count(*)::VARCHAR || ' orders' AS notes
    FROM b_monthly GROUP BY month_no""")
def ddl_freeze(b: Bronze) -> DataFrame:
    """The ledger's table, filled with one row per order month."""
    store = fresh_warehouse(b)
    store.create(f"gold.{LEDGER}", LEDGER_SCHEMA)
    counts = b.rows("monthly").groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.select(
        F.lit("all").alias("product"),
        F.col(MONTH).alias("Month_No"),
        F.lit(LOAD_TIME).cast("timestamp").alias("frozen_at"),
        F.lit(None).cast("string").alias("frozen_by"),
        F.concat(F.col("n").cast("string"), F.lit(" orders")).alias("notes"),
    )
    store.append(rows, f"gold.{LEDGER}")
    return store.read(f"gold.{LEDGER}").select("product", "Month_No", "notes")


@query(
    "ddl_reject",
    f"SELECT * EXCLUDE ({', '.join(PERSON)}), 'okta_join_miss' AS okta_reject_reason FROM a_people "
    'WHERE "OktaUserId" IS NULL',
)
def ddl_reject(b: Bronze) -> DataFrame:
    """The reject table from its column list, filled by an audit batch."""
    store = fresh_warehouse(b)
    store.create(runs.AUDIT_REJECTS, audit.reject_ddl(), audit.MONTH)
    rows = audit.audit_outcomes(b.table("audit"), identity(b), RUN)
    split = audit.audit_split(rows, identity(b), headcount(b), replace(RUN, load_ts=LOAD_TIME))
    store.replace_months(split.rejects, runs.AUDIT_REJECTS, audit.MONTH, distinct_months(rows.rejects, audit.MONTH))
    return store.read(runs.AUDIT_REJECTS).drop("okta_reject_loaded_at")


@query("stage", "SELECT l_returnflag, count(*) AS row_count FROM lineitem GROUP BY l_returnflag")
def stage_query(b: Bronze) -> DataFrame:
    staged = stage(b.given("lineitem"), "lineitem")
    return staged.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("row_count"))


def _run_context(b: Bronze) -> tuple[Warehouse, RunContext]:
    """A warehouse with both dimensions loaded; the identities are older than every month a query closes."""
    store = fresh_warehouse(b)
    store.overwrite(identity(b).withColumn("OktaUserUpdatedAt", F.lit(datetime(2023, 12, 1))), runs.IDENTITY)
    store.overwrite(headcount(b), runs.HEADCOUNT, "Month_No")
    return store, replace(RUN, load_ts=LOAD_TIME)


@query(
    "daily_flow",
    """SELECT "userId", "LastModification", "Request", "Month_No" FROM g_usage_active""",
)
def daily_flow(b: Bronze) -> DataFrame:
    """Stream A from bronze to the stored fact, run twice: the second run changes nothing."""
    store, run = _run_context(b)
    for _ in range(2):
        runs.run_usage(store, b.table("usage"), run)
        runs.run_usage_gold(store, run)
    return store.read(runs.USAGE_ACTIVE).select("userId", "LastModification", "Request", "Month_No")


@query(
    "month_close_flow",
    """SELECT "userId", "LastModification", "useCaseCode", "Request", "Month_No", "Month_No" = 202401 AS is_closed
    FROM g_audit_active""",
)
def month_close_flow(b: Bronze) -> DataFrame:
    """Stream B: January closed. A later daily run brings the other months and only part of January again."""
    store, daily = _run_context(b)
    bronze = b.table("audit")
    less = bronze.filter(F.col("CreationDate") >= "2024-01-15")
    for batch, run in ((bronze, replace(daily, close_month=202401)), (less, daily)):
        runs.run_audit(store, batch, run)
        runs.run_audit_gold(store, run)
    closed = store.frozen_months(runs.AUDIT_PRODUCT)
    fact = store.read(runs.AUDIT_ACTIVE).withColumn("is_closed", F.col("Month_No").isin(closed))
    return fact.select("userId", "LastModification", "useCaseCode", "Request", "Month_No", "is_closed")


@query("fact_upsert", 'SELECT "RecordSurrogateKey", "userId", "Request" FROM g_usage_active')
def fact_upsert(b: Bronze) -> DataFrame:
    """The fact written in two overlapping batches equals the fact written at once."""
    store = fresh_warehouse(b)
    fact = stage(facts.usage_active_fact(usage_split(b).matched, RUN), "fact")
    first = fact.filter(F.col("LastModification") < "2024-01-20")
    second = fact.filter(F.col("LastModification") >= "2024-01-10")
    for batch in (first.withColumn("Request", F.lit(0)), second, first):
        store.upsert(batch, runs.USAGE_ACTIVE, [ACTIVE_KEY], ["LastModification"], "Month_No")
    return store.read(runs.USAGE_ACTIVE).select("RecordSurrogateKey", "userId", "Request")
