"""Queries of single operators: scans, columns, filters, scalar and JSON functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercraft.context import RunContext, frozen_to_skip
from tiercraft.functions import audit_json as payloads
from tiercraft.functions import dates, email, interactions
from tiercraft.functions.columns import (
    Headers,
    decimals_to_double,
    nonempty,
    project,
    quoted,
    to_bool,
    to_decimal,
    to_ts,
    trim_lower,
    trimmed,
)
from tiercraft.functions.keys import joined_key, surrogate_key
from tiercraft.operators import filters, periods
from tiercraft.operators.dedupe import keep_one
from tiercraft.operators.enrich import load_lookup, present_or
from tiercraft.operators.matching import identity_slim
from tiercraft.plans import layouts
from tiercraft.plans.audit import audit_base, audit_fields
from tiercraft.plans.usage import stamped, usage_base
from tiercraft.sources import scan as scans
from tiercraft.workload.adapters import Bronze
from tiercraft.workload.expected import FACTOR_ROWS, HOURS_SAVED, HOURS_TOTAL, A, key_
from tiercraft.workload.registry import INTERACTIONS, RUN, headcount, identity, query

FIRST_DAY = "1997-01-01"
LAST_DAY = "1998-01-01"


# --- scans ------------------------------------------------------------------------------------------------
@query("scan_table", "SELECT * FROM customer")
def scan_table(b: Bronze) -> DataFrame:
    return scans.read_table(b.spark, "customer", {"customer": f"{b.folder}/customer.parquet"})


@query("scan_path", "SELECT * FROM supplier")
def scan_path(b: Bronze) -> DataFrame:
    return scans.read_path(b.spark, f"{b.folder}/supplier.parquet")


@query(
    "scan_pushdown",
    f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '{FIRST_DAY}' AND o_orderdate < TIMESTAMP '{LAST_DAY}'""",
)
def scan_pushdown(b: Bronze) -> DataFrame:
    day = F.col("o_orderdate")
    first, last = (F.lit(text).cast("timestamp_ntz") for text in (FIRST_DAY, LAST_DAY))
    return scans.scan(b.given("orders"), ["o_orderkey", "o_custkey", "o_totalprice"], (day >= first) & (day < last))


@query(
    "scan_predicate_build",
    """SELECT event_id, date_text, file_name FROM b_usage
    WHERE date_text >= '2024-01-01' AND date_text < '2024-02-01' AND file_name IN ('usage-1.csv', 'usage-2.csv')""",
)
def scan_predicate_build(b: Bronze) -> DataFrame:
    wanted = filters.scan_predicate(
        "date_text",
        file_column="file_name",
        month="2024-01",
        min_date="2024-01-15",
        files=["usage-1.csv", "usage-2.csv"],
    )
    return scans.scan(b.rows("usage"), ["event_id", "date_text", "file_name"], wanted)


@query(
    "month_end_exclusive",
    """SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month_text,
      CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS month_end FROM orders""",
)
def month_end_exclusive(b: Bronze) -> DataFrame:
    months = b.given("orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month_text")).distinct()
    return months.withColumn("month_end", dates.month_after(F.col("month_text")))


@query("scan_with_schema", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_with_schema(b: Bronze) -> DataFrame:
    schema = "l_orderkey long, l_linenumber int, l_quantity double"
    return scans.read_path(b.spark, f"{b.folder}/lineitem.parquet", schema=schema)


@query("scan_file_filter", "SELECT event_id, file_name FROM b_usage WHERE file_name IN ('usage-0.csv', 'usage-3.csv')")
def scan_file_filter(b: Bronze) -> DataFrame:
    return filters.from_files(
        b.rows("usage").select("event_id", "file_name"), "file_name", ["usage-0.csv", "usage-3.csv"]
    )


@query("lookup_load", "SELECT country AS lookup_key, display_name AS lookup_value FROM b_countries")
def lookup_load(b: Bronze) -> DataFrame:
    return load_lookup(b.table("countries"))


@query(
    "scan_empty_typed",
    "SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS reject_reason, CAST(NULL AS INTEGER) AS month_no FROM supplier",
)
def scan_empty_typed(b: Bronze) -> DataFrame:
    absent = scans.empty_table(b.spark, "s_suppkey long, s_name string, reject_reason string, month_no int")
    return absent.unionByName(b.given("supplier").select("s_suppkey", "s_name"), allowMissingColumns=True)


@query("scan_json_lines", "SELECT conv_id, turn, role, text FROM conversations")
def scan_json_lines(b: Bronze) -> DataFrame:
    path = scans.snapshot_path(b.spark, f"conversation-lines-{uuid.uuid4().hex}", b.folder)
    b.given("conversations").write.mode("overwrite").json(path)
    return scans.read_json_lines(b.spark, path, "conv_id long, turn long, role string, text string")


@query("snapshot_save", "SELECT count(*) AS row_count, sum(o_custkey)::BIGINT AS key_sum FROM orders")
def snapshot_save(b: Bronze) -> DataFrame:
    path = scans.snapshot_save(b.given("orders"), f"orders-{uuid.uuid4().hex}", b.folder)
    kept = scans.read_path(b.spark, path)
    return kept.agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_custkey").alias("key_sum"))


@query("snapshot_load", f"SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{FIRST_DAY}'")
def snapshot_load(b: Bronze) -> DataFrame:
    late = b.given("orders").filter(F.col("o_orderdate") >= F.lit(FIRST_DAY).cast("timestamp_ntz"))
    predicate = f"{b.folder} o_orderdate >= {FIRST_DAY}"
    name = f"late-orders-{uuid.uuid4().hex}"
    scans.snapshot_save(late, name, predicate)
    return scans.snapshot_load(b.spark, name, predicate, late.schema)


# --- columns ----------------------------------------------------------------------------------------------
def _odd_headers(b: Bronze) -> DataFrame:
    """Parts under headers as people type them; numbers as text with spaces."""
    return b.given("part").select(
        F.col("p_partkey").alias("PART KEY"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("Part Name [Catalogue]"),
        F.concat(F.lit(" "), F.col("p_brand")).alias("Inc. Brand"),
        F.concat(F.lit(" "), F.col("p_retailprice").cast("decimal(18,2)").cast("string")).alias("RetailPrice"),
        F.when(F.col("p_size") > 25, "true").when(F.col("p_size") > 10, "no").otherwise("perhaps").alias("is_large"),
        F.when(F.col("p_size") > 40, "n/a").otherwise("2024-01-31 10:00:00").alias("Loaded_At"),
        F.lit(None).cast("string").alias("unused"),
    )


@query("resolve_column", "SELECT p_partkey AS part_key, ' ' || p_brand AS brand FROM part")
def resolve_column(b: Bronze) -> DataFrame:
    rows = _odd_headers(b)
    headers = Headers(rows.columns)
    return rows.select(
        headers.column("id", "part_key").alias("part_key"), headers.column("inc._brand").alias("brand")
    )


@query("resolve_or_null", "SELECT p_partkey AS part_key, CAST(NULL AS DOUBLE) AS weight FROM part")
def resolve_or_null(b: Bronze) -> DataFrame:
    rows = _odd_headers(b)
    headers = Headers(rows.columns)
    return rows.select(
        headers.column("PartKey").alias("part_key"),
        headers.column_or_null("weight", "Gross Weight", dtype="double").alias("weight"),
    )


def _column_query(name: str, output: str, rule, header: str, check: str) -> None:
    """A query of one cleaning rule applied to one odd header."""

    @query(name, f"SELECT p_partkey AS part_key, {check} AS {output} FROM part")
    def build(b: Bronze) -> DataFrame:
        return project(_odd_headers(b), [("part_key", lambda c: c, "part key"), (output, rule, header)])


_column_query("trim_string", "part_name", trimmed, "part_name [catalogue]", "trim(p_name, ' ')")
_column_query(
    "trim_decimal",
    "price",
    to_decimal,
    "retail_price",
    "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,8))",
)
_column_query(
    "to_ts",
    "loaded_at",
    to_ts,
    "loaded at",
    "CASE WHEN p_size <= 40 THEN TIMESTAMP '2024-01-31 10:00:00' END",
)
_column_query(
    "to_bool",
    "is_large",
    to_bool,
    "IsLarge",
    "CASE WHEN p_size > 25 THEN true WHEN p_size > 10 THEN false END",
)


@query("trim_lower", "SELECT event_id, lower(trim(user_text, ' ')) AS address FROM b_usage")
def trim_lower_query(b: Bronze) -> DataFrame:
    return b.rows("usage").select("event_id", trim_lower(F.col("user_text")).alias("address"))


@query("rename_project", "SELECT * FROM s_project")
def rename_project(b: Bronze) -> DataFrame:
    rows = project(b.table("projects"), layouts.CORE_PROJECT)
    return rows.filter(nonempty(F.col("core_project_id")) & nonempty(F.col("core_project_billing_id")))


@query(
    "alias_variant_pick",
    'SELECT "OktaUserId" AS user_id, "OktaUserRegion" AS region FROM s_identity',
)
def alias_variant_pick(b: Bronze) -> DataFrame:
    rows = identity(b)
    headers = Headers(rows.columns)
    return rows.select(
        headers.column("okta_user_id", "OktaUserId").alias("user_id"),
        headers.column("okta_user_region", "OktaUserRegion").alias("region"),
    )


@query(
    "literal_null_columns",
    "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS project, CAST(NULL AS VARCHAR) AS account FROM orders",
)
def literal_null_columns(b: Bronze) -> DataFrame:
    absent = {name: F.lit(None).cast("string") for name in ("project", "account")}
    return b.given("orders").select("o_orderkey").withColumns(absent)


@query("drop_helper_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def drop_helper_columns(b: Bronze) -> DataFrame:
    rows = b.given("orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("_first_custkey"))
    return rows.drop(*[name for name in rows.columns if name.startswith("_")])


# --- filters ----------------------------------------------------------------------------------------------
@query(
    "valid_email",
    r"""SELECT event_id, user_text FROM b_usage
    WHERE regexp_matches(lower(trim(user_text, ' ')), '^[^@\s]+@[^@\s]+\.[^@\s]+$')""",
)
def valid_email(b: Bronze) -> DataFrame:
    return b.rows("usage").select("event_id", "user_text").filter(email.valid_email(F.col("user_text")))


@query("nonempty_trim", "SELECT id, billing_id FROM b_projects WHERE trim(id, ' ') <> '' AND trim(billing_id, ' ') <> ''")
def nonempty_trim(b: Bronze) -> DataFrame:
    rows = b.rows("projects").select("id", "billing_id")
    return rows.filter(nonempty(F.col("id")) & nonempty(F.col("billing_id")))


@query("filter_month", "SELECT * FROM b_monthly WHERE month_no = 199705")
def filter_month(b: Bronze) -> DataFrame:
    return filters.only_month(b.rows("monthly"), "month_no", 199705)


@query("filter_through_month", "SELECT * FROM b_monthly WHERE order_day < DATE '1998-01-01'")
def filter_through_month(b: Bronze) -> DataFrame:
    return filters.through_month(b.rows("monthly"), "order_day", 199712)


@query("exclude_months", "SELECT * FROM b_monthly WHERE month_no NOT IN (199501, 199502, 199712)")
def exclude_months(b: Bronze) -> DataFrame:
    return filters.without_months(b.rows("monthly"), "month_no", [199501, 199502, 199712])


@query("min_date_filter", "SELECT * FROM b_monthly WHERE order_day >= DATE '1997-07-15'")
def min_date_filter(b: Bronze) -> DataFrame:
    return filters.from_date(b.rows("monthly"), "order_day", "1997-07-15")


@query(
    "exclude_tenant_region",
    """SELECT id, region, okta_tenant FROM b_identity
    WHERE lower(trim(region, ' ')) <> 'excluded-region' AND lower(trim(okta_tenant, ' ')) <> 'excluded-tenant'""",
)
def exclude_tenant_region(b: Bronze) -> DataFrame:
    rows = b.rows("identity").select("id", "region", "okta_tenant")
    return rows.filter(
        filters.outside(F.col("region"), F.col("okta_tenant"), ["Excluded-Region"], ["excluded-tenant"])
    )


@query(
    "required_not_null",
    """SELECT id, region, employee_number FROM b_identity
    WHERE id IS NOT NULL AND region IS NOT NULL AND employee_number IS NOT NULL""",
)
def required_not_null(b: Bronze) -> DataFrame:
    rows = b.rows("identity").select("id", "region", "employee_number")
    return filters.required(rows, "id", "region", "employee_number")


# --- months and runs --------------------------------------------------------------------------------------
@query("distinct_months", "SELECT DISTINCT month_no FROM b_monthly")
def distinct_months(b: Bronze) -> DataFrame:
    return periods.months_of(b.rows("monthly"), "month_no")


@query(
    "batch_max_month",
    "SELECT max(month_no) AS batch_max_month, [199501, 199502]::INTEGER[] AS months_to_skip FROM b_monthly",
)
def batch_max_month(b: Bronze) -> DataFrame:
    return periods.batch_profile(b.rows("monthly"), "month_no", [199501, 199502])


def _ledger(b: Bronze) -> DataFrame:
    """A ledger from the orders: a month with a very large order is closed for the product of that order."""
    product = (
        F.when(F.col("o_orderstatus") == "F", "Cursor").when(F.col("o_orderstatus") == "O", " copilot").otherwise("ALL")
    )
    largest = b.rows("monthly").groupBy(product.alias("product"), F.col("month_no").alias("Month_No")).agg(
        F.max("o_totalprice").alias("largest")
    )
    return largest.filter(F.col("largest") > 499000).drop("largest")


_FROZEN = """SELECT DISTINCT month_no FROM b_monthly
    WHERE o_totalprice > 499000 AND o_orderstatus NOT IN ('O')"""


@query("frozen_months", _FROZEN)
def frozen_months(b: Bronze) -> DataFrame:
    return periods.frozen_rows(_ledger(b), "CURSOR")


@query(
    "frozen_to_skip",
    f"""SELECT month_no, count(*) AS row_count FROM b_monthly
    WHERE month_no NOT IN ({_FROZEN}) OR month_no = 199503 GROUP BY month_no""",
)
def frozen_to_skip_query(b: Bronze) -> DataFrame:
    skip = frozen_to_skip(periods.frozen_months(_ledger(b), "cursor"), 199503)
    rows = filters.without_months(b.rows("monthly"), "month_no", skip)
    return rows.groupBy("month_no").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "min_date_for_run",
    """SELECT 'daily' AS run, count(*) AS row_count FROM b_monthly WHERE order_day >= DATE '2000-03-10'
    UNION ALL SELECT 'close' AS run, count(*) AS row_count FROM b_monthly WHERE order_day >= DATE '1999-12-01'""",
)
def min_date_for_run(b: Bronze) -> DataFrame:
    runs = {"daily": RunContext(min_date="2000-03-10"), "close": RunContext(199912, min_date="2000-03-10")}
    rows = b.rows("monthly")
    return rows.agg(
        *[F.count_if(F.col("order_day") >= F.lit(run.first_day).cast("date")).alias(n) for n, run in runs.items()]
    ).unpivot([], list(runs), "run", "row_count")


# --- scalar functions -------------------------------------------------------------------------------------
@query("month_no", "SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month_no FROM orders")
def month_no(b: Bronze) -> DataFrame:
    return b.given("orders").select("o_orderkey", dates.month_no(F.col("o_orderdate")).alias("month_no"))


@query(
    "month_start",
    """SELECT DISTINCT month_no, make_date(month_no // 100, month_no % 100, 1) AS month_start,
      CAST(NULL AS DATE) AS no_such_month FROM b_monthly""",
)
def month_start(b: Bronze) -> DataFrame:
    months = b.rows("monthly").select("month_no").distinct()
    return months.withColumns(
        {
            "month_start": dates.month_start(F.col("month_no")),
            "no_such_month": dates.month_start(F.col("month_no") + 50),
        }
    )


@query(
    "parse_date_multi",
    r"""SELECT notification, published,
      CASE WHEN regexp_matches(published, '^[0-9]{4}-') THEN CAST(substr(published, 1, 10) AS DATE)
        ELSE coalesce(CAST(try_strptime(published, '%d/%m/%Y') AS DATE),
                      CAST(try_strptime(published, '%m/%d/%Y') AS DATE)) END AS day
    FROM b_alerts""",
)
def parse_date_multi(b: Bronze) -> DataFrame:
    rows = b.rows("alerts").select("notification", "published")
    return rows.withColumn("day", dates.parse_date(F.col("published")))


@query(
    "parse_ts_text",
    """SELECT id, TRY_CAST(updated_at AS TIMESTAMP) AS updated,
      CAST(TRY_CAST(updated_at AS TIMESTAMP) AS DATE) AS day FROM b_projects""",
)
def parse_ts_text(b: Bronze) -> DataFrame:
    rows = b.rows("projects").select("id", dates.parse_timestamp(F.col("updated_at")).alias("updated"))
    return rows.withColumn("day", F.col("updated").cast("date"))


@query(
    "email_strip_prefix10",
    """SELECT event_id, CASE WHEN regexp_matches(address, '^10[^@]*@') THEN substr(address, 3) END AS stripped
    FROM (SELECT event_id, lower(trim(user_text, ' ')) AS address FROM b_usage) e""",
)
def email_strip_prefix10(b: Bronze) -> DataFrame:
    return b.rows("usage").select("event_id", email.strip_prefix10(trim_lower(F.col("user_text"))).alias("stripped"))


@query("email_variants", "SELECT * FROM p_base")
def email_variants(b: Bronze) -> DataFrame:
    rows = b.rows("usage_digits").select(F.col("event_id").alias("codex_usage_record_id"), "user_text")
    variants = email.email_variants(F.col("user_text"))
    return rows.select(
        "codex_usage_record_id", *[value.alias(f"codex_usage_email_{name}") for name, value in variants.items()]
    ).distinct()


@query(
    "email_local_part",
    "SELECT event_id, CASE WHEN user_text LIKE '%@%' THEN split_part(user_text, '@', 1) END AS local_part FROM b_usage",
)
def email_local_part(b: Bronze) -> DataFrame:
    return b.rows("usage").select("event_id", email.local_part(F.col("user_text")).alias("local_part"))


@query(
    "period_email_key",
    'SELECT "CursorUsageUser" AS address, CAST("CursorUsageMonthNo" AS VARCHAR) || \'/\' || "CursorUsageUser" '
    "AS period_key FROM u_base",
)
def period_email_key(b: Bronze) -> DataFrame:
    rows = usage_base(b.table("usage"), RUN)
    address = F.col("CursorUsageUser")
    return rows.select(address.alias("address"), joined_key(F.col("CursorUsageMonthNo"), address).alias("period_key"))


@query(
    "division_country_key",
    "SELECT person_id, division_inc || '/' || country AS division_key FROM b_headcount",
)
def division_country_key(b: Bronze) -> DataFrame:
    return b.rows("headcount").select(
        "person_id", joined_key(F.col("division_inc"), F.col("country")).alias("division_key")
    )


@query(
    "surrogate_key",
    "SELECT event_id, "
    + key_(
        "event_id", "date_text", "agent_id", "CASE WHEN price = 0 THEN '0E-8' ELSE CAST(price AS VARCHAR) END"
    )
    + """ AS row_key FROM (SELECT DISTINCT event_id, date_text, agent_id, CAST(cost AS DECIMAL(18,8)) AS price
    FROM b_usage) e""",
)
def surrogate_key_query(b: Bronze) -> DataFrame:
    rows = b.rows("usage").select("event_id", "date_text", "agent_id", to_decimal(F.col("cost")).alias("price"))
    rows = rows.distinct()
    return rows.select("event_id", surrogate_key(rows, "event_id", "date_text", "agent_id", "price").alias("row_key"))


_KINDS = f"SELECT {A}record_id AS record_id, {A}interaction_type AS kind FROM a_base"


def _kinds(b: Bronze) -> DataFrame:
    return audit_base(b.table("audit"), RUN).select(
        F.col(f"{A}record_id").alias("record_id"), F.col(f"{A}interaction_type").alias("kind")
    )


@query("classify_interaction", _KINDS)
def classify_interaction(b: Bronze) -> DataFrame:
    return _kinds(b)


def _factor_query(name: str, output: str, function, check: str) -> None:
    """A query of one of the values that go with a kind."""

    @query(name, f"SELECT record_id, {check} AS {output} FROM ({_KINDS}) k JOIN {FACTOR_ROWS} USING (kind)")
    def build(b: Bronze) -> DataFrame:
        return _kinds(b).select("record_id", function(F.col("kind")).alias(output))


_factor_query("use_case_code", "code", INTERACTIONS.use_case_code, "'CASE-' || code")
_factor_query("automation_factor", "factor", INTERACTIONS.automation_factor, "CAST(automation AS DECIMAL(18,8))")
_factor_query("hours_saved_factor", "factor", INTERACTIONS.hours_saved_factor, "CAST(hours AS DECIMAL(18,8))")


@query(
    "hours_saved_measures",
    f"""SELECT record_id, {HOURS_SAVED} AS saved, {HOURS_TOTAL} AS total
    FROM (SELECT {A}record_id AS record_id, {A}interaction_type AS kind, {A}message_count AS requests FROM a_base) k
    JOIN {FACTOR_ROWS} USING (kind)""",
)
def hours_saved_measures(b: Bronze) -> DataFrame:
    rows = audit_base(b.table("audit"), RUN)
    kind, requests = F.col(f"{A}interaction_type"), F.col(f"{A}message_count")
    hours = INTERACTIONS.hours_saved_factor(kind)
    one = F.lit("1").cast("decimal(18,8)")
    return rows.select(
        F.col(f"{A}record_id").alias("record_id"),
        interactions.hours_saved(requests, hours, one).alias("saved"),
        interactions.hours_total(requests, hours, INTERACTIONS.automation_factor(kind)).alias("total"),
    )


@query("coalesce_default", "SELECT person_id, coalesce(division_inc, 'Others') AS division FROM b_headcount")
def coalesce_default(b: Bronze) -> DataFrame:
    return b.rows("headcount").select("person_id", present_or(F.col("division_inc"), "Others").alias("division"))


@query("load_stamp", 'SELECT s_suppkey, \'okta_join_miss\' AS "OktaRejectReason", true AS loaded FROM supplier')
def load_stamp(b: Bronze) -> DataFrame:
    rows = stamped(b.given("supplier").select("s_suppkey"), RUN)
    return rows.select("s_suppkey", "OktaRejectReason", F.col("OktaRejectLoadedAt").isNotNull().alias("loaded"))


@query(
    "decimal_to_double",
    'SELECT "CursorUsageUser" AS address, CAST("CursorUsageCost" AS DOUBLE) AS cost FROM u_base',
)
def decimal_to_double(b: Bronze) -> DataFrame:
    rows = usage_base(b.table("usage"), RUN)
    return decimals_to_double(
        rows.select(F.col("CursorUsageUser").alias("address"), F.col("CursorUsageCost").alias("cost"))
    )


# --- JSON -------------------------------------------------------------------------------------------------
_PATHS = [
    A + name
    for name in (
        "app_identity application_name agent_name copilot_log_version app_host target_agent_name license_type "
        "conversation_id thread_id"
    ).split()
]


@query("json_path_extract", f"SELECT {A}record_id, {', '.join(_PATHS)} FROM a_base")
def json_path_extract(b: Bronze) -> DataFrame:
    return audit_base(b.table("audit"), RUN).select(f"{A}record_id", *_PATHS)


def _audit_rows(b: Bronze) -> DataFrame:
    return b.table("audit").select("RecordId", "Operation", F.col("AuditData").alias("text"))


_RAW = """SELECT record_id AS "RecordId", operation AS "Operation", {} FROM (
    SELECT *, c % 29 = 28 AS malformed FROM b_audit) a"""


@query(
    "json_array_index",
    _RAW.format(
        "CASE WHEN NOT malformed AND c % 3 = 0 THEN 'model-' || CAST(t AS VARCHAR) END AS model, "
        "CASE WHEN NOT malformed AND c % 3 = 0 THEN 'provider' END AS provider"
    ),
)
def json_array_index(b: Bronze) -> DataFrame:
    text = F.col("text")
    return _audit_rows(b).select(
        "RecordId",
        "Operation",
        payloads.first_model_field(text, "ModelName").alias("model"),
        payloads.first_model_field(text, "ModelProviderName").alias("provider"),
    )


_MESSAGES = "CASE WHEN NOT malformed THEN n_messages ELSE 0 END"


@query(
    "json_to_array",
    _RAW.format(
        """CASE WHEN malformed OR c % 3 = 2 THEN NULL WHEN c % 3 = 0 THEN 'BingWebSearch,OtherPlugin'
        ELSE 'OtherPlugin' END AS plugin_ids,
        CASE WHEN malformed OR n_resources = 0 THEN NULL ELSE '{"Number":1,"Type":"file"}' END AS first_resource"""
    ),
)
def json_to_array(b: Bronze) -> DataFrame:
    parsed = payloads.payload(F.col("text"))
    return _audit_rows(b).select(
        "RecordId",
        "Operation",
        F.array_join(payloads.plugins(parsed)["Id"], ",").alias("plugin_ids"),
        F.get(payloads.resources(parsed), F.lit(0)).alias("first_resource"),
    )


@query(
    "array_size_or_zero",
    _RAW.format(
        f"CAST({_MESSAGES} AS INTEGER) AS messages, "
        "CAST(CASE WHEN malformed THEN 0 WHEN c % 3 = 0 THEN 2 WHEN c % 3 = 1 THEN 1 ELSE 0 END AS INTEGER) AS plugins, "
        "CAST(CASE WHEN malformed THEN 0 ELSE n_resources END AS INTEGER) AS resources"
    ),
)
def array_size_or_zero(b: Bronze) -> DataFrame:
    parsed = payloads.payload(F.col("text"))
    return _audit_rows(b).select(
        "RecordId",
        "Operation",
        payloads.size_or_zero(payloads.messages(parsed)).alias("messages"),
        payloads.size_or_zero(payloads.plugins(parsed)).alias("plugins"),
        payloads.size_or_zero(payloads.resources(parsed)).alias("resources"),
    )


@query(
    "array_filter_count",
    _RAW.format(
        f"CAST(({_MESSAGES} + CASE WHEN t % 2 = 0 THEN 0 ELSE 1 END) // 2 AS INTEGER) AS prompts"
    ),
)
def array_filter_count(b: Bronze) -> DataFrame:
    items = payloads.messages(payloads.payload(F.col("text")))
    return _audit_rows(b).select("RecordId", "Operation", payloads.prompt_count(items).alias("prompts"))


@query(
    "array_exists",
    _RAW.format(
        "NOT malformed AND c % 17 = 0 AND n_messages >= 2 AS jailbreak, NOT malformed AND c % 3 = 0 AS web_search"
    ),
)
def array_exists(b: Bronze) -> DataFrame:
    parsed = payloads.payload(F.col("text"))
    return _audit_rows(b).select(
        "RecordId",
        "Operation",
        payloads.any_jailbreak(payloads.messages(parsed)).alias("jailbreak"),
        payloads.any_web_search(payloads.plugins(parsed)).alias("web_search"),
    )


@query(
    "derived_flags",
    "SELECT record_id, operation, prompts > 0 AS has_prompt, model IS NOT NULL OR provider IS NOT NULL AS has_model, "
    r"resources > 0 AS has_resource FROM a_values",
)
def derived_flags(b: Bronze) -> DataFrame:
    rows = b.table("audit")
    rows = audit_fields(rows.filter(email.valid_email(F.col("UserId"))), RUN.interactions)
    return rows.select(
        F.col(f"{A}record_id").alias("record_id"),
        F.col(f"{A}operation").alias("operation"),
        F.col(f"{A}has_prompt").alias("has_prompt"),
        F.col(f"{A}has_model_info").alias("has_model"),
        F.col(f"{A}has_resource_access").alias("has_resource"),
    )


@query("json_flatten", "SELECT * FROM a_base")
def json_flatten(b: Bronze) -> DataFrame:
    return audit_base(b.table("audit"), RUN)


# --- identities, display, dedupe --------------------------------------------------------------------------
@query(
    "identity_slim",
    """SELECT okta_user_id, okta_user_email, okta_user_full_email, short_local AS okta_user_email_without_domain,
      full_local AS okta_user_full_email_without_domain, okta_user_employee_number, okta_user_full_name,
      okta_user_region, okta_user_country FROM p_identity""",
)
def identity_slim_query(b: Bronze) -> DataFrame:
    return identity_slim(identity(b))


@query("sample_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def sample_rows(b: Bronze) -> DataFrame:
    # A display sample; ordered, so that it is the same ten rows every time.
    return b.given("orders").orderBy("o_orderkey").limit(10)


@query("order_preview", "SELECT doc_id, source FROM documents ORDER BY doc_id")
def order_preview(b: Bronze) -> DataFrame:
    return b.given("documents").select("doc_id", "source").orderBy("doc_id")


@query("headcount_keys", 'SELECT "HCKeyEmail", "HCKeyDivision", "HCDate" FROM s_headcount')
def headcount_keys(b: Bronze) -> DataFrame:
    return headcount(b).select("HCKeyEmail", "HCKeyDivision", "HCDate")


@query(
    "dedupe_pairs",
    "SELECT DISTINCT event_id, lower(trim(user_text, ' ')) AS address FROM b_usage_digits",
)
def dedupe_pairs(b: Bronze) -> DataFrame:
    return b.rows("usage_digits").select("event_id", trim_lower(quoted("user_text")).alias("address")).distinct()


@query("dedupe_on_id", "SELECT * FROM a_base")
def dedupe_on_id(b: Bronze) -> DataFrame:
    rows = audit_fields(b.table("audit").filter(email.valid_email(F.col("UserId"))), RUN.interactions)
    return keep_one(rows, [F.col(f"{A}record_id")], [F.col(f"{A}ingestion_date").desc_nulls_last()])
