"""Queries of joins, aggregates and whole silver and gold tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercraft.functions.columns import quoted, trimmed
from tiercraft.operators import quality
from tiercraft.operators.attach import attach, settled
from tiercraft.operators.dedupe import dedupe_by_key, latest_per
from tiercraft.operators.enrich import NO_COUNTRY, headcount_attach, lookup_normalize, trimmed_lookup
from tiercraft.operators.matching import (
    PERSON_SNAKE,
    match_either,
    match_fallback,
    match_priority,
    priority_links,
    split_either,
    split_fallback,
)
from tiercraft.plans import core, facts, notices, reference
from tiercraft.plans.audit import EMAIL, FALLBACK, audit_base, audit_silver
from tiercraft.plans.priority import ADDRESS, RECORD_ID, priority_base, priority_silver
from tiercraft.plans.usage import USER, usage_base, usage_silver
from tiercraft.workload.adapters import EXCLUDED, Bronze
from tiercraft.workload.expected import PERSON, A, headcount_columns, headcount_joins, trim_
from tiercraft.workload.registry import RUN, countries, headcount, identity, query

_RULES = "CASE WHEN okta_user_id IS NULL THEN 'okta_join_miss' ELSE 'matched' END"


def usage(b: Bronze):
    return usage_silver(b.table("usage"), identity(b), headcount(b), RUN)


def audit(b: Bronze):
    return audit_silver(b.table("audit"), identity(b), headcount(b), RUN)


def _base(b: Bronze) -> DataFrame:
    return usage_base(b.table("usage"), RUN)


# --- identity matching ------------------------------------------------------------------------------------
@query("identity_match_either", "SELECT * FROM u_match")
def identity_match_either(b: Bronze) -> DataFrame:
    return match_either(_base(b), identity(b), USER)


@query("identity_split_matched", 'SELECT * FROM u_match')
def identity_split_matched(b: Bronze) -> DataFrame:
    return split_either(_base(b), identity(b), USER).matched


@query("identity_split_rejects", "SELECT * FROM u_rejects")
def identity_split_rejects(b: Bronze) -> DataFrame:
    return split_either(_base(b), identity(b), USER).rejects


def _outcomes(split, *names: str) -> DataFrame:
    """Both outcomes of a split in one table."""
    matched = split.matched.select(*names, "OktaUserId", F.lit("matched").alias("outcome"))
    rejects = split.rejects.select(*names, F.lit("rejected").alias("outcome"))
    return matched.unionByName(rejects, allowMissingColumns=True)


@query(
    "identity_split",
    """SELECT "CursorUsageUser", "CursorUsageDate", "CursorUsageKind", "OktaUserId", 'matched' AS outcome FROM u_match
    UNION ALL SELECT "CursorUsageUser", "CursorUsageDate", "CursorUsageKind", NULL, 'rejected' FROM u_rejects""",
)
def identity_split(b: Bronze) -> DataFrame:
    return _outcomes(split_either(_base(b), identity(b), USER), USER, "CursorUsageDate", "CursorUsageKind")


@query(
    "identity_fallback_split",
    f"""SELECT {A}record_id, {A}email, "OktaUserId",
      CASE WHEN "OktaUserId" IS NULL THEN 'rejected' ELSE 'matched' END AS outcome FROM a_people""",
)
def identity_fallback_split(b: Bronze) -> DataFrame:
    split = split_fallback(audit_base(b.table("audit"), RUN), identity(b), EMAIL, FALLBACK)
    return _outcomes(split, f"{A}record_id", EMAIL)


@query(
    "anti_rejects",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
      SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def anti_rejects(b: Bronze) -> DataFrame:
    largest = b.given("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("largest"))
    buyers = largest.filter(F.col("largest") > 400000).select("c_custkey")
    return attach(b.given("customer").select("c_custkey", "c_name"), settled(buyers), ["c_custkey"], "left_anti")


@query("identity_fallback", "SELECT * FROM a_people")
def identity_fallback(b: Bronze) -> DataFrame:
    return match_fallback(audit_base(b.table("audit"), RUN), identity(b), EMAIL, FALLBACK)


@query("identity_fallback_matched", 'SELECT * FROM a_people WHERE "OktaUserId" IS NOT NULL')
def identity_fallback_matched(b: Bronze) -> DataFrame:
    return split_fallback(audit_base(b.table("audit"), RUN), identity(b), EMAIL, FALLBACK).matched


@query(
    "identity_fallback_rejects",
    f"SELECT * EXCLUDE ({', '.join(PERSON)}) FROM a_people WHERE \"OktaUserId\" IS NULL",
)
def identity_fallback_rejects(b: Bronze) -> DataFrame:
    return split_fallback(audit_base(b.table("audit"), RUN), identity(b), EMAIL, FALLBACK).rejects


@query("identity_priority", "SELECT * FROM p_match")
def identity_priority(b: Bronze) -> DataFrame:
    return match_priority(priority_base(b.table("usage_digits")), identity(b), ADDRESS, RECORD_ID)


@query("priority_match_log", "SELECT * EXCLUDE (" + ", ".join(PERSON_SNAKE) + """), 'okta_join_miss' AS
    codex_matching_log_reason FROM p_match WHERE okta_user_id IS NULL""")
def priority_match_log(b: Bronze) -> DataFrame:
    log = priority_silver(b.table("usage_digits"), identity(b), RUN).rejects
    return log.drop("codex_matching_log_loaded_at", *PERSON_SNAKE)


@query("active_flag_predicates", f"SELECT {_RULES} AS outcome, count(*) AS row_count FROM p_match GROUP BY 1")
def active_flag_predicates(b: Bronze) -> DataFrame:
    split = priority_silver(b.table("usage_digits"), identity(b), RUN)
    return quality.reject_rate(split.matched, split.rejects, "codex_matching_log_reason")


@query(
    "best_priority",
    "SELECT DISTINCT b.codex_usage_email_normalized AS address, CAST(w.rule AS INTEGER) AS match_rule "
    "FROM p_best w JOIN p_base b ON w.rec = b.codex_usage_record_id",
)
def best_priority(b: Bronze) -> DataFrame:
    addresses = priority_base(b.table("usage_digits")).select(F.col(ADDRESS).alias("address")).distinct()
    return priority_links(addresses, identity(b), "address").select("address", "match_rule")


@query(
    "tie_lowest_id",
    """SELECT DISTINCT b.codex_usage_email_normalized AS address, CAST(r.rule AS INTEGER) AS match_rule, r.okta_user_id
    FROM (SELECT rec, rule, min(okta_user_id) AS okta_user_id FROM p_rules GROUP BY rec, rule
      QUALIFY rule = min(rule) OVER (PARTITION BY rec)) r JOIN p_base b ON r.rec = b.codex_usage_record_id""",
)
def tie_lowest_id(b: Bronze) -> DataFrame:
    """Of the people that the best rule leads to, the one with the lowest id."""
    addresses = priority_base(b.table("usage_digits")).select(F.col(ADDRESS).alias("address")).distinct()
    return priority_links(addresses, identity(b), "address").select("address", "match_rule", "okta_user_id")


@query(
    "left_attach_winner",
    "SELECT p.codex_usage_record_id, p.okta_user_id, w.rule FROM p_match p LEFT JOIN p_best w "
    "ON p.codex_usage_record_id = w.rec",
)
def left_attach_winner(b: Bronze) -> DataFrame:
    base = priority_base(b.table("usage_digits")).select(RECORD_ID, ADDRESS)
    winners = priority_links(base.select(ADDRESS).distinct(), identity(b), ADDRESS)
    winners = winners.select(ADDRESS, "okta_user_id", F.col("match_rule").alias("rule"))
    return attach(base, settled(winners), [ADDRESS], "left").drop(ADDRESS)


# --- enrichment -------------------------------------------------------------------------------------------
@query(
    "headcount_attach",
    f"""SELECT m.*, {headcount_columns()} FROM u_match m
    {headcount_joins('m."CursorUsageMonthNo"', 'm."OktaUserEmail"', 'm."OktaUserFullEmail"')}""",
)
def headcount_attach_query(b: Bronze) -> DataFrame:
    rows = match_either(_base(b), identity(b), USER)
    return headcount_attach(rows, headcount(b), "CursorUsageMonthNo", "OktaUserEmail", "OktaUserFullEmail")


@query(
    "lookup_normalize",
    f"""SELECT id, {trim_('country')} AS raw_country, coalesce(lookup_value, 'No Country') AS country
    FROM b_identity LEFT JOIN country_names ON {trim_('country')} = lookup_key""",
)
def lookup_normalize_query(b: Bronze) -> DataFrame:
    rows = b.rows("identity").select("id", trimmed(F.col("country")).alias("raw_country"))
    return lookup_normalize(rows, "raw_country", countries(b), "country", NO_COUNTRY)


@query(
    "lookup_normalize_id",
    f"""SELECT c_custkey, country_key, normalization_countries_core_normalized_country AS country
    FROM (SELECT c_custkey, 'C' || CAST(c_nationkey AS VARCHAR) AS country_key FROM customer) c
    LEFT JOIN s_norm_core ON country_key = normalization_countries_core_id""",
)
def lookup_normalize_id(b: Bronze) -> DataFrame:
    rows = b.given("customer").select(
        "c_custkey", F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("country_key")
    )
    names = reference.core_countries(b.table("core_country_names"))
    lookup = trimmed_lookup(names, "normalization_countries_core_id", "normalization_countries_core_normalized_country")
    return lookup_normalize(rows, "country_key", lookup, "country")


_DIM_PROJECT = """SELECT core_project_id AS dim_project_project_id,
    core_project_display_name AS dim_project_project_display_name, core_project_active AS dim_project_active,
    core_project_create_at AS dim_project_created_at, core_project_updated_at AS dim_project_updated_at,
    core_project_deleted_at AS dim_project_deleted_at, core_project_billing_id AS dim_project_billing_id,
    core_project_corporate AS dim_project_corporate, core_project_tenant AS dim_project_tenant,
    core_project_is_public AS dim_project_is_public, core_billing_billing_type AS dim_project_billing_type,
    core_billing_billing_identifier AS dim_project_billing_identifier,
    core_billing_client_name AS dim_project_client_name, core_billing_tenant AS dim_project_billing_tenant,
    core_billing_region AS dim_project_billing_region, country_id AS dim_project_country_id,
    country_display_name AS dim_project_country
    FROM s_project LEFT JOIN s_billing ON core_project_billing_id = core_billing_id
    LEFT JOIN s_core_country ON core_billing_country_id = country_id"""


def _dim_project(b: Bronze) -> DataFrame:
    return core.dim_project(
        core.core_project(b.table("projects")), core.core_billing(b.table("billings")), _core_country(b)
    )


def _core_country(b: Bronze) -> DataFrame:
    return core.core_country(b.table("core_countries"), reference.core_countries(b.table("core_country_names")))


query("star_enrich", _DIM_PROJECT)(_dim_project)
query("dim_project", _DIM_PROJECT)(_dim_project)


# --- aggregates and deduplication -------------------------------------------------------------------------
@query("active_daily", "SELECT * FROM u_daily")
def active_daily(b: Bronze) -> DataFrame:
    return facts.active_daily(usage(b).matched)


@query("active_by_type", "SELECT * FROM a_daily")
def active_by_type(b: Bronze) -> DataFrame:
    return facts.active_by_type(audit(b).matched)


@query("having_min_requests", 'SELECT * FROM a_daily WHERE "Request" >= 2')
def having_min_requests(b: Bronze) -> DataFrame:
    return facts.active_by_type(audit(b).matched, at_least=2)


@query("distinct_rows", "SELECT DISTINCT * FROM u_base")
def distinct_rows(b: Bronze) -> DataFrame:
    return _base(b).distinct()


@query("row_counts", "SELECT count(*) AS row_count FROM lineitem")
def row_counts(b: Bronze) -> DataFrame:
    return b.given("lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@query("distinct_id_count", "SELECT count(*) AS row_count, count(DISTINCT l_orderkey) AS distinct_ids FROM lineitem")
def distinct_id_count(b: Bronze) -> DataFrame:
    return quality.unique_id(b.given("lineitem"), "l_orderkey")


@query(
    "empty_check",
    """SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) = 0 AS is_empty
    UNION ALL SELECT 'open alerts' AS table_name, (SELECT count(*) FROM events WHERE event_type = 'none') = 0 AS is_empty""",
)
def empty_check(b: Bronze) -> DataFrame:
    checks = {"orders": b.given("orders"), "open alerts": b.given("events").filter(F.col("event_type") == "none")}
    rows = [(name, df.isEmpty()) for name, df in checks.items()]
    return b.spark.createDataFrame(rows, "table_name string, is_empty boolean")


@query(
    "dedupe_by_key",
    """SELECT l_orderkey, l_returnflag, l_linenumber, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_quantity DESC, l_linenumber) = 1""",
)
def dedupe_by_key_query(b: Bronze) -> DataFrame:
    rows = b.given("lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_quantity")
    return dedupe_by_key(rows, F.col("l_orderkey"), F.col("l_returnflag"), order=[F.col("l_quantity").desc()])


@query("latest_per_user_day", "SELECT * FROM u_latest")
def latest_per_user_day(b: Bronze) -> DataFrame:
    return latest_per(
        usage(b).matched, ["CursorUsageDate", "OktaUserId"], "CursorUsageIngestionDate", "RecordSurrogateKey"
    )


@query("latest_per_user_day_tb", "SELECT * FROM a_latest")
def latest_per_user_day_tb(b: Bronze) -> DataFrame:
    return latest_per(
        audit(b).matched, [f"{A}date", "okta_user_id"], f"{A}ingestion_date", f"{A}record_id"
    )


@query(
    "union_by_name",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def union_by_name(b: Bronze) -> DataFrame:
    buyers = b.given("customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    sellers = b.given("supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return buyers.unionByName(sellers)


@query(
    "union_allow_missing",
    """SELECT o_orderkey AS id, o_totalprice AS price, CAST(NULL AS VARCHAR) AS brand FROM orders
    UNION ALL SELECT p_partkey, p_retailprice, p_brand FROM part""",
)
def union_allow_missing(b: Bronze) -> DataFrame:
    orders = b.given("orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    parts = b.given("part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price")
    )
    return orders.unionByName(parts, allowMissingColumns=True)


# --- data quality -----------------------------------------------------------------------------------------
@query(
    "dq_unique_id",
    "SELECT count(*) AS row_count, count(DISTINCT dynamic_alerts_notification_id) AS distinct_ids FROM s_alerts",
)
def dq_unique_id(b: Bronze) -> DataFrame:
    return quality.unique_id(notices.alerts_silver(b.table("alerts")), "dynamic_alerts_notification_id")


@query(
    "dq_null_after_cast",
    """SELECT count(*) AS row_count, count(*) FILTER (WHERE ts IS NULL) AS null_after_cast,
      count(*) FILTER (WHERE ts IS NULL AND loaded_at IS NOT NULL) AS lost_by_cast
    FROM (SELECT loaded_at, TRY_CAST(loaded_at AS TIMESTAMP) AS ts FROM b_access) a""",
)
def dq_null_after_cast(b: Bronze) -> DataFrame:
    from tiercraft.functions.columns import to_ts

    return quality.null_after_cast(b.rows("access"), F.col("loaded_at"), to_ts(F.col("loaded_at")))


@query(
    "dq_text_null",
    "SELECT count(*) AS row_count, count(*) FILTER (WHERE upper(security_email) = 'NULL') AS text_null FROM s_security",
)
def dq_text_null(b: Bronze) -> DataFrame:
    return quality.text_null(notices.security_silver(b.table("access")), "security_email")


@query(
    "dq_row_delta",
    """SELECT i::BIGINT AS rows_in, o::BIGINT AS rows_out, (i - o)::BIGINT AS rows_dropped
    FROM (SELECT (SELECT count(*) FROM b_access) AS i, (SELECT count(*) FROM s_security) AS o) n""",
)
def dq_row_delta(b: Bronze) -> DataFrame:
    bronze = b.table("access")
    return quality.row_delta(bronze, notices.security_silver(bronze))


@query(
    "dq_reject_rate",
    """SELECT 'matched' AS outcome, (SELECT count(*) FROM u_match) AS row_count
    UNION ALL SELECT 'okta_join_miss' AS outcome, (SELECT count(*) FROM u_rejects) AS row_count""",
)
def dq_reject_rate(b: Bronze) -> DataFrame:
    split = usage(b)
    return quality.reject_rate(split.matched, split.rejects, "OktaRejectReason")


# --- silver -----------------------------------------------------------------------------------------------
query("silver_headcount", "SELECT * FROM s_headcount")(headcount)
query("silver_identity", "SELECT * FROM s_identity")(identity)


@query("silver_usage", "SELECT * FROM s_usage")
def silver_usage(b: Bronze) -> DataFrame:
    return usage(b).matched


@query("silver_usage_rejects", "SELECT *, 'okta_join_miss' AS \"OktaRejectReason\" FROM u_rejects")
def silver_usage_rejects(b: Bronze) -> DataFrame:
    return usage(b).rejects.drop("OktaRejectLoadedAt")


@query("silver_audit", "SELECT * FROM s_audit")
def silver_audit(b: Bronze) -> DataFrame:
    return audit(b).matched


@query(
    "silver_audit_rejects",
    f"SELECT * EXCLUDE ({', '.join(PERSON)}), 'okta_join_miss' AS okta_reject_reason FROM a_people "
    'WHERE "OktaUserId" IS NULL',
)
def silver_audit_rejects(b: Bronze) -> DataFrame:
    return audit(b).rejects.drop("okta_reject_loaded_at")


@query("silver_priority_usage", "SELECT * FROM p_match WHERE okta_user_id IS NOT NULL")
def silver_priority_usage(b: Bronze) -> DataFrame:
    return priority_silver(b.table("usage_digits"), identity(b), RUN).matched


@query("silver_alerts", "SELECT * FROM s_alerts")
def silver_alerts(b: Bronze) -> DataFrame:
    return notices.alerts_silver(b.table("alerts"))


@query("silver_security", "SELECT * FROM s_security")
def silver_security(b: Bronze) -> DataFrame:
    return notices.security_silver(b.table("access"))


def _from_bronze(b: Bronze, plan, table: str) -> DataFrame:
    return plan(b.table(table))


def _table(name: str, plan, source: str, check: str) -> None:
    query(name, check)(partial(_from_bronze, plan=plan, table=source))


def _trimmed(source: str, **columns: str) -> str:
    return f"SELECT {', '.join(f'{trim_(c)} AS {out}' for out, c in columns.items())} FROM {source}"


_table(
    "ref_area",
    reference.area,
    "areas",
    _trimmed(
        "b_areas",
        area_normalized_area_users="area_users",
        area_normalized_area_core="area_core",
        area_normalized_division_inc="division",
    ),
)
_table(
    "ref_emails",
    reference.owner_emails,
    "owners",
    _trimmed(
        "b_owners",
        tcv_emails_op_co="opco",
        tcv_emails_opportunity_owner="owner",
        tcv_emails_owner_email="owner_email",
    ),
)
_table(
    "ref_country_region",
    reference.country_region,
    "places",
    _trimmed(
        "b_places",
        tcv_countries_region_country="country",
        tcv_countries_region_display_name="display_name",
        tcv_countries_region_regioninc="regioninc",
    ),
)
_table(
    "ref_stage",
    reference.stage_names,
    "stages",
    _trimmed(
        "b_stages", tcv_stage_normalized_stage="stage", **{"tcv_stage_normalized_stage_Normalized": "normalized"}
    ),
)
_table(
    "ref_business_unit",
    reference.business_unit,
    "units",
    f"""SELECT {trim_('unit')} AS business_unit_business_unit, {trim_('code')} AS business_unit_oneerp_code,
    TRY_CAST(loaded_at AS TIMESTAMP) AS business_unit_execution_date FROM b_units""",
)
_table(
    "ref_avg_hours",
    reference.average_hours,
    "hours",
    """SELECT * FROM (
      SELECT trim(country, ' ') AS country_average_hours_country_normalized,
        TRY_CAST(trim(month_hours, ' ') AS DECIMAL(18,8)) AS country_average_hours_average_month_hours,
        TRY_CAST(weekly_hours AS DECIMAL(18,8)) AS country_average_hours_average_weekly_hours,
        TRY_CAST(loaded_at AS TIMESTAMP) AS country_average_hours_execution_date FROM b_hours) h
    QUALIFY row_number() OVER (PARTITION BY country_average_hours_country_normalized
      ORDER BY country_average_hours_execution_date DESC NULLS LAST,
        country_average_hours_average_month_hours NULLS FIRST,
        country_average_hours_average_weekly_hours NULLS FIRST) = 1""",
)
_table("ref_norm_country_identity", reference.identity_countries, "identity_countries", "SELECT * FROM s_norm_identity")
_table("ref_norm_country_core", reference.core_countries, "core_country_names", "SELECT * FROM s_norm_core")
_table(
    "ref_office",
    reference.offices,
    "offices",
    f"""SELECT {trim_('nombre')} AS prl_office_locations_name, {trim_('code')} AS prl_office_locations_oneerp_code,
    {trim_('country')} AS prl_office_locations_country, {trim_('division')} AS prl_office_locations_division,
    CAST(execution_date AS TIMESTAMP) AS prl_office_locations_execution_date FROM b_offices""",
)
_table(
    "core_asset",
    core.core_asset,
    "assets",
    f"""SELECT {trim_('id')} AS asset_id, {trim_('display_name')} AS asset_display_name,
    {trim_('asset_code')} AS asset_asset_code, CAST(execution_date AS TIMESTAMP) AS asset_execution_date
    FROM b_assets WHERE {trim_('id')} <> ''""",
)
query("core_country", "SELECT * FROM s_core_country")(_core_country)
_table("core_billing", core.core_billing, "billings", "SELECT * FROM s_billing")
_table("core_project", core.core_project, "projects", "SELECT * FROM s_project")


@query(
    "core_identity",
    f"""SELECT {trim_('id')} AS okta_user_id, {trim_('display_name')} AS okta_user_full_name,
      first_name AS okta_user_first_name, last_name AS okta_user_last_name,
      lower({trim_('login')}) AS okta_user_email, lower({trim_('email')}) AS okta_user_full_email,
      employee_number AS okta_user_employee_number, region AS okta_user_region, okta_id AS okta_user_okta_id,
      CAST(updated_at AS TIMESTAMP) AS okta_user_updated_at, CAST(deleted_at AS TIMESTAMP) AS okta_user_deleted_at,
      coalesce(normalization_countries_okta_normalization, 'No Country') AS okta_user_country,
      okta_tenant AS okta_user_tenant, CAST(execution_date AS TIMESTAMP) AS okta_user_execution_date
    FROM b_identity LEFT JOIN s_norm_identity ON {trim_('country')} = normalization_countries_okta_country
    WHERE {trim_('id')} <> '' AND lower(region) <> 'excluded-region' AND lower(okta_tenant) <> 'excluded-tenant'""",
)
def core_identity(b: Bronze) -> DataFrame:
    names = reference.identity_countries(b.table("identity_countries"))
    return core.core_identity(b.table("identity"), names, EXCLUDED)


_table(
    "core_use_case_impl",
    core.use_case_implementation,
    "implementations",
    f"""SELECT {trim_('use_case')} AS core_use_case_implementation_use_case,
      display_name AS core_use_case_implementation_display_name, description AS core_use_case_implementation_description,
      hours_saved AS core_use_case_implementation_hours_saved, automation AS core_use_case_implementation_automation,
      CASE is_ai WHEN 'true' THEN true WHEN 'false' THEN false END AS core_use_case_implementation_is_ai,
      enabled = 'y' AS core_use_case_implementation_enabled,
      CAST(deleted_at AS TIMESTAMP) AS core_use_case_implementation_deleted_at,
      month_year AS core_use_case_implementation_month_year,
      CAST(execution_date AS TIMESTAMP) AS core_use_case_implementation_execution_date
    FROM b_implementations WHERE {trim_('use_case')} <> ''""",
)
_table(
    "core_use_case_adj",
    core.use_case_adjustment,
    "adjustments",
    f"""SELECT {trim_('id')} AS core_use_case_adjustment_id,
      TRY_CAST(start_date AS TIMESTAMP) AS core_use_case_adjustment_start_date,
      TRY_CAST(end_date AS TIMESTAMP) AS core_use_case_adjustment_end_date,
      use_case AS core_use_case_adjustment_use_case, hours_saved AS core_use_case_adjustment_hours_saved,
      automation AS core_use_case_adjustment_automation, {trim_('modified_by')} AS core_use_case_adjustment_modified_by,
      month_year AS core_use_case_adjustment_month_year,
      CAST(execution_date AS TIMESTAMP) AS core_use_case_adjustment_execution_date
    FROM b_adjustments WHERE {trim_('id')} <> ''""",
)


# --- gold -------------------------------------------------------------------------------------------------
@query("gold_usage_active", "SELECT * FROM g_usage_active")
def gold_usage_active(b: Bronze) -> DataFrame:
    return facts.usage_active_fact(usage(b).matched, RUN)


@query("gold_usage_onboard", "SELECT * FROM g_usage_onboard")
def gold_usage_onboard(b: Bronze) -> DataFrame:
    return facts.onboard_fact(usage(b).matched, "usage", RUN)


@query("gold_audit_active", "SELECT * FROM g_audit_active")
def gold_audit_active(b: Bronze) -> DataFrame:
    return facts.audit_active_fact(audit(b).matched, RUN)


@query("gold_audit_onboard", "SELECT * FROM g_audit_onboard")
def gold_audit_onboard(b: Bronze) -> DataFrame:
    return facts.onboard_fact(audit(b).matched, "audit", RUN)


@query(
    "gold_alerts",
    """SELECT dynamic_alerts_notification_id AS "NotificationID", dynamic_alerts_notification_type AS "NotificationType",
      dynamic_alerts_description AS "Description", dynamic_alerts_is_active AS "IsActive",
      dynamic_alerts_publication_date AS "PublicationDate", dynamic_alerts_severity AS "Severity" FROM s_alerts""",
)
def gold_alerts(b: Bronze) -> DataFrame:
    return notices.alerts_gold(notices.alerts_silver(b.table("alerts")))


@query(
    "gold_security",
    """SELECT security_email AS email, security_report AS report, security_access AS access,
      security_division AS division, security_access_scope AS access_scope FROM s_security""",
)
def gold_security(b: Bronze) -> DataFrame:
    return notices.security_gold(notices.security_silver(b.table("access")))
