"""Bronze-shaped inputs derived from the given tables.

Every row of a table becomes bronze rows; the rules only give values their variety. The SQL is plain enough for
Spark and for the checking engine: ``{table}`` names a given table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiercraft.plans.dimensions import Exclusions
from tiercraft.session import compiled_methods

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "labels",
    "conversations",
)
EXCLUDED = Exclusions(regions=("excluded-region",), tenants=("excluded-tenant",))
# A row of group 2 comes twice.
_COPIES = "(SELECT 1 AS n, 0 AS copy UNION ALL SELECT 2 AS n, 0 AS copy UNION ALL SELECT 2 AS n, 1 AS copy)"
_HEADCOUNT_MONTHS = (
    "(SELECT 0 AS n, '202401' AS m UNION ALL SELECT 0 AS n, '202402' AS m UNION ALL SELECT 0 AS n, '202403' AS m "
    "UNION ALL SELECT 1 AS n, '202401' AS m UNION ALL SELECT 1 AS n, '202403' AS m)"
)


def _usage(prefixed: str) -> str:
    return f"""
SELECT e.event_id AS event_id,
  CASE WHEN event_id % 89 = 0 THEN 'no date' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS date_text,
  CASE WHEN event_id % 97 = 0 THEN 'not-an-email'
       WHEN event_id % 6 = 0 THEN 'user' || CAST(user_id AS STRING) || '@corp.example'
       WHEN event_id % 6 = 1 THEN '  USER' || CAST(user_id AS STRING) || '@Corp.Example '
       WHEN event_id % 6 = 2 THEN {prefixed}
       WHEN event_id % 6 = 3 THEN 'user' || CAST(user_id AS STRING) || '.st@corp.example'
       WHEN event_id % 6 = 4 THEN 'user' || CAST(user_id AS STRING) || '@other.example'
       ELSE 'user' || CAST(user_id AS STRING) || '.st@other.example' END AS user_text,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'svc-' || CAST(user_id % 7 AS STRING) END AS account_name,
  'sa-' || CAST(user_id % 7 AS STRING) AS account_id,
  CASE WHEN event_id % 5 = 0 THEN 'agent-' || CAST(user_id % 3 AS STRING) END AS agent_id,
  CAST(NULL AS STRING) AS automation_id,
  event_type AS kind,
  'model-' || CAST(event_id % 4 AS STRING) AS model,
  CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS max_mode,
  CAST(event_id % 1000 AS STRING) AS input_with,
  CAST(event_id % 700 AS STRING) || '.0' AS input_without,
  CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(event_id % 50 AS STRING) END AS cache_read,
  CAST(event_id % 400 AS STRING) AS output_tokens,
  CAST(event_id % 2000 AS STRING) AS total_tokens,
  CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS cost,
  'usage-' || CAST(user_id % 4 AS STRING) || '.csv' AS file_name,
  '2024-02-01 00:00:' || lpad(CAST(event_id % 60 AS STRING), 2, '0') AS loaded_at
FROM {{events}} e JOIN {_COPIES} c ON c.n = CASE WHEN e.event_id % 50 = 0 THEN 2 ELSE 1 END"""


SQL = {
    "countries": """
SELECT CASE WHEN n_nationkey % 7 = 3 THEN lower(n_name) ELSE n_name END AS country,
  r_name || ' ' || CAST(n_nationkey AS STRING) AS display_name
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "identity": """
SELECT 'U' || CAST(c_custkey AS STRING) AS id,
  ' ' || c_name || ' ' AS display_name,
  'First' || CAST(c_custkey AS STRING) AS first_name,
  'Last' || CAST(c_custkey AS STRING) AS last_name,
  CASE WHEN c_custkey % 10 = 9 THEN 'ext' || CAST(c_custkey AS STRING) || '@partner.example'
       WHEN c_custkey % 5 = 0 THEN ' Alt' || CAST(c_custkey AS STRING) || '@Corp.Example '
       WHEN c_custkey % 50 = 7 THEN 'user' || CAST(c_custkey - 1 AS STRING) || '@corp.example'
       ELSE 'user' || CAST(c_custkey AS STRING) || '@corp.example' END AS login,
  CASE WHEN c_custkey % 10 = 9 THEN 'ext' || CAST(c_custkey AS STRING) || '@partner.example'
       WHEN c_custkey % 4 = 1 THEN CAST(c_custkey AS STRING) || '@corp.example'
       ELSE 'user' || CAST(c_custkey AS STRING) || '@corp.example' END AS email,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'E' || CAST(c_custkey AS STRING) END AS employee_number,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'Excluded-Region' ELSE r_name END AS region,
  '00u' || CAST(c_custkey AS STRING) AS okta_id,
  CAST(DATE '2024-01-01' + CAST(c_custkey % 60 AS INT) AS STRING) || ' 00:00:00' AS updated_at,
  CAST(NULL AS STRING) AS deleted_at,
  ' ' || n_name || ' ' AS country,
  CASE WHEN c_custkey % 19 = 0 THEN 'EXCLUDED-tenant' ELSE c_mktsegment END AS okta_tenant,
  '2024-02-01 00:00:00' AS execution_date
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "usage": _usage("'10user' || CAST(user_id AS STRING) || '@corp.example'"),
    "usage_digits": _usage("'10' || CAST(user_id AS STRING) || '@corp.example'"),
    "headcount": f"""
SELECT CASE WHEN c_custkey % 37 = 0 THEN 'n/a' ELSE m END AS month_text,
  'E' || CAST(c_custkey AS STRING) AS person_id,
  'C' || CAST(c_custkey AS STRING) AS employee_code,
  c_name AS full_name,
  r_name AS region,
  n_name AS country,
  'Office ' || CAST(c_custkey % 20 AS STRING) AS office,
  'BU' || CAST(c_custkey % 8 AS STRING) AS business_unit,
  c_mktsegment AS division,
  'Dept' || CAST(c_custkey % 15 AS STRING) AS department,
  'LE' || CAST(c_custkey % 3 AS STRING) AS legal_entity,
  'G' || CAST(c_custkey % 5 AS STRING) AS grid_subgroup,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'T' || CAST(c_custkey % 4 AS STRING) END AS talent_segment,
  'Job ' || CAST(c_custkey % 30 AS STRING) || ' in ' || m AS job_title,
  CASE WHEN c_custkey % 50 = 7 THEN 'User' || CAST(c_custkey - 1 AS STRING) || '@Corp.Example'
       WHEN c_custkey % 4 = 1 THEN ' ' || CAST(c_custkey AS STRING) || '@Corp.Example '
       ELSE 'User' || CAST(c_custkey AS STRING) || '@Corp.Example' END AS email,
  'N' || CAST(c_custkey AS STRING) AS network,
  'R' || CAST(c_custkey % 6 AS STRING) AS roles,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'D' || CAST(c_custkey % 4 AS STRING) END AS division_inc,
  '1' AS total_employees,
  'A' || CAST(c_custkey % 2 AS STRING) AS area,
  CAST(c_custkey AS STRING) || '-' || n_name AS country_key,
  'BUC' || CAST(c_custkey % 8 AS STRING) AS business_unit_code,
  CAST(NULL AS STRING) AS replace_mapping
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
  JOIN {_HEADCOUNT_MONTHS} months ON months.n = c_custkey % 2""",
    "audit": f"""
SELECT conv_id AS c, turn AS t, role, text, copy,
  'rec-' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS record_id,
  CAST(DATE '2024-01-01' + CAST(conv_id % 80 AS INT) AS STRING) AS day_text,
  CASE WHEN conv_id % 23 = 22 THEN 'invalid'
       WHEN conv_id % 6 = 0 THEN 'user' || CAST(conv_id AS STRING) || '@corp.example'
       WHEN conv_id % 6 = 1 THEN ' User' || CAST(conv_id AS STRING) || '@Corp.Example'
       WHEN conv_id % 6 = 2 THEN '10user' || CAST(conv_id AS STRING) || '@corp.example'
       WHEN conv_id % 6 = 3 THEN '10ghost' || CAST(conv_id AS STRING) || '@corp.example'
       WHEN conv_id % 6 = 4 THEN 'user' || CAST(conv_id AS STRING) || '@other.example'
       ELSE CAST(conv_id AS STRING) || '@corp.example' END AS user_text,
  CASE (conv_id + turn) % 8 WHEN 0 THEN 'suite.data.report' WHEN 1 THEN 'suite.studio.helper'
       WHEN 2 THEN 'suiteagent.planner' WHEN 3 THEN 'suite.chat.web'
       WHEN 4 THEN 'suite.chat.firm' WHEN 5 THEN 'suite.office'
       WHEN 6 THEN 'suite.unlisted' END AS app,
  CASE (conv_id + turn) % 5 WHEN 0 THEN 'Analyst' WHEN 1 THEN 'Researcher' WHEN 2 THEN 'Helper' END AS agent,
  CASE WHEN turn % 2 = 0 THEN 'Target' END AS target_agent,
  CAST((conv_id + turn) % 4 AS INT) AS n_messages,
  CAST((conv_id + turn) % 5 AS INT) AS n_resources,
  'Interaction' || CAST(copy AS STRING) AS operation,
  'audit-' || CAST(conv_id % 3 AS STRING) || '.csv' AS file_name,
  CASE WHEN copy = 0 THEN '2024-04-01 00:00:00' ELSE '2024-04-02 00:00:00' END AS loaded_at
FROM {{conversations}} v JOIN {_COPIES} k ON k.n = CASE WHEN v.turn = 0 THEN 2 ELSE 1 END""",
    "monthly": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS order_day,
  CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS month_no
FROM {orders}""",
    "alerts": """
SELECT CASE WHEN doc_id % 40 = 0 THEN '  ' ELSE ' ' || CAST(doc_id - doc_id % 2 AS STRING) || ' ' END AS notification,
  lang AS kind,
  text AS description,
  CASE WHEN doc_id % 3 = 0 THEN 'true' ELSE 'false' END AS is_active,
  CASE doc_id % 5 WHEN 0 THEN day_text
       WHEN 1 THEN substr(day_text, 9, 2) || '/' || substr(day_text, 6, 2) || '/' || substr(day_text, 1, 4)
       WHEN 2 THEN substr(day_text, 6, 2) || '/' || substr(day_text, 9, 2) || '/' || substr(day_text, 1, 4)
       WHEN 3 THEN day_text || ' 12:30:00' ELSE 'not a date' END AS published,
  ' ' || source AS severity,
  '2024-05-01 00:00:' || lpad(CAST(doc_id % 60 AS STRING), 2, '0') AS loaded_at
FROM (SELECT doc_id, lang, text, source,
        CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INT) AS STRING) AS day_text FROM {documents}) d""",
    "access": """
SELECT CASE WHEN d.doc_id % 10 = 0 THEN NULL WHEN d.doc_id % 10 = 1 THEN 'NULL'
       ELSE ' doc' || CAST(d.doc_id AS STRING) || '@corp.example ' END AS email,
  source AS report,
  CASE WHEN quality = 1 THEN 'read' WHEN quality = 0 THEN ' write ' END AS access,
  CAST(n_chars AS STRING) AS codigo,
  CASE WHEN toxic = 1 THEN 'si' ELSE 'no' END AS conocido,
  'Nombre ' || CAST(d.doc_id AS STRING) AS nombre,
  lang AS pais,
  'Job ' || CAST(d.doc_id % 9 AS STRING) AS job_title,
  'T-' || CAST(d.doc_id AS STRING) AS ticket,
  'Division ' || CAST(d.doc_id % 4 AS STRING) AS division,
  text AS access_scope,
  CASE WHEN d.doc_id % 7 = 0 THEN 'unknown' ELSE '2024-05-01 00:00:00' END AS loaded_at
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "projects": """
SELECT CASE WHEN o_orderkey % 41 = 0 THEN '  ' ELSE ' P' || CAST(o_orderkey AS STRING) END AS id,
  'Project ' || CAST(o_orderkey AS STRING) AS display_name,
  CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE 'maybe' END AS active,
  CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 00:00:00' AS create_at,
  CASE WHEN o_orderkey % 5 = 0 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 08:00:00' END
    AS updated_at,
  CAST(NULL AS STRING) AS deleted_at,
  CASE WHEN o_orderkey % 43 = 0 THEN '' ELSE 'B' || CAST(o_custkey AS STRING) || ' ' END AS billing_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END AS corporate,
  o_orderpriority AS tenant,
  CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '0' END AS is_public,
  '2024-05-01 00:00:00' AS execution_date
FROM {orders}""",
    "billings": """
SELECT 'B' || CAST(c_custkey AS STRING) AS id,
  c_mktsegment AS billing_type,
  'ID' || CAST(c_custkey AS STRING) AS billing_identifier,
  '2023-01-01 00:00:00' AS created_at,
  CAST(DATE '2024-01-01' + CAST(c_custkey % 60 AS INT) AS STRING) || ' 00:00:00' AS updated_at,
  CASE WHEN c_custkey % 8 = 0 THEN '2024-04-01 00:00:00' END AS deleted_at,
  c_name || ' ' AS client_name,
  CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE 'C' || CAST(c_nationkey AS STRING) END AS country_od,
  'tenant-' || CAST(c_custkey % 3 AS STRING) AS tenant,
  'region-' || CAST(c_custkey % 4 AS STRING) AS region,
  '2024-05-01 00:00:00' AS execution_date
FROM {customer}""",
    "core_countries": """
SELECT ' C' || CAST(s_nationkey AS STRING) || ' ' AS id,
  '2024-05-01 00:00:' || lpad(CAST(s_suppkey % 60 AS STRING), 2, '0') AS execution_date
FROM {supplier}""",
    "core_country_names": """
SELECT 'C' || CAST(n_nationkey AS STRING) AS id, n_name AS display_name,
  CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE ' ' || r_name || '/' || n_name END AS normalized,
  '2024-05-01 00:00:00' AS execution_date
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "identity_countries": """
SELECT CASE WHEN n_nationkey % 7 = 3 THEN n_name || '?' ELSE ' ' || n_name END AS country,
  r_name || ' ' || CAST(n_nationkey AS STRING) AS normalization,
  '2024-05-01 00:00:' || lpad(CAST(s_suppkey % 60 AS STRING), 2, '0') AS execution_date
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "assets": """
SELECT CASE WHEN p_partkey % 31 = 0 THEN ' ' ELSE 'A' || CAST(p_partkey AS STRING) END AS id,
  p_name AS display_name, p_brand || ' ' AS asset_code, '2024-05-01 00:00:00' AS execution_date
FROM {part}""",
    "implementations": """
SELECT CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE ' UC-' || CAST(p_partkey AS STRING) END AS use_case,
  p_name AS display_name, p_type AS description,
  CAST(p_size AS STRING) || ' h' AS hours_saved, p_brand AS automation,
  CASE p_partkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'unknown' END AS is_ai,
  CASE WHEN p_partkey % 2 = 0 THEN 'y' ELSE 'n' END AS enabled,
  CAST(NULL AS STRING) AS deleted_at, '2024-01' AS month_year, '2024-05-01 00:00:00' AS execution_date
FROM {part}""",
    "adjustments": """
SELECT CASE WHEN l_linenumber = 7 THEN ' '
       ELSE CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS id,
  CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 00:00:00' AS start_date,
  CASE WHEN l_returnflag = 'R' THEN 'open' ELSE CAST(CAST(l_shipdate AS DATE) + 30 AS STRING) || ' 00:00:00' END
    AS end_date,
  'UC-' || CAST(l_partkey AS STRING) AS use_case,
  CAST(CAST(l_quantity AS INT) AS STRING) AS hours_saved,
  l_linestatus AS automation,
  ' S' || CAST(l_suppkey AS STRING) AS modified_by,
  substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) AS month_year,
  '2024-05-01 00:00:00' AS execution_date
FROM {lineitem}""",
    "areas": """
SELECT ' ' || n_name AS area_users, r_name || ' ' AS area_core, 'D' || CAST(n_nationkey % 4 AS STRING) AS division
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "owners": """
SELECT ' op' || CAST(s_nationkey AS STRING) AS opco, s_name AS owner,
  ' owner' || CAST(s_suppkey AS STRING) || '@corp.example ' AS owner_email
FROM {supplier}""",
    "places": """
SELECT n_name AS country, ' ' || n_name || ' ' AS display_name, r_name AS regioninc
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "stages": """
SELECT ' ' || o_orderpriority AS stage, o_orderstatus || ' ' AS normalized FROM {orders}""",
    "units": """
SELECT ' ' || p_brand AS unit, 'E' || CAST(p_partkey AS STRING) || ' ' AS code,
  CASE WHEN p_partkey % 4 = 0 THEN 'later' ELSE '2024-05-01 00:00:00' END AS loaded_at
FROM {part}""",
    "hours": """
SELECT ' ' || n_name AS country,
  CASE WHEN s_suppkey % 9 = 0 THEN 'n/a' ELSE ' ' || CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS STRING) END
    AS month_hours,
  CAST(s_suppkey % 40 AS STRING) AS weekly_hours,
  '2024-05-01 00:' || lpad(CAST(s_suppkey % 60 AS STRING), 2, '0') || ':'
    || lpad(CAST((s_suppkey - s_suppkey % 60) % 3600 % 59 AS STRING), 2, '0') AS loaded_at
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "offices": """
SELECT ' ' || s_name AS nombre, 'E' || CAST(s_suppkey AS STRING) AS code, n_name AS country,
  'D' || CAST(s_suppkey % 3 AS STRING) AS division, '2024-05-01 00:00:00' AS execution_date
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
}

# Derived tables whose rows are far wider than those they are made of, or sorted where they are read: the table and columns
# that deal their rows out, so that the work on them is not bound to the few tasks that a table in few row groups is read in.
DEALT_BY = {
    "usage": ("events", ["event_id"]),
    # by both, so that rows of one id are not all sorted in one task before they are reduced to its first address
    "usage_digits": ("events", ["event_id", "user_id"]),
    "headcount": ("customer", ["c_custkey"]),
    "audit": ("conversations", ["conv_id", "turn"]),
}

# Headers as they arrive in bronze, where they differ from the column names above.
HEADERS = {
    "countries": {"country": "Country", "display_name": "DisplayName"},
    "usage": {
        "date_text": "Date",
        "user_text": "User",
        "account_name": "Service Account Name",
        "account_id": "Service Account ID",
        "agent_id": "Cloud Agent ID",
        "automation_id": "Automation ID",
        "kind": "Kind",
        "model": "Model",
        "max_mode": "Max Mode",
        "input_with": "Input (w/ Cache Write)",
        "input_without": "Input (w/o Cache Write)",
        "cache_read": "Cache Read",
        "output_tokens": "Output Tokens",
        "total_tokens": "Total Tokens",
        "cost": "Cost",
        "file_name": "FileName",
        "loaded_at": "ExecutionDate",
    },
    "usage_digits": {"event_id": "usage_id", "user_text": "source_email"},
    "headcount": {
        "month_text": "Month",
        "person_id": "Person ID",
        "employee_code": "Employee Code",
        "full_name": "Fullname [Employee]",
        "region": "Region [Employee]",
        "country": "Country [Employee]",
        "office": "Office [Employee]",
        "business_unit": "Business Unit [Employee]",
        "division": "Division [Employee]",
        "department": "Department [Employee]",
        "legal_entity": "Legal Entity [Employee]",
        "grid_subgroup": "Grid Subgroup [Employee]",
        "talent_segment": "Talent Segment [Employee]",
        "job_title": "Job Title [Employee]",
        "email": "Email [Employee]",
        "network": "User Network [Employee]",
        "roles": "Inc. Roles",
        "division_inc": "Division INC",
        "total_employees": "Total Employees",
        "area": "Area Emeal",
        "country_key": "KeyIdEmployeeCountry",
        "business_unit_code": "Business Unit Code [Employee]",
        "replace_mapping": "Replace Mapping",
    },
    "alerts": {
        "notification": "NotificationID",
        "kind": "notification_type",
        "description": "Description",
        "is_active": "Is Active",
        "published": "PublicationDate",
        "severity": "SEVERITY",
        "loaded_at": "ExecutionDate",
    },
    "access": {
        "email": "Email",
        "nombre": "Nombre Completo",
        "job_title": "Job Title",
        "access_scope": "AccessScope",
        "loaded_at": "execution_date",
    },
    "areas": {"area_users": "AreaUsers", "area_core": "area_core", "division": "Division INC"},
    "owners": {"owner": "Opportunity Owner", "owner_email": "OwnerEmail"},
    "stages": {"stage": "Stage", "normalized": "Stage Normalized"},
    "units": {"unit": "Business Unit", "code": "OneERP Code", "loaded_at": "Execution Date"},
    "hours": {
        "country": "Country Normalized",
        "month_hours": "Average month hours",
        "weekly_hours": "AverageWeeklyHours",
        "loaded_at": "execution_date",
    },
    "offices": {"nombre": "Nombre", "code": "oneerp_code"},
    "core_country_names": {"normalized": "Normalized country"},
}


class Bronze:
    """The given tables in one folder, and the bronze tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        # Adapters and keys turn timestamps into text, which has to be the same text everywhere.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        compiled_methods(spark)
        self._given: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._given[name]

    def rows(self, name: str) -> DataFrame:
        """A derived table with plain column names."""
        sql = SQL[name]
        tables = {table: self.given(table) for table in TABLES if "{" + table + "}" in sql}
        if name in DEALT_BY:
            table, columns = DEALT_BY[name]
            tables[table] = tables[table].repartition(*columns)
        return self.spark.sql(sql, **tables)

    def table(self, name: str) -> DataFrame:
        """A derived table with the headers it has in bronze."""
        if name == "audit":
            return self._audit()
        rows = self.rows(name).withColumnsRenamed(HEADERS.get(name, {}))
        if name == "headcount":
            rows = rows.withColumn("Okta Region", F.col("`Region [Employee]`"))
        return rows

    def _audit(self) -> DataFrame:
        """Conversation turns as audit records; the whole text travels in the payload."""
        rows = self.rows("audit")
        position = F.sequence(F.lit(1), F.col("n_messages"))
        messages = F.transform(
            F.when(F.col("n_messages") > 0, position).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(
                ((i + F.col("t")) % 2 == 0).alias("isPrompt"),
                F.when((F.col("c") % 17 == 0) & (i == 2), F.lit(True)).alias("JailbreakDetected"),
                F.when(i == 1, F.col("text")).alias("Text"),
            ),
        )
        plugin = F.struct(F.lit("OtherPlugin").alias("Id"))
        search = F.struct(F.lit("BingWebSearch").alias("Id"))
        plugins = F.when(F.col("c") % 3 == 0, F.array(search, plugin)).when(F.col("c") % 3 == 1, F.array(plugin))
        resources = F.transform(
            F.when(F.col("n_resources") > 0, F.sequence(F.lit(1), F.col("n_resources"))),
            lambda i: F.struct(i.alias("Number"), F.lit("file").alias("Type")),
        )
        models = F.when(
            F.col("c") % 3 == 0,
            F.array(
                F.struct(
                    F.concat(F.lit("model-"), F.col("t").cast("string")).alias("ModelName"),
                    F.lit("provider").alias("ModelProviderName"),
                )
            ),
        )
        event = F.struct(
            F.when(F.col("role") == "user", F.lit("Word")).otherwise(F.lit("Excel")).alias("AppHost"),
            F.col("target_agent").alias("TargetAgentName"),
            F.lit("Premium").alias("LicenseType"),
            F.concat(F.lit("conv-"), F.col("c").cast("string")).alias("ConversationId"),
            F.col("t").alias("ThreadId"),
            messages.alias("Messages"),
            plugins.alias("AISystemPlugin"),
            resources.alias("AccessedResources"),
            models.alias("ModelTransparencyDetails"),
        )
        payload = F.to_json(
            F.struct(
                F.col("app").alias("AppIdentity"),
                F.concat(F.lit("App "), F.col("role")).alias("ApplicationName"),
                F.col("agent").alias("AgentName"),
                F.lit("1.0").alias("CopilotLogVersion"),
                event.alias("CopilotEventData"),
            )
        )
        malformed = F.concat(F.lit("x"), payload)
        return rows.select(
            F.col("record_id").alias("RecordId"),
            F.concat(F.col("day_text"), F.lit("T10:00:00")).alias("CreationDate"),
            F.col("user_text").alias("UserId"),
            F.when(F.col("c") % 29 == 28, malformed).otherwise(payload).alias("AuditData"),
            F.lit("261").alias("RecordType"),
            F.col("operation").alias("Operation"),
            F.lit(None).cast("string").alias("AssociatedAdminUnits"),
            F.lit("unit").alias("AssociatedAdminUnitsNames"),
            F.col("file_name").alias("FileName"),
            F.col("loaded_at").alias("ExecutionDate"),
        )
