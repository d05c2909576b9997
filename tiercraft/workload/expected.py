"""Expected results in SQL: named building blocks and the composition of a check from them.

The blocks follow the rules of the data model directly (joins, UNION, ROW_NUMBER), not the library's plans. Audit
values come from the conversations themselves, not from JSON.
"""

from __future__ import annotations

import re

from tiercraft.workload.adapters import SQL


def trim_(name: str) -> str:
    return f"trim({name}, ' ')"


def address_(name: str) -> str:
    return f"lower(trim({name}, ' '))"


def valid_(name: str) -> str:
    return rf"regexp_matches({address_(name)}, '^[^@\s]+@[^@\s]+\.[^@\s]+$')"


def month_(name: str) -> str:
    return f"CAST(year({name}) * 100 + month({name}) AS INTEGER)"


def key_(*parts: str) -> str:
    texts = ", ".join(f"coalesce(CAST({part} AS VARCHAR), '')" for part in parts)
    return f"sha256(concat_ws('|', {texts}))"


def first_(name: str, order: str) -> str:
    return f'first("{name}" ORDER BY {order}) FILTER (WHERE "{name}" IS NOT NULL)'


PERSON = (
    "OktaUserId",
    "OktaUserEmail",
    "OktaUserFullEmail",
    "OktaUserEmployeeNumber",
    "OktaUserFullName",
    "OktaUserRegion",
    "OktaUserCountry",
)
HEADCOUNT = (
    ("HCBusinessUnit", "HCBusinessUnit"),
    ("HCBusinessUnitCode", "HCBusinessUnitCode"),
    ("HCDivision", "HCDivision"),
    ("HCJobTitle", "HCJobTitle"),
    ("HCOffice", "HCOffice"),
    ("HCTalentSegment", "HCTalentSegment"),
    ("HCMonthNo", "Month_No"),
    ("HCOktaUserCountry", "OktaUserCountry"),
    ("HCDivisionINC", "HCDivisionINC"),
)
A = "purview_copilot_usage_"
_PERSONS = ", ".join(f'p."{name}"' for name in PERSON)
COST_TEXT = "CASE WHEN \"CursorUsageCost\" = 0 THEN '0E-8' ELSE CAST(\"CursorUsageCost\" AS VARCHAR) END"
USAGE_KEY = key_(
    '"CursorUsageUser"',
    '"CursorUsageDate"',
    '"CursorUsageKind"',
    '"CursorUsageModel"',
    '"CursorUsageMaxMode"',
    '"CursorUsageInputWithCacheWrite"',
    '"CursorUsageInputWithoutCacheWrite"',
    '"CursorUsageCacheRead"',
    '"CursorUsageOutputTokens"',
    '"CursorUsageTotalTokens"',
    COST_TEXT,
    '"CursorUsageFileName"',
    '"CursorUsageIngestionDate"',
    '"CursorUsageServiceAccountID"',
    '"CursorUsageCloudAgentID"',
    '"CursorUsageAutomationID"',
    '"OktaUserId"',
)


def headcount_columns(default: bool = True) -> str:
    """Each headcount column from the short address's row x, else the full address's row y."""
    out = []
    for added, source in HEADCOUNT:
        tail = ", 'Others'" if added == "HCDivisionINC" and default else ""
        out.append(f'coalesce(x."{source}", y."{source}"{tail}) AS "{added}"')
    return ", ".join(out)


def headcount_joins(month: str, short: str, full: str) -> str:
    return (
        f'LEFT JOIN hc_book x ON x."Month_No" = {month} AND x."OktaUserEmail" = {short} '
        f'LEFT JOIN hc_book y ON y."Month_No" = {month} AND y."OktaUserEmail" = {full}'
    )


def coalesced(*aliases: str) -> str:
    return ", ".join(
        "coalesce(" + ", ".join(f'{alias}."{name}"' for alias in aliases) + f') AS "{name}"' for name in PERSON
    )


FALLBACK = f"CASE WHEN regexp_matches({address_('user_text')}, '^10[^@]*@') THEN substr({address_('user_text')}, 3) END"
KIND = (
    "CASE WHEN app LIKE 'suite.data.%' THEN 'Report' "
    "WHEN app LIKE 'suite.studio.%' THEN 'Studio agent' "
    "WHEN agent IN ('Analyst', 'Researcher') THEN 'Named agent' "
    "WHEN app LIKE 'suiteagent.%' THEN 'Built-in agent' "
    "WHEN app IN ('suite.chat.web', 'suite.chat.firm') THEN 'Chat' "
    "WHEN app = 'suite.office' THEN 'Office' ELSE 'Other' END"
)
# kind -> code, automation, hours
FACTOR_ROWS = (
    "(VALUES ('Chat', '1', 0.75, 0.083333), ('Office', '2', 0.625, 0.8), "
    "('Built-in agent', '3', 1.00, 1.2), ('Studio agent', '4', 1.00, 1.3), "
    "('Named agent', '5', 1.00, 1.4), ('Report', '6', 0.75, 2.5), "
    "('Other', '7', 0.625, 1.7)) AS factors(kind, code, automation, hours)"
)
_D8 = "DECIMAL(18,8)"
HOURS_SAVED = "CAST(round(requests * hours, 6) AS DECIMAL(38,6))"
HOURS_TOTAL = "CAST(round(requests * (CAST(hours AS DOUBLE) / CAST(automation AS DOUBLE)), 9) AS DECIMAL(38,9))"

BLOCKS: dict[str, str] = {f"b_{name}": re.sub(r"\{(\w+)\}", r"\1", sql).strip() for name, sql in SQL.items()}
BLOCKS |= {
    "country_names": """
SELECT country AS lookup_key, min(display_name) AS lookup_value FROM b_countries WHERE country IS NOT NULL
GROUP BY country""",
    "s_identity": f"""
SELECT id AS "OktaUserId", {trim_('display_name')} AS "OktaUserFullName", {trim_('first_name')} AS "OktaUserFirstName",
  {trim_('last_name')} AS "OktaUserLastName", {address_('login')} AS "OktaUserEmail",
  {address_('email')} AS "OktaUserFullEmail", {trim_('employee_number')} AS "OktaUserEmployeeNumber",
  {trim_('region')} AS "OktaUserRegion", okta_id AS "OktaUserOktaId",
  TRY_CAST(updated_at AS TIMESTAMP) AS "OktaUserUpdatedAt", TRY_CAST(deleted_at AS TIMESTAMP) AS "OktaUserDeletedAt",
  {trim_('okta_tenant')} AS "OktaUserTenant", coalesce(lookup_value, 'No Country') AS "OktaUserCountry"
FROM b_identity LEFT JOIN country_names ON {trim_('country')} = lookup_key
WHERE id IS NOT NULL AND {valid_('login')} AND {valid_('email')}
  AND lower({trim_('region')}) <> 'excluded-region' AND lower({trim_('okta_tenant')}) <> 'excluded-tenant'""",
    "person": """
SELECT DISTINCT "OktaUserId", "OktaUserEmail", "OktaUserFullEmail", "OktaUserEmployeeNumber", "OktaUserFullName",
  "OktaUserRegion", "OktaUserCountry" FROM s_identity""",
    "by_short": """
SELECT * FROM person QUALIFY row_number() OVER (PARTITION BY "OktaUserEmail" ORDER BY "OktaUserId") = 1""",
    "by_full": """
SELECT * FROM person QUALIFY row_number() OVER (PARTITION BY "OktaUserFullEmail" ORDER BY "OktaUserId") = 1""",
    "s_headcount": f"""
SELECT TRY_CAST(month_text AS INTEGER) AS "Month_No", person_id AS "OktaUserEmployeeNumber",
  employee_code AS "HCEmployeeNumber", full_name AS "OktaUserFullName", region AS "HCRegion", office AS "HCOffice",
  business_unit AS "HCBusinessUnit", division AS "HCDivision", department AS "HCDepartment",
  legal_entity AS "HCLegalEntity", grid_subgroup AS "HCGridSubgroup", talent_segment AS "HCTalentSegment",
  job_title AS "HCJobTitle", {address_('email')} AS "OktaUserEmail", network AS "HCUserNetwork",
  roles AS "HCIncRoles", region AS "OktaUserRegion", division_inc AS "HCDivisionINC",
  CAST(total_employees AS INTEGER) AS "HCTotalEmployees", area AS "HCAreaEmeal",
  country_key AS "HCKeyIdEmployeeCountry", business_unit_code AS "HCBusinessUnitCode",
  replace_mapping AS "HCReplaceMapping", coalesce(lookup_value, 'No Country') AS "OktaUserCountry",
  make_date(TRY_CAST(month_text AS INTEGER) // 100, TRY_CAST(month_text AS INTEGER) % 100, 1) AS "HCDate",
  division_inc || '/' || coalesce(lookup_value, 'No Country') AS "HCKeyDivision",
  CAST(TRY_CAST(month_text AS INTEGER) AS VARCHAR) || '/' || {address_('email')} AS "HCKeyEmail"
FROM b_headcount LEFT JOIN country_names ON b_headcount.country = lookup_key
WHERE TRY_CAST(month_text AS INTEGER) IS NOT NULL AND email IS NOT NULL AND division_inc IS NOT NULL""",
    "hc_book": """
SELECT * FROM s_headcount
QUALIFY row_number() OVER (PARTITION BY "Month_No", "OktaUserEmail" ORDER BY "OktaUserEmployeeNumber") = 1""",
    "u_base": f"""
SELECT TRY_CAST(date_text AS DATE) AS "CursorUsageDate", {address_('user_text')} AS "CursorUsageUser",
  account_name AS "CursorUsageServiceAccountName", account_id AS "CursorUsageServiceAccountID",
  agent_id AS "CursorUsageCloudAgentID", automation_id AS "CursorUsageAutomationID", kind AS "CursorUsageKind",
  model AS "CursorUsageModel", max_mode AS "CursorUsageMaxMode",
  TRY_CAST(input_with AS BIGINT) AS "CursorUsageInputWithCacheWrite",
  TRY_CAST(split_part(input_without, '.', 1) AS BIGINT) AS "CursorUsageInputWithoutCacheWrite",
  TRY_CAST(cache_read AS BIGINT) AS "CursorUsageCacheRead",
  TRY_CAST(output_tokens AS BIGINT) AS "CursorUsageOutputTokens",
  TRY_CAST(total_tokens AS BIGINT) AS "CursorUsageTotalTokens",
  TRY_CAST(cost AS {_D8}) AS "CursorUsageCost", file_name AS "CursorUsageFileName",
  TRY_CAST(loaded_at AS TIMESTAMP) AS "CursorUsageIngestionDate",
  {month_('TRY_CAST(date_text AS DATE)')} AS "CursorUsageMonthNo"
FROM b_usage WHERE {valid_('user_text')}""",
    "u_match": f"""
SELECT u.*, {_PERSONS} FROM u_base u JOIN person p ON u."CursorUsageUser" = p."OktaUserEmail"
UNION
SELECT u.*, {_PERSONS} FROM u_base u JOIN person p ON u."CursorUsageUser" = p."OktaUserFullEmail\"""",
    "u_rejects": """
SELECT * FROM u_base u WHERE NOT EXISTS (
  SELECT 1 FROM person p WHERE u."CursorUsageUser" = p."OktaUserEmail" OR u."CursorUsageUser" = p."OktaUserFullEmail")
""",
    "s_usage": f"""
SELECT DISTINCT m.*, CAST("CursorUsageMonthNo" AS VARCHAR) || '/' || m."OktaUserEmail" AS "CursorUsageKeyEmail",
  CAST("CursorUsageMonthNo" AS VARCHAR) || '/' || m."OktaUserFullEmail" AS "CursorUsageKeyFullEmail",
  {headcount_columns()}, {USAGE_KEY.replace('"OktaUserId"', 'm."OktaUserId"')} AS "RecordSurrogateKey"
FROM u_match m {headcount_joins('"CursorUsageMonthNo"', 'm."OktaUserEmail"', 'm."OktaUserFullEmail"')}""",
    "a_fields": f"""
SELECT a.*, c % 29 = 28 AS malformed FROM b_audit a WHERE {valid_('user_text')}""",
    "a_values": f"""
SELECT record_id, CAST(day_text AS DATE) AS day, operation, {address_('user_text')} AS email, {FALLBACK} AS fallback,
  c, t, role, file_name, loaded_at, malformed,
  CASE WHEN NOT malformed THEN app END AS app, CASE WHEN NOT malformed THEN agent END AS agent,
  CASE WHEN NOT malformed THEN target_agent END AS target_agent,
  CASE WHEN malformed THEN 0 ELSE n_messages END AS messages,
  CASE WHEN malformed THEN 0 WHEN t % 2 = 0 THEN n_messages // 2 ELSE (n_messages + 1) // 2 END AS prompts,
  NOT malformed AND c % 17 = 0 AND n_messages >= 2 AS jailbreak,
  CASE WHEN malformed THEN 0 WHEN c % 3 = 0 THEN 2 WHEN c % 3 = 1 THEN 1 ELSE 0 END AS plugins,
  NOT malformed AND c % 3 = 0 AS web_search,
  CASE WHEN malformed THEN 0 ELSE n_resources END AS resources,
  CASE WHEN NOT malformed AND c % 3 = 0 THEN 'model-' || CAST(t AS VARCHAR) END AS model,
  CASE WHEN NOT malformed AND c % 3 = 0 THEN 'provider' END AS provider
FROM a_fields""",
    "a_base": f"""
SELECT record_id AS {A}record_id, day AS {A}date, CAST(261 AS INTEGER) AS {A}record_type, operation AS {A}operation,
  email AS {A}email, CAST(NULL AS VARCHAR) AS {A}associated_admin_units, 'unit' AS {A}associated_admin_units_names,
  app AS {A}app_identity, CASE WHEN NOT malformed THEN 'App ' || role END AS {A}application_name,
  CASE WHEN malformed THEN NULL WHEN role = 'user' THEN 'Word' ELSE 'Excel' END AS {A}app_host,
  agent AS {A}agent_name, target_agent AS {A}target_agent_name,
  CASE WHEN NOT malformed THEN 'Premium' END AS {A}license_type,
  CASE WHEN NOT malformed THEN 'conv-' || CAST(c AS VARCHAR) END AS {A}conversation_id,
  CASE WHEN NOT malformed THEN CAST(t AS VARCHAR) END AS {A}thread_id,
  model AS {A}model_name, provider AS {A}model_provider_name,
  CASE WHEN NOT malformed THEN '1.0' END AS {A}copilot_log_version, file_name AS {A}file_name,
  CAST(loaded_at AS TIMESTAMP) AS {A}ingestion_date, fallback AS {A}email_fallback, prompts > 0 AS {A}has_prompt,
  {KIND} AS {A}interaction_type, model IS NOT NULL OR provider IS NOT NULL AS {A}has_model_info,
  resources > 0 AS {A}has_resource_access, CAST(messages AS INTEGER) AS {A}message_count,
  CAST(prompts AS INTEGER) AS {A}prompt_count, jailbreak AS {A}jailbreak_detected,
  CAST(plugins AS INTEGER) AS {A}plugin_count, web_search AS {A}uses_bing_web_search,
  CAST(resources AS INTEGER) AS {A}accessed_resource_count, {month_('day')} AS {A}month_no
FROM a_values WHERE day >= DATE '2024-01-01'
QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY loaded_at DESC) = 1""",
    "a_people": f"""
SELECT a.*, {coalesced('s1', 'f1', 's2', 'f2')} FROM a_base a
LEFT JOIN by_short s1 ON a.{A}email = s1."OktaUserEmail" LEFT JOIN by_full f1 ON a.{A}email = f1."OktaUserFullEmail"
LEFT JOIN by_short s2 ON a.{A}email_fallback = s2."OktaUserEmail"
LEFT JOIN by_full f2 ON a.{A}email_fallback = f2."OktaUserFullEmail\"""",
    "s_audit": f"""
SELECT a.* EXCLUDE ({', '.join(f'"{name}"' for name in PERSON)}),
  a."OktaUserCountry" AS okta_user_country, a."OktaUserEmail" AS okta_user_email,
  a."OktaUserEmployeeNumber" AS okta_user_employee_number, a."OktaUserFullEmail" AS okta_user_full_email,
  a."OktaUserFullName" AS okta_user_full_name, a."OktaUserId" AS okta_user_id, a."OktaUserRegion" AS okta_user_region,
  CAST({A}month_no AS VARCHAR) || '/' || a."OktaUserEmail" AS {A}key_email,
  CAST({A}month_no AS VARCHAR) || '/' || a."OktaUserFullEmail" AS {A}key_full_email,
  h."HCBusinessUnit" AS hc_business_unit, h."HCBusinessUnitCode" AS hc_business_unit_code,
  h."HCDivision" AS hc_division, h."HCJobTitle" AS hc_job_title, h."HCOffice" AS hc_office,
  h."HCTalentSegment" AS hc_talent_segment, h."HCMonthNo" AS hc_month_no,
  h."HCOktaUserCountry" AS hc_okta_user_country, h."HCDivisionINC" AS hc_division_inc
FROM a_people a JOIN a_headcount h USING ({A}record_id) WHERE a."OktaUserId" IS NOT NULL""",
    "a_headcount": f"""
SELECT a.{A}record_id, {headcount_columns()} FROM a_people a
{headcount_joins(f'a.{A}month_no', 'a."OktaUserEmail"', 'a."OktaUserFullEmail"')}""",
    "p_base": f"""
SELECT DISTINCT event_id AS codex_usage_record_id, email AS codex_usage_email_normalized,
  CASE WHEN regexp_matches(split_part(email, '@', 1), '^10[0-9]+$') THEN substr(email, 3) END
    AS codex_usage_email_without_10,
  CASE WHEN split_part(email, '@', 1) LIKE '%.st' THEN replace(email, '.st@', '@') END
    AS codex_usage_email_without_st,
  CASE WHEN email LIKE '%@%' THEN split_part(email, '@', 1) END AS codex_usage_email_without_domain,
  CASE WHEN email LIKE '%.st@%' THEN regexp_replace(split_part(email, '@', 1), '\\.st$', '') END
    AS codex_usage_email_without_st_domain
FROM (SELECT event_id, {address_('user_text')} AS email FROM b_usage_digits) e""",
    "p_identity": f"""
SELECT "OktaUserId" AS okta_user_id, "OktaUserEmail" AS okta_user_email, "OktaUserFullEmail" AS okta_user_full_email,
  split_part("OktaUserEmail", '@', 1) AS short_local, split_part("OktaUserFullEmail", '@', 1) AS full_local,
  "OktaUserEmployeeNumber" AS okta_user_employee_number, "OktaUserFullName" AS okta_user_full_name,
  "OktaUserRegion" AS okta_user_region, "OktaUserCountry" AS okta_user_country
FROM person""",
    "p_rules": "\nUNION ALL\n".join(
        f"SELECT codex_usage_record_id AS rec, {rule} AS rule, p.okta_user_id FROM p_base b JOIN p_identity p "
        f"ON b.codex_usage_email_{name} = p.{column}"
        for rule, name, columns in (
            (1, "normalized", ("okta_user_email", "okta_user_full_email")),
            (2, "without_10", ("okta_user_email", "okta_user_full_email")),
            (3, "without_st", ("okta_user_email", "okta_user_full_email")),
            (4, "without_domain", ("short_local", "full_local")),
            (5, "without_st_domain", ("short_local", "full_local")),
        )
        for column in columns
    ),
    "p_best": """
SELECT rec, rule, okta_user_id FROM p_rules
QUALIFY row_number() OVER (PARTITION BY rec ORDER BY rule, okta_user_id) = 1""",
    "p_match": """
SELECT b.*, p.okta_user_id, p.okta_user_email, p.okta_user_full_email, p.okta_user_employee_number,
  p.okta_user_full_name, p.okta_user_region, p.okta_user_country
FROM p_base b LEFT JOIN p_best w ON b.codex_usage_record_id = w.rec
LEFT JOIN p_identity p ON w.okta_user_id = p.okta_user_id""",
    "s_alerts": f"""
SELECT {trim_('notification')} AS dynamic_alerts_notification_id, {trim_('kind')} AS dynamic_alerts_notification_type,
  {trim_('description')} AS dynamic_alerts_description, {trim_('is_active')} AS dynamic_alerts_is_active,
  CASE WHEN regexp_matches(published, '^[0-9]{{4}}-') THEN CAST(substr(published, 1, 10) AS DATE)
    ELSE coalesce(CAST(try_strptime(published, '%d/%m/%Y') AS DATE), CAST(try_strptime(published, '%m/%d/%Y') AS DATE))
    END AS dynamic_alerts_publication_date,
  {trim_('severity')} AS dynamic_alerts_severity, TRY_CAST(loaded_at AS TIMESTAMP) AS dynamic_alerts_execution_date
FROM b_alerts WHERE {trim_('notification')} <> ''
QUALIFY row_number() OVER (PARTITION BY {trim_('notification')} ORDER BY loaded_at DESC) = 1""",
    "s_security": f"""
SELECT {trim_('email')} AS security_email, {trim_('report')} AS security_report, {trim_('access')} AS security_access,
  {trim_('codigo')} AS security_codigo, {trim_('conocido')} AS security_conocido,
  {trim_('nombre')} AS security_nombre_completo, {trim_('pais')} AS security_pais,
  {trim_('job_title')} AS security_job_title, {trim_('ticket')} AS security_ticket,
  {trim_('division')} AS security_division, {trim_('access_scope')} AS security_access_scope,
  TRY_CAST(loaded_at AS TIMESTAMP) AS security_execution_date
FROM b_access WHERE email IS NOT NULL""",
    "s_norm_core": f"""
SELECT {trim_('id')} AS normalization_countries_core_id,
  {trim_('display_name')} AS normalization_countries_core_display_name,
  {trim_('normalized')} AS normalization_countries_core_normalized_country,
  CAST(execution_date AS TIMESTAMP) AS normalization_countries_core_execution_date FROM b_core_country_names""",
    "s_norm_identity": f"""
SELECT {trim_('country')} AS normalization_countries_okta_country,
  {trim_('normalization')} AS normalization_countries_okta_normalization,
  CAST(execution_date AS TIMESTAMP) AS normalization_countries_okta_execution_date FROM b_identity_countries
QUALIFY row_number() OVER (PARTITION BY {trim_('country')} ORDER BY execution_date DESC, normalization) = 1""",
    "s_core_country": f"""
SELECT country_id, normalization_countries_core_normalized_country AS country_display_name, country_execution_date
FROM (SELECT {trim_('id')} AS country_id, max(CAST(execution_date AS TIMESTAMP)) AS country_execution_date
      FROM b_core_countries WHERE {trim_('id')} <> '' GROUP BY 1) c
LEFT JOIN s_norm_core n ON c.country_id = n.normalization_countries_core_id""",
    "s_billing": f"""
SELECT {trim_('id')} AS core_billing_id, {trim_('billing_type')} AS core_billing_billing_type,
  {trim_('billing_identifier')} AS core_billing_billing_identifier,
  CAST(created_at AS TIMESTAMP) AS core_billing_created_at, CAST(updated_at AS TIMESTAMP) AS core_billing_updated_at,
  CAST(deleted_at AS TIMESTAMP) AS core_billing_deleted_at, {trim_('client_name')} AS core_billing_client_name,
  {trim_('country_od')} AS core_billing_country_id, {trim_('tenant')} AS core_billing_tenant,
  {trim_('region')} AS core_billing_region, CAST(execution_date AS TIMESTAMP) AS core_billing_execution_date
FROM b_billings WHERE {trim_('id')} <> ''""",
    "s_project": f"""
SELECT {trim_('id')} AS core_project_id, {trim_('display_name')} AS core_project_display_name,
  CASE active WHEN 'true' THEN true WHEN 'false' THEN false END AS core_project_active,
  TRY_CAST(create_at AS TIMESTAMP) AS core_project_create_at, TRY_CAST(updated_at AS TIMESTAMP) AS core_project_updated_at,
  TRY_CAST(deleted_at AS TIMESTAMP) AS core_project_deleted_at, {trim_('billing_id')} AS core_project_billing_id,
  corporate = 'yes' AS core_project_corporate, {trim_('tenant')} AS core_project_tenant,
  is_public = '1' AS core_project_is_public, CAST(execution_date AS TIMESTAMP) AS core_project_execution_date
FROM b_projects WHERE {trim_('id')} <> '' AND {trim_('billing_id')} <> ''""",
}

_USAGE_DIMS = (
    "CursorUsageMonthNo",
    "OktaUserFullName",
    "OktaUserEmployeeNumber",
    "OktaUserEmail",
    "OktaUserFullEmail",
    "OktaUserRegion",
    "OktaUserCountry",
    "HCBusinessUnit",
    "HCJobTitle",
    "HCOktaUserCountry",
    "HCOffice",
    "HCTalentSegment",
    "HCDivision",
    "HCBusinessUnitCode",
)
_AUDIT_DIMS = (
    f"{A}month_no",
    "okta_user_full_name",
    "okta_user_employee_number",
    "okta_user_email",
    "okta_user_full_email",
    "okta_user_region",
    "okta_user_country",
    "hc_business_unit",
    "hc_job_title",
    "hc_okta_user_country",
    "hc_office",
    "hc_talent_segment",
    "hc_division",
    "hc_business_unit_code",
)
_FACT_TAIL = (
    "CAST(1 AS INTEGER) AS \"UserWithActivity\", day AS \"LastModification\", unit AS \"User_UN\", job AS \"JobRoles\", "
    "hc_country AS \"Employee_Country\", office AS \"Employee_Office\", segment AS \"Segment\", "
    "division AS \"Foundation\", unit_code AS \"Employee_Business_Unit_Code\", "
)
_NULLS = ", ".join(
    f'CAST(NULL AS VARCHAR) AS "{name}"'
    for name in (
        "eventType",
        "id_project",
        "project",
        "account",
        "asset_model",
        "asset_useCase",
        "asset_mySourceType",
        "asset_sourceType",
        "billingClientName",
        "billingCountry",
        "billingRegion",
        "flowid",
    )
)
_PLAIN_NAMES = (
    "month_no",
    "full_name",
    "number",
    "short",
    "long",
    "region",
    "country",
    "unit",
    "job",
    "hc_country",
    "office",
    "segment",
    "division",
    "unit_code",
)


def _daily(dims: tuple[str, ...], order: str) -> str:
    return ", ".join(f'{first_(name, order)} AS "{name}"' for name in dims)


def _plain(dims: tuple[str, ...]) -> str:
    return ", ".join(f'"{name}" AS {plain}' for name, plain in zip(dims, _PLAIN_NAMES, strict=True))


_FACT_HEAD = (
    'month_no AS "Month_No", requests AS "Request", \'PENDING\' AS "assetId", user_id AS "userId", '
    'full_name AS "username", number AS "employeeid", short AS "userEmail", long AS "userFullEmail", '
    'region AS "Division", country AS "userCountry", '
)

BLOCKS |= {
    "u_daily": f"""
SELECT "CursorUsageDate", "OktaUserId", CAST(count(*) AS INTEGER) AS "Request",
  {_daily(_USAGE_DIMS, '"CursorUsageIngestionDate", "RecordSurrogateKey"')}
FROM s_usage GROUP BY 1, 2""",
    "a_daily": f"""
SELECT {A}date, okta_user_id, {A}interaction_type, CAST(sum({A}prompt_count) AS INTEGER) AS "Request",
  {_daily(_AUDIT_DIMS, f'{A}ingestion_date, {A}record_id')}
FROM s_audit GROUP BY 1, 2, 3 HAVING sum({A}prompt_count) >= 1""",
    "g_usage_active": f"""
SELECT {_FACT_HEAD} 'Cursor' AS "assetName", 'UC-9006-CURS-001' AS "useCaseCode", 'Active' AS "useCaseDisplayName",
  CAST(0 AS DECIMAL(38,6)) AS "UseCaseHoursSaved", CAST(0 AS DECIMAL(38,9)) AS "UseCaseTotalHours", {_FACT_TAIL}
  {_NULLS}, CAST(1 AS {_D8}) AS "useCaseMultiplier", CAST(1 AS {_D8}) AS automation_poc,
  CAST(0 AS {_D8}) AS "totalHoursSaved_poc", {key_('day', 'user_id')} AS "RecordSurrogateKey"
FROM (SELECT "CursorUsageDate" AS day, "OktaUserId" AS user_id, "Request" AS requests, {_plain(_USAGE_DIMS)}
      FROM u_daily) d
WHERE month_no IS NOT NULL AND day IS NOT NULL""",
    "g_audit_active": f"""
SELECT {_FACT_HEAD} 'M365 Copilot' AS "assetName", 'CASE-' || code AS "useCaseCode",
  d.kind AS "useCaseDisplayName", {HOURS_SAVED} AS "UseCaseHoursSaved", {HOURS_TOTAL} AS "UseCaseTotalHours",
  {_FACT_TAIL} {_NULLS}, CAST(1 AS {_D8}) AS "useCaseMultiplier", CAST(automation AS {_D8}) AS automation_poc,
  CAST(hours AS {_D8}) AS "totalHoursSaved_poc", {key_('day', 'user_id', 'd.kind')} AS "RecordSurrogateKey"
FROM (SELECT {A}date AS day, okta_user_id AS user_id, {A}interaction_type AS kind, "Request" AS requests,
        {_plain(_AUDIT_DIMS)} FROM a_daily) d
JOIN {FACTOR_ROWS} ON d.kind = factors.kind
WHERE month_no IS NOT NULL AND day IS NOT NULL""",
    "u_latest": """
SELECT * FROM s_usage QUALIFY row_number() OVER (PARTITION BY "CursorUsageDate", "OktaUserId"
  ORDER BY "CursorUsageIngestionDate" DESC NULLS LAST, "RecordSurrogateKey" DESC NULLS LAST) = 1""",
    "a_latest": f"""
SELECT * FROM s_audit QUALIFY row_number() OVER (PARTITION BY {A}date, okta_user_id
  ORDER BY {A}ingestion_date DESC NULLS LAST, {A}record_id DESC NULLS LAST) = 1""",
}


def onboard_(day: str, user: str, dims: dict[str, str], source: str) -> str:
    columns = ", ".join(f'"{column}" AS "{out}"' for out, column in dims.items())
    nulls = ", ".join(
        f'CAST(NULL AS VARCHAR) AS "{name}"'
        for name in ("account", "projectid", "projectName", "billingClientName", "billingCountry", "billingRegion")
    )
    return f"""
SELECT {columns}, "{day}" AS "LastModification", {nulls}, {key_(f'"{day}"', f'"{user}"')} AS "OnboardSurrogateKey"
FROM {source} WHERE "{dims['userEmail']}" IS NOT NULL AND "{dims['userFullEmail']}" IS NOT NULL AND "{day}" IS NOT NULL"""


BLOCKS |= {
    "g_usage_onboard": onboard_(
        "CursorUsageDate",
        "OktaUserId",
        {
            "username": "OktaUserFullName",
            "userNumberEmployee": "OktaUserEmployeeNumber",
            "userEmail": "OktaUserEmail",
            "userFullEmail": "OktaUserFullEmail",
            "userRegion": "OktaUserRegion",
            "userCountry": "OktaUserCountry",
            "Employee_Business_Unit": "HCBusinessUnit",
            "Job_Roles": "HCJobTitle",
            "Employee_Country": "OktaUserCountry",
            "Employee_Office": "HCOffice",
            "Employee_Segment": "HCTalentSegment",
            "Foundation": "HCDivision",
            "Employee_Business_Unit_Code": "HCBusinessUnitCode",
        },
        "u_latest",
    ),
    "g_audit_onboard": onboard_(
        f"{A}date",
        "okta_user_id",
        {
            "username": "okta_user_full_name",
            "userNumberEmployee": "okta_user_employee_number",
            "userEmail": "okta_user_email",
            "userFullEmail": "okta_user_full_email",
            "userRegion": "okta_user_region",
            "userCountry": "okta_user_country",
            "Employee_Business_Unit": "hc_business_unit",
            "Job_Roles": "hc_job_title",
            "Employee_Country": "okta_user_country",
            "Employee_Office": "hc_office",
            "Employee_Segment": "hc_talent_segment",
            "Foundation": "hc_division",
            "Employee_Business_Unit_Code": "hc_business_unit_code",
        },
        "a_latest",
    ),
}


def compose(sql: str) -> str:
    """The check with the blocks it needs in front, each before its users."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(re.findall(r"\b[a-z]\w*\b", text)) & BLOCKS.keys()):
            if name not in needed:
                visit(BLOCKS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    blocks = ",\n".join(f"{name} AS ({BLOCKS[name].strip()}\n)" for name in needed)
    return f"WITH {blocks}\n{sql.strip()}"
