"""The columns of the tables.

Each layout lists ``(output column, cleaning rule, accepted bronze headers ...)`` in output order; the names are
the data model's and have to be kept.
"""

from __future__ import annotations

from tiercraft.functions.columns import (
    as_is,
    to_bool,
    to_date,
    to_decimal,
    to_ts,
    to_whole,
    trim_lower,
    trimmed,
)
from tiercraft.functions.dates import parse_date


def _long(value):
    return to_whole(value, "bigint")


def _cost(value):
    return value.try_cast("decimal(18,8)")


# --- usage stream A ---------------------------------------------------------------------------------------
USAGE = (
    ("CursorUsageDate", to_date, "Date"),
    ("CursorUsageUser", trim_lower, "User"),
    ("CursorUsageServiceAccountName", as_is, "Service Account Name"),
    ("CursorUsageServiceAccountID", as_is, "Service Account ID"),
    ("CursorUsageCloudAgentID", as_is, "Cloud Agent ID"),
    ("CursorUsageAutomationID", as_is, "Automation ID"),
    ("CursorUsageKind", as_is, "Kind"),
    ("CursorUsageModel", as_is, "Model"),
    ("CursorUsageMaxMode", as_is, "Max Mode"),
    ("CursorUsageInputWithCacheWrite", _long, "Input (w/ Cache Write)"),
    ("CursorUsageInputWithoutCacheWrite", _long, "Input (w/o Cache Write)"),
    ("CursorUsageCacheRead", _long, "Cache Read"),
    ("CursorUsageOutputTokens", _long, "Output Tokens"),
    ("CursorUsageTotalTokens", _long, "Total Tokens"),
    ("CursorUsageCost", _cost, "Cost"),
    ("CursorUsageFileName", as_is, "FileName"),
    ("CursorUsageIngestionDate", to_ts, "ExecutionDate"),
)
USAGE_KEY_PARTS = (
    "CursorUsageUser",
    "CursorUsageDate",
    "CursorUsageKind",
    "CursorUsageModel",
    "CursorUsageMaxMode",
    "CursorUsageInputWithCacheWrite",
    "CursorUsageInputWithoutCacheWrite",
    "CursorUsageCacheRead",
    "CursorUsageOutputTokens",
    "CursorUsageTotalTokens",
    "CursorUsageCost",
    "CursorUsageFileName",
    "CursorUsageIngestionDate",
    "CursorUsageServiceAccountID",
    "CursorUsageCloudAgentID",
    "CursorUsageAutomationID",
    "OktaUserId",
)
ACTIVE_KEY = "RecordSurrogateKey"
ONBOARD_KEY = "OnboardSurrogateKey"
REJECT_REASON = "okta_join_miss"

# --- audit stream B ---------------------------------------------------------------------------------------
AUDIT_PREFIX = "purview_copilot_usage_"
# Columns of the parsed audit record, as stored in the reject table (without the prefix): name, type.
AUDIT_RECORD = (
    ("record_id", "string"),
    ("date", "date"),
    ("record_type", "int"),
    ("operation", "string"),
    ("email", "string"),
    ("associated_admin_units", "string"),
    ("associated_admin_units_names", "string"),
    ("app_identity", "string"),
    ("application_name", "string"),
    ("app_host", "string"),
    ("agent_name", "string"),
    ("target_agent_name", "string"),
    ("license_type", "string"),
    ("conversation_id", "string"),
    ("thread_id", "string"),
    ("model_name", "string"),
    ("model_provider_name", "string"),
    ("copilot_log_version", "string"),
    ("file_name", "string"),
    ("ingestion_date", "timestamp"),
    ("email_fallback", "string"),
    ("has_prompt", "boolean"),
    ("interaction_type", "string"),
    ("has_model_info", "boolean"),
    ("has_resource_access", "boolean"),
    ("message_count", "int"),
    ("prompt_count", "int"),
    ("jailbreak_detected", "boolean"),
    ("plugin_count", "int"),
    ("uses_bing_web_search", "boolean"),
    ("accessed_resource_count", "int"),
    ("month_no", "int"),
)
AUDIT_REQUIRED = ("record_id", "month_no")
AUDIT_REJECT_STAMP = (("okta_reject_reason", "string"), ("okta_reject_loaded_at", "timestamp"))
# Order of the audit columns in the silver table (without the prefix); people and headcount columns follow.
AUDIT_SILVER = (
    "record_id",
    "date",
    "record_type",
    "operation",
    "email",
    "email_fallback",
    "associated_admin_units",
    "associated_admin_units_names",
    "app_identity",
    "application_name",
    "app_host",
    "agent_name",
    "target_agent_name",
    "license_type",
    "conversation_id",
    "thread_id",
    "model_name",
    "model_provider_name",
    "message_count",
    "prompt_count",
    "has_prompt",
    "jailbreak_detected",
    "plugin_count",
    "uses_bing_web_search",
    "accessed_resource_count",
    "interaction_type",
    "has_model_info",
    "has_resource_access",
    "copilot_log_version",
    "month_no",
    "file_name",
    "ingestion_date",
)
AUDIT_PERSON = (
    ("okta_user_country", "OktaUserCountry"),
    ("okta_user_email", "OktaUserEmail"),
    ("okta_user_employee_number", "OktaUserEmployeeNumber"),
    ("okta_user_full_email", "OktaUserFullEmail"),
    ("okta_user_full_name", "OktaUserFullName"),
    ("okta_user_id", "OktaUserId"),
    ("okta_user_region", "OktaUserRegion"),
)
AUDIT_HEADCOUNT = (
    ("hc_business_unit", "HCBusinessUnit"),
    ("hc_business_unit_code", "HCBusinessUnitCode"),
    ("hc_division", "HCDivision"),
    ("hc_job_title", "HCJobTitle"),
    ("hc_office", "HCOffice"),
    ("hc_talent_segment", "HCTalentSegment"),
    ("hc_month_no", "HCMonthNo"),
    ("hc_okta_user_country", "HCOktaUserCountry"),
    ("hc_division_inc", "HCDivisionINC"),
)

# --- priority stream C ------------------------------------------------------------------------------------
PRIORITY_PREFIX = "codex_usage_"
PRIORITY_LOG_STAMP = ("codex_matching_log_reason", "codex_matching_log_loaded_at")

# --- headcount and identity -------------------------------------------------------------------------------
HEADCOUNT_SILVER = (
    ("Month_No", to_whole, "Month"),
    ("OktaUserEmployeeNumber", as_is, "Person ID"),
    ("HCEmployeeNumber", as_is, "Employee Code"),
    ("OktaUserFullName", as_is, "Fullname [Employee]"),
    ("HCRegion", as_is, "Region [Employee]"),
    ("_raw_country", as_is, "Country [Employee]"),
    ("HCOffice", as_is, "Office [Employee]"),
    ("HCBusinessUnit", as_is, "Business Unit [Employee]"),
    ("HCDivision", as_is, "Division [Employee]"),
    ("HCDepartment", as_is, "Department [Employee]"),
    ("HCLegalEntity", as_is, "Legal Entity [Employee]"),
    ("HCGridSubgroup", as_is, "Grid Subgroup [Employee]"),
    ("HCTalentSegment", as_is, "Talent Segment [Employee]"),
    ("HCJobTitle", as_is, "Job Title [Employee]"),
    ("OktaUserEmail", trim_lower, "Email [Employee]"),
    ("HCUserNetwork", as_is, "User Network [Employee]"),
    ("HCIncRoles", as_is, "Inc. Roles"),
    ("OktaUserRegion", as_is, "Okta Region"),
    ("HCDivisionINC", as_is, "Division INC"),
    ("HCTotalEmployees", to_whole, "Total Employees"),
    ("HCAreaEmeal", as_is, "Area Emeal"),
    ("HCKeyIdEmployeeCountry", as_is, "KeyIdEmployeeCountry"),
    ("HCBusinessUnitCode", as_is, "Business Unit Code [Employee]"),
    ("HCReplaceMapping", as_is, "Replace Mapping"),
)
IDENTITY_SILVER = (
    ("OktaUserId", as_is, "id"),
    ("OktaUserFullName", trimmed, "display_name"),
    ("OktaUserFirstName", trimmed, "first_name"),
    ("OktaUserLastName", trimmed, "last_name"),
    ("OktaUserEmail", trim_lower, "login"),
    ("OktaUserFullEmail", trim_lower, "email"),
    ("OktaUserEmployeeNumber", trimmed, "employee_number"),
    ("OktaUserRegion", trimmed, "region"),
    ("OktaUserOktaId", as_is, "okta_id"),
    ("OktaUserUpdatedAt", to_ts, "updated_at"),
    ("OktaUserDeletedAt", to_ts, "deleted_at"),
    ("_raw_country", trimmed, "country"),
    ("OktaUserTenant", trimmed, "okta_tenant"),
)

# --- notices and access -----------------------------------------------------------------------------------
ALERTS_SILVER = (
    ("dynamic_alerts_notification_id", trimmed, "NotificationID", "notification_id"),
    ("dynamic_alerts_notification_type", trimmed, "NotificationType", "notification_type"),
    ("dynamic_alerts_description", trimmed, "Description", "description"),
    ("dynamic_alerts_is_active", trimmed, "IsActive", "is_active"),
    ("dynamic_alerts_publication_date", parse_date, "PublicationDate", "publication_date"),
    ("dynamic_alerts_severity", trimmed, "Severity", "severity"),
    ("dynamic_alerts_execution_date", to_ts, "execution_date"),
)
ALERTS_GOLD = (
    ("NotificationID", as_is, "dynamic_alerts_notification_id"),
    ("NotificationType", as_is, "dynamic_alerts_notification_type"),
    ("Description", as_is, "dynamic_alerts_description"),
    ("IsActive", as_is, "dynamic_alerts_is_active"),
    ("PublicationDate", to_date, "dynamic_alerts_publication_date"),
    ("Severity", as_is, "dynamic_alerts_severity"),
)
SECURITY_SILVER = (
    ("security_email", trimmed, "Email", "email"),
    ("security_report", trimmed, "Report", "report"),
    ("security_access", trimmed, "Access", "access"),
    ("security_codigo", trimmed, "Codigo", "codigo"),
    ("security_conocido", trimmed, "Conocido", "conocido"),
    ("security_nombre_completo", trimmed, "Nombre Completo", "NombreCompleto", "nombre_completo"),
    ("security_pais", trimmed, "Pais", "pais"),
    ("security_job_title", trimmed, "Job Title", "JobTitle", "job_title"),
    ("security_ticket", trimmed, "Ticket", "ticket"),
    ("security_division", trimmed, "Division", "division"),
    ("security_access_scope", trimmed, "AccessScope", "access_scope"),
    ("security_execution_date", to_ts, "execution_date"),
)
SECURITY_GOLD = (
    ("email", as_is, "security_email"),
    ("report", as_is, "security_report"),
    ("access", as_is, "security_access"),
    ("division", as_is, "security_division"),
    ("access_scope", as_is, "security_access_scope"),
)

# --- reference tables -------------------------------------------------------------------------------------
AREA = (
    ("area_normalized_area_users", trimmed, "AreaUsers"),
    ("area_normalized_area_core", trimmed, "AreaCore"),
    ("area_normalized_division_inc", trimmed, "Division_INC"),
)
OWNER_EMAILS = (
    ("tcv_emails_op_co", trimmed, "opco", "op_co"),
    ("tcv_emails_opportunity_owner", trimmed, "opportunity_owner"),
    ("tcv_emails_owner_email", trimmed, "owner_email"),
)
COUNTRY_REGION = (
    ("tcv_countries_region_country", trimmed, "country"),
    ("tcv_countries_region_display_name", trimmed, "display_name"),
    ("tcv_countries_region_regioninc", trimmed, "regioninc"),
)
STAGE = (
    ("tcv_stage_normalized_stage", trimmed, "Stage", "normalized_stage"),
    ("tcv_stage_normalized_stage_Normalized", trimmed, "Stage Normalized"),
)
# The prefix of these columns is the caller's: see plans.reference.
BUSINESS_UNIT = (
    ("business_unit", trimmed, "Business Unit"),
    ("oneerp_code", trimmed, "oneerp_code"),
    ("execution_date", to_ts, "execution_date"),
)
AVERAGE_HOURS = (
    ("country_average_hours_country_normalized", trimmed, "Country Normalized"),
    ("country_average_hours_average_month_hours", to_decimal, "Average month hours"),
    ("country_average_hours_average_weekly_hours", to_decimal, "Average weekly hours"),
    ("country_average_hours_execution_date", to_ts, "execution_date"),
)
IDENTITY_COUNTRY = (
    ("normalization_countries_okta_country", trimmed, "Country"),
    ("normalization_countries_okta_normalization", trimmed, "Normalization"),
    ("normalization_countries_okta_execution_date", to_ts, "execution_date"),
)
CORE_COUNTRY_NAMES = (
    ("normalization_countries_core_id", trimmed, "id"),
    ("normalization_countries_core_display_name", trimmed, "display_name"),
    ("normalization_countries_core_normalized_country", trimmed, "Normalized country"),
    ("normalization_countries_core_execution_date", to_ts, "execution_date"),
)
OFFICE = (
    ("prl_office_locations_name", trimmed, "Nombre", "name"),
    ("prl_office_locations_oneerp_code", trimmed, "oneerp_code"),
    ("prl_office_locations_country", trimmed, "Country"),
    ("prl_office_locations_division", trimmed, "Division"),
    ("prl_office_locations_execution_date", to_ts, "execution_date"),
)

# --- core entities ----------------------------------------------------------------------------------------
CORE_ASSET = (
    ("asset_id", trimmed, "id"),
    ("asset_display_name", trimmed, "display_name"),
    ("asset_asset_code", trimmed, "asset_code"),
    ("asset_execution_date", to_ts, "execution_date"),
)
CORE_COUNTRY = (
    ("country_id", trimmed, "id"),
    ("country_execution_date", to_ts, "execution_date"),
)
CORE_BILLING = (
    ("core_billing_id", trimmed, "id"),
    ("core_billing_billing_type", trimmed, "billing_type"),
    ("core_billing_billing_identifier", trimmed, "billing_identifier"),
    ("core_billing_created_at", to_ts, "created_at"),
    ("core_billing_updated_at", to_ts, "updated_at"),
    ("core_billing_deleted_at", to_ts, "deleted_at"),
    ("core_billing_client_name", trimmed, "client_name"),
    ("core_billing_country_id", trimmed, "country_od", "country_id"),
    ("core_billing_tenant", trimmed, "tenant"),
    ("core_billing_region", trimmed, "region"),
    ("core_billing_execution_date", to_ts, "execution_date"),
)
CORE_PROJECT = (
    ("core_project_id", trimmed, "id"),
    ("core_project_display_name", trimmed, "display_name"),
    ("core_project_active", to_bool, "active"),
    ("core_project_create_at", to_ts, "create_at", "created_at"),
    ("core_project_updated_at", to_ts, "updated_at"),
    ("core_project_deleted_at", to_ts, "deleted_at"),
    ("core_project_billing_id", trimmed, "billing_id"),
    ("core_project_corporate", to_bool, "corporate"),
    ("core_project_tenant", trimmed, "tenant"),
    ("core_project_is_public", to_bool, "is_public"),
    ("core_project_execution_date", to_ts, "execution_date"),
)
CORE_IDENTITY = (
    ("okta_user_id", trimmed, "id"),
    ("okta_user_full_name", trimmed, "display_name"),
    ("okta_user_first_name", trimmed, "first_name"),
    ("okta_user_last_name", trimmed, "last_name"),
    ("okta_user_email", trim_lower, "login"),
    ("okta_user_full_email", trim_lower, "email"),
    ("okta_user_employee_number", trimmed, "employee_number"),
    ("okta_user_region", trimmed, "region"),
    ("okta_user_okta_id", trimmed, "okta_id"),
    ("okta_user_updated_at", to_ts, "updated_at"),
    ("okta_user_deleted_at", to_ts, "deleted_at"),
    ("okta_user_country", trimmed, "country"),
    ("okta_user_tenant", trimmed, "okta_tenant"),
    ("okta_user_execution_date", to_ts, "execution_date"),
)
DIM_PROJECT = (
    ("dim_project_project_id", as_is, "core_project_id"),
    ("dim_project_project_display_name", as_is, "core_project_display_name"),
    ("dim_project_active", as_is, "core_project_active"),
    ("dim_project_created_at", as_is, "core_project_create_at"),
    ("dim_project_updated_at", as_is, "core_project_updated_at"),
    ("dim_project_deleted_at", as_is, "core_project_deleted_at"),
    ("dim_project_billing_id", as_is, "core_project_billing_id"),
    ("dim_project_corporate", as_is, "core_project_corporate"),
    ("dim_project_tenant", as_is, "core_project_tenant"),
    ("dim_project_is_public", as_is, "core_project_is_public"),
    ("dim_project_billing_type", as_is, "core_billing_billing_type"),
    ("dim_project_billing_identifier", as_is, "core_billing_billing_identifier"),
    ("dim_project_client_name", as_is, "core_billing_client_name"),
    ("dim_project_billing_tenant", as_is, "core_billing_tenant"),
    ("dim_project_billing_region", as_is, "core_billing_region"),
    ("dim_project_country_id", as_is, "country_id"),
    ("dim_project_country", as_is, "country_display_name"),
)
_IMPLEMENTATION = "core_use_case_implementation_"
USE_CASE_IMPLEMENTATION = (
    (_IMPLEMENTATION + "use_case", trimmed, "use_case"),
    (_IMPLEMENTATION + "display_name", trimmed, "display_name"),
    (_IMPLEMENTATION + "description", trimmed, "description"),
    (_IMPLEMENTATION + "hours_saved", trimmed, "hours_saved"),
    (_IMPLEMENTATION + "automation", trimmed, "automation"),
    (_IMPLEMENTATION + "is_ai", to_bool, "is_ai"),
    (_IMPLEMENTATION + "enabled", to_bool, "enabled"),
    (_IMPLEMENTATION + "deleted_at", to_ts, "deleted_at"),
    (_IMPLEMENTATION + "month_year", trimmed, "month_year"),
    (_IMPLEMENTATION + "execution_date", to_ts, "execution_date"),
)
_ADJUSTMENT = "core_use_case_adjustment_"
USE_CASE_ADJUSTMENT = (
    (_ADJUSTMENT + "id", trimmed, "id"),
    (_ADJUSTMENT + "start_date", to_ts, "start_date"),
    (_ADJUSTMENT + "end_date", to_ts, "end_date"),
    (_ADJUSTMENT + "use_case", trimmed, "use_case"),
    (_ADJUSTMENT + "hours_saved", trimmed, "hours_saved"),
    (_ADJUSTMENT + "automation", trimmed, "automation"),
    (_ADJUSTMENT + "modified_by", trimmed, "modified_by"),
    (_ADJUSTMENT + "month_year", trimmed, "month_year"),
    (_ADJUSTMENT + "execution_date", to_ts, "execution_date"),
)

# --- facts ------------------------------------------------------------------------------------------------
# Columns of the two facts in order, with what fills them: a name from the daily rows, or nothing (NULL text).
ACTIVE_FACT = (
    ("Month_No", "month"),
    ("Request", "requests"),
    ("assetId", "asset_id"),
    ("assetName", "asset_name"),
    ("eventType", None),
    ("id_project", None),
    ("project", None),
    ("account", None),
    ("userId", "user_id"),
    ("username", "full_name"),
    ("employeeid", "employee_number"),
    ("userEmail", "email"),
    ("userFullEmail", "full_email"),
    ("Division", "region"),
    ("userCountry", "country"),
    ("useCaseCode", "use_case_code"),
    ("useCaseDisplayName", "use_case_name"),
    ("UseCaseHoursSaved", "hours_saved"),
    ("UseCaseTotalHours", "hours_total"),
    ("UserWithActivity", "active_users"),
    ("LastModification", "day"),
    ("User_UN", "business_unit"),
    ("JobRoles", "job_title"),
    ("Employee_Country", "headcount_country"),
    ("Employee_Office", "office"),
    ("Segment", "talent_segment"),
    ("Foundation", "division"),
    ("Employee_Business_Unit_Code", "business_unit_code"),
    ("asset_model", None),
    ("asset_useCase", None),
    ("asset_mySourceType", None),
    ("asset_sourceType", None),
    ("billingClientName", None),
    ("billingCountry", None),
    ("billingRegion", None),
    ("flowid", None),
    ("useCaseMultiplier", "multiplier"),
    ("automation_poc", "automation"),
    ("totalHoursSaved_poc", "hours"),
    (ACTIVE_KEY, "key"),
)
# Columns that must be present. The keys must be too, but they never are NULL, and asking would make every silver
# row compute its key.
ACTIVE_FACT_REQUIRED = (
    "Month_No",
    "Request",
    "assetId",
    "assetName",
    "useCaseCode",
    "useCaseDisplayName",
    "UseCaseHoursSaved",
    "UseCaseTotalHours",
    "UserWithActivity",
    "LastModification",
    "useCaseMultiplier",
    "automation_poc",
    "totalHoursSaved_poc",
)
ONBOARD_FACT = (
    ("account", None),
    ("projectid", None),
    ("projectName", None),
    ("username", "full_name"),
    ("userNumberEmployee", "employee_number"),
    ("userEmail", "email"),
    ("userFullEmail", "full_email"),
    ("userRegion", "region"),
    ("userCountry", "country"),
    ("LastModification", "day"),
    ("Employee_Business_Unit", "business_unit"),
    ("Job_Roles", "job_title"),
    ("Employee_Country", "country"),
    ("Employee_Office", "office"),
    ("Employee_Segment", "talent_segment"),
    ("Foundation", "division"),
    ("Employee_Business_Unit_Code", "business_unit_code"),
    ("billingClientName", None),
    ("billingCountry", None),
    ("billingRegion", None),
    (ONBOARD_KEY, "key"),
)
ONBOARD_FACT_REQUIRED = ("userEmail", "userFullEmail", "LastModification")
# Where the facts find their values: stream -> {name used above: silver column}.
FACT_SOURCES = {
    "usage": {
        "day": "CursorUsageDate",
        "month": "CursorUsageMonthNo",
        "user_id": "OktaUserId",
        "full_name": "OktaUserFullName",
        "employee_number": "OktaUserEmployeeNumber",
        "email": "OktaUserEmail",
        "full_email": "OktaUserFullEmail",
        "region": "OktaUserRegion",
        "country": "OktaUserCountry",
        "business_unit": "HCBusinessUnit",
        "job_title": "HCJobTitle",
        "headcount_country": "HCOktaUserCountry",
        "office": "HCOffice",
        "talent_segment": "HCTalentSegment",
        "division": "HCDivision",
        "business_unit_code": "HCBusinessUnitCode",
        "ingestion": "CursorUsageIngestionDate",
        "record_key": ACTIVE_KEY,
    },
    "audit": {
        "day": "purview_copilot_usage_date",
        "month": "purview_copilot_usage_month_no",
        "user_id": "okta_user_id",
        "full_name": "okta_user_full_name",
        "employee_number": "okta_user_employee_number",
        "email": "okta_user_email",
        "full_email": "okta_user_full_email",
        "region": "okta_user_region",
        "country": "okta_user_country",
        "business_unit": "hc_business_unit",
        "job_title": "hc_job_title",
        "headcount_country": "hc_okta_user_country",
        "office": "hc_office",
        "talent_segment": "hc_talent_segment",
        "division": "hc_division",
        "business_unit_code": "hc_business_unit_code",
        "ingestion": "purview_copilot_usage_ingestion_date",
        "record_key": "purview_copilot_usage_record_id",
        "kind": "purview_copilot_usage_interaction_type",
        "prompts": "purview_copilot_usage_prompt_count",
    },
}
# Constants of the facts.
USAGE_ASSET = ("PENDING", "Cursor")
USAGE_USE_CASE = ("UC-9006-CURS-001", "Active")
USAGE_AUTOMATION = "1"
USAGE_HOURS = "0"
AUDIT_ASSET = ("PENDING", "M365 Copilot")
MULTIPLIER = "1"
