"""Silver table of audit stream B: JSON audit records with the person and headcount they belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiercraft.context import RunContext
from tiercraft.functions import audit_json as payloads
from tiercraft.functions.columns import Headers, quoted, to_ts, to_whole, trim_lower
from tiercraft.functions.dates import month_no, parse_timestamp
from tiercraft.functions.email import strip_prefix10, valid_email
from tiercraft.functions.interactions import Interactions
from tiercraft.functions.keys import joined_key
from tiercraft.operators.attach import Side, attach, settled
from tiercraft.operators.dedupe import keep_one
from tiercraft.operators.enrich import headcount_of_people
from tiercraft.operators.filters import from_date, from_files, only_month, scan_predicate, through_month, without_months
from tiercraft.operators.matching import Split, fallback_links, known_addresses, outcomes
from tiercraft.operators.quality import Figures
from tiercraft.plans.layouts import (
    AUDIT_HEADCOUNT,
    AUDIT_PERSON,
    AUDIT_PREFIX,
    AUDIT_RECORD,
    AUDIT_REJECT_STAMP,
    AUDIT_REQUIRED,
    AUDIT_SILVER,
)
from tiercraft.plans.usage import stamped

EMAIL = AUDIT_PREFIX + "email"
FALLBACK = AUDIT_PREFIX + "email_fallback"
MONTH = AUDIT_PREFIX + "month_no"
RECORD_ID = AUDIT_PREFIX + "record_id"


def audit_scan_predicate(run: RunContext, bronze: DataFrame) -> Column | None:
    """Filter for the raw scan, on the header the table has: the closing month, or else the run's earliest date.

    Dates as text may have spaces before them, which the parser trims, so such rows pass here.
    """
    header = Headers(bronze.columns).find("CreationDate", "creation_date")
    if header is None:
        return None
    if run.close_month is not None:
        year, month = divmod(run.close_month, 100)
        test = scan_predicate(header, month=f"{year}-{month:02d}")
    else:
        test = scan_predicate(header, min_date=run.first_day)
    return test | quoted(header).startswith(" ") if dict(bronze.dtypes)[header] == "string" else test


def audit_fields(bronze: DataFrame, interactions: Interactions) -> DataFrame:
    """Every bronze row with its payload flattened to columns; arrays appear as counts and flags."""
    headers = Headers(bronze.columns)
    text = headers.column("AuditData", "audit_data")
    file_name = headers.column_or_null("FileName", "file_name")
    ingestion = to_ts(
        headers.column_or_null(
            "ExecutionDate", "execution_date", "IngestionDate", "ingestion_date", dtype="timestamp"
        )
    )
    day = parse_timestamp(headers.column("CreationDate", "creation_date")).cast("date")
    raw = bronze.select(
        headers.column("RecordId", "record_id").alias("record_id"),
        day.alias("date"),
        to_whole(headers.column("RecordType", "record_type")).alias("record_type"),
        headers.column("Operation", "operation").alias("operation"),
        headers.column("UserId", "user_id").alias("user_id"),
        headers.column("AssociatedAdminUnits", "associated_admin_units").alias("associated_admin_units"),
        headers.column("AssociatedAdminUnitsNames", "associated_admin_units_names").alias(
            "associated_admin_units_names"
        ),
        file_name.alias("file_name"),
        ingestion.alias("ingestion_date"),
        payloads.payload(text).alias("payload"),
        payloads.first_model_field(text, "ModelName").alias("model_name"),
        payloads.first_model_field(text, "ModelProviderName").alias("model_provider_name"),
    )
    parsed = F.col("payload")
    arrays = raw.withColumns(
        {
            "messages": payloads.messages(parsed),
            "plugins": payloads.plugins(parsed),
            "resources": payloads.resources(parsed),
        }
    )
    derived = {
        "email": trim_lower(F.col("user_id")),
        "email_fallback": strip_prefix10(trim_lower(F.col("user_id"))),
        "app_identity": parsed["AppIdentity"],
        "application_name": parsed["ApplicationName"],
        "app_host": payloads.event_field(parsed, "AppHost"),
        "agent_name": parsed["AgentName"],
        "target_agent_name": payloads.event_field(parsed, "TargetAgentName"),
        "license_type": payloads.event_field(parsed, "LicenseType"),
        "conversation_id": payloads.event_field(parsed, "ConversationId"),
        "thread_id": payloads.event_field(parsed, "ThreadId"),
        "copilot_log_version": parsed["CopilotLogVersion"],
        "has_prompt": payloads.prompt_count(F.col("messages")) > 0,
        "interaction_type": interactions.kind(parsed["AppIdentity"], parsed["AgentName"]),
        "has_model_info": F.col("model_name").isNotNull() | F.col("model_provider_name").isNotNull(),
        "has_resource_access": payloads.size_or_zero(F.col("resources")) > 0,
        "message_count": payloads.size_or_zero(F.col("messages")),
        "prompt_count": payloads.prompt_count(F.col("messages")),
        "jailbreak_detected": payloads.any_jailbreak(F.col("messages")),
        "plugin_count": payloads.size_or_zero(F.col("plugins")),
        "uses_bing_web_search": payloads.any_web_search(F.col("plugins")),
        "accessed_resource_count": payloads.size_or_zero(F.col("resources")),
        "month_no": month_no(F.col("date")),
    }
    return arrays.select(*[derived.get(name, F.col(name)).alias(AUDIT_PREFIX + name) for name, _ in AUDIT_RECORD])


def audit_base(bronze: DataFrame, run: RunContext, files: tuple[str, ...] = ()) -> DataFrame:
    """One parsed row per record id: valid address, from the run's earliest date on, in the run's months.

    All filters come before the one shuffle that removes repeated records. Of several rows of a record that are
    in scope the last ingested one stays.
    """
    headers = Headers(bronze.columns)
    file_column = headers.find("FileName", "file_name")
    rows = bronze if file_column is None else from_files(bronze, file_column, files)
    rows = rows.filter(valid_email(headers.column("UserId", "user_id")))
    rows = from_date(audit_fields(rows, run.interactions), AUDIT_PREFIX + "date", run.first_day)
    rows = through_month(only_month(rows, MONTH, run.close_month), AUDIT_PREFIX + "date", run.close_month)
    rows = without_months(rows, MONTH, run.months_to_skip)
    newest = [quoted(AUDIT_PREFIX + name).desc_nulls_last() for name in ("ingestion_date", "date")]
    return keep_one(rows, [quoted(RECORD_ID)], newest)


def audit_people(base: DataFrame, identity: DataFrame, headcount: DataFrame, run: RunContext) -> Side:
    """For every (month, address) in use that leads to a person: the person, with that month's headcount."""
    seen = base.select(MONTH, EMAIL, FALLBACK).distinct()
    identity = through_month(identity, "OktaUserUpdatedAt", run.close_month)
    people = fallback_links(seen, identity, EMAIL, FALLBACK)
    people = headcount_of_people(
        people, only_month(headcount, "Month_No", run.close_month), MONTH, "OktaUserEmail", "OktaUserFullEmail"
    )
    return settled(people.drop(FALLBACK))


def audit_outcomes(
    bronze: DataFrame, identity: DataFrame, run: RunContext, files: tuple[str, ...] = (), seen: Figures | None = None
) -> Split:
    """Parsed records that lead to a person, and the others, from one parse of the payloads."""
    known = known_addresses(through_month(identity, "OktaUserUpdatedAt", run.close_month), with_id=True)
    return outcomes(audit_base(bronze, run, files), known, [EMAIL, FALLBACK], "audit-base", seen)


def audit_split(rows: Split, identity: DataFrame, headcount: DataFrame, run: RunContext) -> Split:
    """Parsed records with their person and headcount, and the stamped records without a person."""
    people = audit_people(rows.matched, identity, headcount, run)
    joined = attach(rows.matched, people, [MONTH, EMAIL], "inner")
    keys = {
        AUDIT_PREFIX + "key_email": joined_key(quoted(MONTH), quoted("OktaUserEmail")),
        AUDIT_PREFIX + "key_full_email": joined_key(quoted(MONTH), quoted("OktaUserFullEmail")),
    }
    matched = joined.select(
        *[AUDIT_PREFIX + name for name in AUDIT_SILVER],
        *[F.col(source).alias(name) for name, source in AUDIT_PERSON],
        *[value.alias(name) for name, value in keys.items()],
        *[quoted(source).alias(name) for name, source in AUDIT_HEADCOUNT],
    )
    (reason, _), (loaded_at, _) = AUDIT_REJECT_STAMP
    return Split(matched, stamped(rows.rejects, run, reason, loaded_at))


def audit_silver(
    bronze: DataFrame, identity: DataFrame, headcount: DataFrame, run: RunContext, files: tuple[str, ...] = ()
) -> Split:
    return audit_split(audit_outcomes(bronze, identity, run, files), identity, headcount, run)


def reject_ddl() -> str:
    """Column list of the reject table."""
    required = {AUDIT_PREFIX + name for name in AUDIT_REQUIRED} | {name for name, _ in AUDIT_REJECT_STAMP}
    columns = [(AUDIT_PREFIX + name, kind) for name, kind in AUDIT_RECORD] + list(AUDIT_REJECT_STAMP)
    return ", ".join(f"{name} {kind}{' NOT NULL' if name in required else ''}" for name, kind in columns)
