"""Silver table and match log of stream C, whose rows have an address and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tiercraft.context import RunContext
from tiercraft.functions.columns import Headers, quoted, trim_lower
from tiercraft.functions.email import email_variants
from tiercraft.operators.dedupe import keep_one
from tiercraft.operators.matching import Split, match_priority, split_matched
from tiercraft.plans.layouts import PRIORITY_LOG_STAMP, PRIORITY_PREFIX
from tiercraft.plans.usage import stamped

RECORD_ID = PRIORITY_PREFIX + "record_id"
ADDRESS = PRIORITY_PREFIX + "email_normalized"
# The identity columns of stream C, in their order.
PRIORITY_PERSON = (
    "okta_user_id",
    "okta_user_country",
    "okta_user_email",
    "okta_user_employee_number",
    "okta_user_full_email",
    "okta_user_full_name",
    "okta_user_region",
)


def priority_base(bronze: DataFrame) -> DataFrame:
    """One row per record id with the spellings of its address; of several addresses the first in order."""
    headers = Headers(bronze.columns)
    record_id = headers.column("id", "record_id", "usage_id").alias(RECORD_ID)
    address = trim_lower(headers.column("source_email")).alias(ADDRESS)
    rows = keep_one(bronze.select(record_id, address), [quoted(RECORD_ID)], [quoted(ADDRESS).asc_nulls_last()])
    variants = email_variants(quoted(ADDRESS))
    return rows.select(
        quoted(RECORD_ID), *[value.alias(f"{PRIORITY_PREFIX}email_{name}") for name, value in variants.items()]
    )


def priority_joined(bronze: DataFrame, identity: DataFrame) -> DataFrame:
    """Every record with the person of the best match, or none."""
    base = priority_base(bronze)
    return match_priority(base, identity, ADDRESS, RECORD_ID).select(*base.columns, *PRIORITY_PERSON)


def priority_split(joined: DataFrame, run: RunContext) -> Split:
    """The silver table and the match log of the joined records."""
    matched, rejects = split_matched(joined, "okta_user_id")
    return Split(matched, stamped(rejects, run, *PRIORITY_LOG_STAMP))


def priority_silver(bronze: DataFrame, identity: DataFrame, run: RunContext) -> Split:
    return priority_split(priority_joined(bronze, identity), run)
