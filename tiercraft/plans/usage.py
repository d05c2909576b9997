"""Silver table of usage stream A: raw usage rows with the person and headcount they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercraft.context import RunContext
from tiercraft.functions.columns import Headers, project, quoted
from tiercraft.functions.dates import month_no
from tiercraft.functions.email import valid_email
from tiercraft.functions.keys import joined_key, surrogate_key
from tiercraft.operators.attach import Side, attach, settled
from tiercraft.operators.enrich import headcount_of_people
from tiercraft.operators.filters import from_files, only_month, through_month, without_months
from tiercraft.operators.matching import Split, either_links, known_addresses, outcomes
from tiercraft.operators.quality import Figures
from tiercraft.plans.layouts import ACTIVE_KEY, REJECT_REASON, USAGE, USAGE_KEY_PARTS

USER = "CursorUsageUser"
MONTH = "CursorUsageMonthNo"
_ON = ["_month", USER]


def usage_base(bronze: DataFrame, run: RunContext, files: tuple[str, ...] = ()) -> DataFrame:
    """Typed usage rows of valid addresses in the run's months."""
    headers = Headers(bronze.columns)
    rows = from_files(bronze, headers.find("FileName", "file_name") or "FileName", files)
    rows = through_month(rows, headers.find("Date") or "Date", run.close_month)
    rows = project(rows.filter(valid_email(headers.column("User"))), USAGE)
    rows = rows.withColumn(MONTH, month_no(quoted("CursorUsageDate")))
    rows = through_month(only_month(rows, MONTH, run.close_month), "CursorUsageDate", run.close_month)
    return without_months(rows, MONTH, run.months_to_skip)


def usage_people(base: DataFrame, identity: DataFrame, headcount: DataFrame, run: RunContext) -> Side:
    """For every (month, address) in use: the people that have the address, with that month's headcount."""
    seen = base.select(MONTH, USER).distinct()
    identity = through_month(identity, "OktaUserUpdatedAt", run.close_month)
    people = either_links(seen, identity, USER).withColumns(
        {
            "CursorUsageKeyEmail": joined_key(quoted(MONTH), quoted("OktaUserEmail")),
            "CursorUsageKeyFullEmail": joined_key(quoted(MONTH), quoted("OktaUserFullEmail")),
        }
    )
    people = headcount_of_people(
        people, only_month(headcount, "Month_No", run.close_month), MONTH, "OktaUserEmail", "OktaUserFullEmail"
    )
    return settled(_keyed(people).drop(MONTH))


def usage_silver(
    bronze: DataFrame, identity: DataFrame, headcount: DataFrame, run: RunContext, files: tuple[str, ...] = ()
) -> Split:
    """Distinct usage rows x the people that have their address, and the rows whose address nobody has."""
    return usage_split(usage_outcomes(bronze, identity, run, files), identity, headcount, run)


def usage_outcomes(
    bronze: DataFrame, identity: DataFrame, run: RunContext, files: tuple[str, ...] = (), seen: Figures | None = None
) -> Split:
    """Typed rows whose address somebody has, and the others, from one read of the bronze rows."""
    known = known_addresses(through_month(identity, "OktaUserUpdatedAt", run.close_month))
    return outcomes(usage_base(bronze, run, files), known, [USER], "usage-base", seen)


def usage_split(rows: Split, identity: DataFrame, headcount: DataFrame, run: RunContext) -> Split:
    """The silver rows of typed rows with a person, and the stamped rejects; the rows take part in one join."""
    people = usage_people(rows.matched, identity, headcount, run)
    matched = attach(_keyed(rows.matched.distinct()), people, _ON, "inner").drop("_month")
    matched = matched.withColumn(ACTIVE_KEY, surrogate_key(matched, *USAGE_KEY_PARTS))
    return Split(matched, stamped(rows.rejects, run))


def stamped(
    rejects: DataFrame, run: RunContext, reason: str = "OktaRejectReason", loaded_at: str = "OktaRejectLoadedAt"
) -> DataFrame:
    """Rejects with the reason and the load time."""
    load_time = F.current_timestamp() if run.load_ts is None else F.lit(run.load_ts).cast("timestamp")
    return rejects.withColumns({reason: F.lit(REJECT_REASON), loaded_at: load_time})


def _keyed(df: DataFrame) -> DataFrame:
    # A usage row without a date has no month but is matched all the same.
    return df.withColumn("_month", F.coalesce(quoted(MONTH), F.lit(0)))
