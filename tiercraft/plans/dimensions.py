"""Silver dimensions: monthly headcount and identities."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tiercraft.context import RunContext
from tiercraft.functions.columns import Headers, project, quoted
from tiercraft.functions.dates import month_start
from tiercraft.functions.email import valid_email
from tiercraft.functions.keys import joined_key
from tiercraft.operators.enrich import NO_COUNTRY, lookup_normalize
from tiercraft.operators.filters import only_month, outside, required, through_month
from tiercraft.plans.layouts import HEADCOUNT_SILVER, IDENTITY_SILVER

_RAW_COUNTRY = "_raw_country"


@dataclass(frozen=True)
class Exclusions:
    """Regions and tenants whose identities are left out, as the deployment names them."""

    regions: Iterable[str] = ()
    tenants: Iterable[str] = ()


def headcount_silver(bronze: DataFrame, countries: DataFrame, run: RunContext) -> DataFrame:
    """Headcount rows with a month, an address and a division (a row without a division is dropped)."""
    rows = project(bronze, HEADCOUNT_SILVER)
    rows = lookup_normalize(rows, _RAW_COUNTRY, countries, "OktaUserCountry", NO_COUNTRY).drop(_RAW_COUNTRY)
    rows = rows.withColumns(
        {
            "HCDate": month_start(quoted("Month_No")),
            "HCKeyDivision": joined_key(quoted("HCDivisionINC"), quoted("OktaUserCountry")),
            "HCKeyEmail": joined_key(quoted("Month_No"), quoted("OktaUserEmail")),
        }
    )
    rows = required(rows, "Month_No", "OktaUserEmail", "HCDate", "HCKeyDivision", "HCKeyEmail")
    return only_month(rows, "Month_No", run.close_month)


def identity_silver(bronze: DataFrame, countries: DataFrame, run: RunContext, without: Exclusions) -> DataFrame:
    """Identities with an id and two valid addresses, in a region and tenant that are not excluded."""
    rows = project(through_month(bronze, Headers(bronze.columns).find("updated_at") or "updated_at", run.close_month), IDENTITY_SILVER)
    rows = rows.filter(
        quoted("OktaUserId").isNotNull()
        & valid_email(quoted("OktaUserEmail"))
        & valid_email(quoted("OktaUserFullEmail"))
        & outside(quoted("OktaUserRegion"), quoted("OktaUserTenant"), without.regions, without.tenants)
    )
    return lookup_normalize(rows, _RAW_COUNTRY, countries, "OktaUserCountry", NO_COUNTRY).drop(_RAW_COUNTRY)
