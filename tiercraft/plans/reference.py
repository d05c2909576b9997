"""Silver reference tables: one cleaning projection each, three of them with one row per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tiercraft.functions.columns import project, quoted
from tiercraft.operators.dedupe import keep_one
from tiercraft.plans import layouts


def plain(layout: tuple) -> Callable[[DataFrame], DataFrame]:
    return lambda bronze: project(bronze, layout)


def one_per(layout: tuple, key: str, newest: str) -> Callable[[DataFrame], DataFrame]:
    """One row per key, the last loaded one."""
    return lambda bronze: keep_one(project(bronze, layout), [quoted(key)], [quoted(newest).desc_nulls_last()])


def business_unit(bronze: DataFrame, prefix: str = "business_unit_") -> DataFrame:
    """``prefix`` is what the deployment's consumers expect in front of the column names."""
    return project(bronze, [(prefix + name, *rest) for name, *rest in layouts.BUSINESS_UNIT])


area = plain(layouts.AREA)
owner_emails = plain(layouts.OWNER_EMAILS)
country_region = plain(layouts.COUNTRY_REGION)
stage_names = plain(layouts.STAGE)
average_hours = one_per(
    layouts.AVERAGE_HOURS, "country_average_hours_country_normalized", "country_average_hours_execution_date"
)
identity_countries = one_per(
    layouts.IDENTITY_COUNTRY,
    "normalization_countries_okta_country",
    "normalization_countries_okta_execution_date",
)
core_countries = plain(layouts.CORE_COUNTRY_NAMES)
offices = plain(layouts.OFFICE)

# Bronze table -> (silver table, plan). The names are fixed values of the data model.
REFERENCE_TABLES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "area_normalized": ("area_normalized", area),
    "tcv_emails": ("tcv_emails", owner_emails),
    "tcv_countries_region": ("tcv_countries_region", country_region),
    "tcv_stage_normalized": ("tcv_stage_normalized", stage_names),
    "business_unit": ("business_unit", business_unit),
    "country_average_hours": ("country_average_hours", average_hours),
    "normalization_countries_okta": ("normalization_countries_okta", identity_countries),
    "normalization_countries_core": ("normalization_countries_core", core_countries),
    "prl_office_locations": ("prl_office_locations", offices),
}
