"""Silver core entities and the project dimension built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tiercraft.functions.columns import nonempty, project, quoted
from tiercraft.operators.attach import attach, settled
from tiercraft.operators.dedupe import keep_one
from tiercraft.operators.enrich import NO_COUNTRY, lookup_normalize, trimmed_lookup
from tiercraft.operators.filters import outside
from tiercraft.plans import layouts
from tiercraft.plans.dimensions import Exclusions


def _with_ids(bronze: DataFrame, layout: tuple, *ids: str) -> DataFrame:
    rows = project(bronze, layout)
    for name in ids:
        rows = rows.filter(nonempty(quoted(name)))
    return rows


def core_asset(bronze: DataFrame) -> DataFrame:
    return _with_ids(bronze, layouts.CORE_ASSET, "asset_id")


def core_country(bronze: DataFrame, names: DataFrame) -> DataFrame:
    """One row per country, the last loaded one, with its normalised name (NULL if it has none)."""
    rows = _with_ids(bronze, layouts.CORE_COUNTRY, "country_id")
    rows = keep_one(rows, [quoted("country_id")], [quoted("country_execution_date").desc_nulls_last()])
    lookup = trimmed_lookup(names, "normalization_countries_core_id", "normalization_countries_core_normalized_country")
    rows = lookup_normalize(rows, "country_id", lookup, "country_display_name")
    return rows.select("country_id", "country_display_name", "country_execution_date")


def core_billing(bronze: DataFrame) -> DataFrame:
    return _with_ids(bronze, layouts.CORE_BILLING, "core_billing_id")


def core_project(bronze: DataFrame) -> DataFrame:
    return _with_ids(bronze, layouts.CORE_PROJECT, "core_project_id", "core_project_billing_id")


def core_identity(bronze: DataFrame, countries: DataFrame, without: Exclusions) -> DataFrame:
    rows = _with_ids(bronze, layouts.CORE_IDENTITY, "okta_user_id")
    rows = rows.filter(
        outside(quoted("okta_user_region"), quoted("okta_user_tenant"), without.regions, without.tenants)
    )
    lookup = trimmed_lookup(
        countries, "normalization_countries_okta_country", "normalization_countries_okta_normalization"
    )
    named = lookup_normalize(
        rows.withColumn("_country", quoted("okta_user_country")), "_country", lookup, "okta_user_country", NO_COUNTRY
    )
    return named.select(*[out for out, *_ in layouts.CORE_IDENTITY])


def dim_project(projects: DataFrame, billings: DataFrame, countries: DataFrame) -> DataFrame:
    """Projects with their billing and the billing's country.

    Countries are joined to billings first, so the projects, the largest table, take part in one join. Of several
    rows for one billing id the last updated one counts.
    """
    newest = [quoted(f"core_billing_{name}").desc_nulls_last() for name in ("updated_at", "execution_date")]
    accounts = keep_one(billings, [quoted("core_billing_id")], newest).select(
        quoted("core_billing_id").alias("core_project_billing_id"),
        "core_billing_billing_type",
        "core_billing_billing_identifier",
        "core_billing_client_name",
        "core_billing_tenant",
        "core_billing_region",
        "core_billing_country_id",
    )
    places = countries.select(
        quoted("country_id").alias("core_billing_country_id"), "country_id", "country_display_name"
    )
    accounts = attach(accounts, settled(places), ["core_billing_country_id"])
    return project(attach(projects, settled(accounts), ["core_project_billing_id"]), layouts.DIM_PROJECT)


def use_case_implementation(bronze: DataFrame) -> DataFrame:
    return _with_ids(bronze, layouts.USE_CASE_IMPLEMENTATION, "core_use_case_implementation_use_case")


def use_case_adjustment(bronze: DataFrame) -> DataFrame:
    return _with_ids(bronze, layouts.USE_CASE_ADJUSTMENT, "core_use_case_adjustment_id")
