"""Registration of queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tiercraft.context import RunContext
from tiercraft.functions.interactions import Factors, Interactions, KindRule
from tiercraft.operators.enrich import load_lookup
from tiercraft.plans import dimensions
from tiercraft.workload.adapters import EXCLUDED, Bronze
from tiercraft.workload.expected import compose

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}
# Kinds of interaction of the derived tables.
INTERACTIONS = Interactions(
    rules=(
        KindRule("Report", "app", ["suite.data."], prefix=True),
        KindRule("Studio agent", "app", ["suite.studio."], prefix=True),
        KindRule("Named agent", "agent", ["Analyst", "Researcher"]),
        KindRule("Built-in agent", "app", ["suiteagent."], prefix=True),
        KindRule("Chat", "app", ["suite.chat.web", "suite.chat.firm"]),
        KindRule("Office", "app", ["suite.office"]),
    ),
    factors={
        "Chat": Factors("CASE-1", "0.75", "0.083333"),
        "Office": Factors("CASE-2", "0.625", "0.8"),
        "Built-in agent": Factors("CASE-3", "1.00", "1.2"),
        "Studio agent": Factors("CASE-4", "1.00", "1.3"),
        "Named agent": Factors("CASE-5", "1.00", "1.4"),
        "Report": Factors("CASE-6", "0.75", "2.5"),
        "Other": Factors("CASE-7", "0.625", "1.7"),
    },
)
# The run every query is part of: daily, nothing closed, all of 2024 on.
RUN = RunContext(min_date="2024-01-01", interactions=INTERACTIONS)


def query(name: str, check: str | None = None) -> Callable[[Callable[[Bronze], DataFrame]], Callable]:
    """Register a query under its inventory key, with the SQL that gives the same rows."""

    def register(build: Callable[[Bronze], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, folder: build(Bronze(spark, folder))
        if check is not None:
            CHECKS[name] = compose(check)
        return build

    return register


def countries(bronze: Bronze) -> DataFrame:
    return load_lookup(bronze.table("countries"))


def identity(bronze: Bronze) -> DataFrame:
    return dimensions.identity_silver(bronze.table("identity"), countries(bronze), RUN, EXCLUDED)


def headcount(bronze: Bronze) -> DataFrame:
    return dimensions.headcount_silver(bronze.table("headcount"), countries(bronze), RUN)
