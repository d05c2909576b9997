"""Whole tables on small inputs: the hand-checked audit case, month close, freezing, rejects."""

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from rows import rows
from pyspark.sql import functions as F

from tiercraft.context import RunContext
from tiercraft.workload.registry import INTERACTIONS
from tiercraft.plans import audit, core, dimensions, facts, notices, priority, reference, runs, usage
from tiercraft.plans.dimensions import Exclusions
from tiercraft.sources.scan import empty_table

LOADED = datetime(2026, 10, 1)
RUN = RunContext(min_date="2026-09-01", load_ts=LOADED, interactions=INTERACTIONS)
IDENTITY = (
    "OktaUserId string, OktaUserEmail string, OktaUserFullEmail string, OktaUserEmployeeNumber string, "
    "OktaUserFullName string, OktaUserRegion string, OktaUserCountry string, OktaUserUpdatedAt timestamp"
)
HEADCOUNT = (
    "Month_No int, OktaUserEmail string, OktaUserEmployeeNumber string, HCBusinessUnit string, HCBusinessUnitCode string, "
    "HCDivision string, HCJobTitle string, HCOffice string, HCTalentSegment string, OktaUserCountry string, "
    "HCDivisionINC string"
)
AUDIT = (
    "RecordId string, CreationDate string, UserId string, AuditData string, RecordType string, Operation string, "
    "AssociatedAdminUnits string, AssociatedAdminUnitsNames string, ExecutionDate string"
)


def audit_row(record, day, user, app, prompts=1, loaded="2026-09-20 00:00:00"):
    messages = ",".join(['{"isPrompt":true}'] * prompts)
    text = f'{{"AppIdentity":"{app}","CopilotEventData":{{"Messages":[{messages}]}}}}'
    return (record, f"{day}T10:00:00", user, text, None, None, None, None, loaded)


CHAT, APPS = "suite.chat.web", "suite.office"
GOLDEN = [
    audit_row("r1", "2026-09-15", "10jane.doe@corp.com", CHAT),
    audit_row("r2", "2026-09-16", "bob.smith@corp.com", APPS),
    audit_row("r3", "2026-09-17", "10no.okta@corp.com", CHAT),
]


@pytest.fixture
def identity(spark):
    old = datetime(2026, 1, 1)
    people = [
        ("okta-jane", "jane.doe@corp.com", "jane.doe@corp.com", "E1", "Jane Doe", "EMEA", "MA", old),
        ("okta-bob", "bob.smith@corp.com", "bob.smith@corp.com", "E2", "Bob Smith", "EMEA", "MA", old),
        ("okta-new", "new@corp.com", "new@corp.com", "E3", "New Hire", "EMEA", "MA", datetime(2026, 10, 5)),
    ]
    return spark.createDataFrame(people, IDENTITY)


@pytest.fixture
def headcount(spark):
    row = (202609, "bob.smith@corp.com", "E2", "BU", "B1", "Div", "Dev", "HQ", "T", "Morocco", None)
    return spark.createDataFrame([row], HEADCOUNT)


def test_hand_checked_audit_case(spark, identity):
    bronze = spark.createDataFrame(GOLDEN, AUDIT)
    split = audit.audit_silver(bronze, identity, empty_table(spark, HEADCOUNT), RUN)
    p = "purview_copilot_usage_"
    assert rows(split.matched, p + "email", p + "email_fallback", "okta_user_id", "okta_user_email", p + "prompt_count") == [
        ("10jane.doe@corp.com", "jane.doe@corp.com", "okta-jane", "jane.doe@corp.com", 1),
        ("bob.smith@corp.com", None, "okta-bob", "bob.smith@corp.com", 1),
    ]
    assert rows(split.rejects, p + "record_id", p + "email_fallback", "okta_reject_reason") == [
        ("r3", "no.okta@corp.com", "okta_join_miss")
    ]
    assert len(split.matched.columns) == 50 and len(split.rejects.columns) == 34
    fact = facts.audit_active_fact(split.matched, RUN)
    assert rows(fact, "userId", "userEmail", "userFullEmail", "Request", "LastModification", "useCaseDisplayName") == [
        ("okta-bob", "bob.smith@corp.com", "bob.smith@corp.com", 1, date(2026, 9, 16), "Office"),
        ("okta-jane", "jane.doe@corp.com", "jane.doe@corp.com", 1, date(2026, 9, 15), "Chat"),
    ]
    assert len(fact.columns) == 40
    assert len(facts.onboard_fact(split.matched, "audit", RUN).columns) == 21


def test_audit_base_filters_then_keeps_the_last_ingested(spark):
    data = [
        audit_row("a", "2026-09-02", "x@y.z", CHAT, 1, "2026-09-03 00:00:00"),
        audit_row("a", "2026-09-02", "x@y.z", CHAT, 2, "2026-09-04 00:00:00"),
        audit_row("b", "2026-08-31", "x@y.z", CHAT),
        audit_row("c", "2026-09-02", "no address", CHAT),
        audit_row("d", "2026-10-02", "x@y.z", CHAT),
    ]
    bronze = spark.createDataFrame(data, AUDIT)
    got = [r[0] for r in rows(audit.audit_base(bronze, RUN), "purview_copilot_usage_record_id")]
    assert got == ["a", "d"]
    frozen = replace(RUN, frozen=(202610,))
    assert rows(audit.audit_base(bronze, frozen), "purview_copilot_usage_prompt_count") == [(2,)]
    assert audit.audit_base(bronze, RunContext(202610, frozen=(202610,))).count() == 1
    # One record id on a third of many rows ends up once.
    many = bronze.unionByName(spark.createDataFrame([data[0]] * 300, AUDIT))
    assert audit.audit_base(many, RUN).count() == 2


USAGE = (
    "Date string, User string, `Service Account Name` string, `Service Account ID` string, `Cloud Agent ID` string, "
    "`Automation ID` string, Kind string, Model string, `Max Mode` string, `Input (w/ Cache Write)` string, "
    "`Input (w/o Cache Write)` string, `Cache Read` string, `Output Tokens` string, `Total Tokens` string, Cost string, "
    "FileName string, ExecutionDate string"
)


def usage_row(day, user, cost="1.5", loaded="2026-09-30 00:00:00"):
    return (day, user, None, None, None, None, "chat", "m", "true", "1", "2", "x", "4", "5.0", cost, "f.csv", loaded)


def test_usage_silver_rows_and_rejects(spark, identity, headcount):
    bronze = spark.createDataFrame(
        [
            usage_row("2026-09-10", " BOB.smith@corp.com "),
            usage_row("2026-09-10", " BOB.smith@corp.com "),
            usage_row("2026-09-10", "bob.smith@corp.com", "0"),
            usage_row("no day", "jane.doe@corp.com"),
            usage_row("2026-09-11", "who@corp.com"),
            usage_row("2026-09-11", "who@corp.com"),
            usage_row("2026-09-11", "not an address"),
        ],
        USAGE,
    )
    split = usage.usage_silver(bronze, identity, headcount, RUN)
    got = rows(split.matched, "CursorUsageMonthNo", "OktaUserId", "CursorUsageCost", "HCBusinessUnit", "HCDivisionINC", "CursorUsageKeyEmail")
    assert got == [
        (None, "okta-jane", Decimal("1.5"), None, "Others", None),
        (202609, "okta-bob", Decimal("0"), "BU", "Others", "202609/bob.smith@corp.com"),
        (202609, "okta-bob", Decimal("1.5"), "BU", "Others", "202609/bob.smith@corp.com"),
    ]
    assert split.matched.select("RecordSurrogateKey").distinct().count() == 3
    assert rows(split.rejects, "CursorUsageUser", "OktaRejectReason", "OktaRejectLoadedAt") == [
        ("who@corp.com", "okta_join_miss", LOADED)
    ] * 2
    daily = facts.active_daily(split.matched)
    assert rows(daily, "CursorUsageDate", "OktaUserId", "Request") == [
        (None, "okta-jane", 1),
        (date(2026, 9, 10), "okta-bob", 2),
    ]
    # The fact needs a month, so the row without a day is not in it.
    assert facts.usage_active_fact(split.matched, RUN).count() == 1


def test_closing_a_month_sees_identities_and_headcount_of_that_time(spark, identity, headcount):
    bronze = spark.createDataFrame([usage_row("2026-09-10", "new@corp.com"), usage_row("2026-10-10", "new@corp.com")], USAGE)
    assert usage.usage_silver(bronze, identity, headcount, RUN).matched.count() == 2
    closing = usage.usage_silver(bronze, identity, headcount, replace(RUN, close_month=202609))
    assert closing.matched.count() == 0 and closing.rejects.count() == 1


def load(store, identity, headcount):
    store.overwrite(identity, runs.IDENTITY)
    store.overwrite(headcount, runs.HEADCOUNT, "Month_No")


def test_usage_month_close_then_daily(spark, store, identity, headcount):
    load(store, identity, headcount)
    bronze = spark.createDataFrame(
        [usage_row("2026-09-10", "bob.smith@corp.com"), usage_row("2026-10-02", "bob.smith@corp.com"), usage_row("2026-10-03", "q@corp.com")],
        USAGE,
    )
    closing = replace(RUN, close_month=202609)
    runs.run_usage(store, bronze, closing)
    runs.run_usage_gold(store, closing)
    assert store.frozen_months("cursor") == [202609]
    assert rows(store.read(runs.USAGE_ACTIVE), "LastModification") == [(date(2026, 9, 10),)]
    before = rows(store.read(runs.USAGE).filter("CursorUsageMonthNo = 202609"))
    # The daily batch has more September rows; September is closed, October comes in. Twice is once.
    more = bronze.unionByName(spark.createDataFrame([usage_row("2026-09-12", "bob.smith@corp.com")], USAGE))
    for _ in range(2):
        runs.run_usage(store, more, RUN)
        runs.run_usage_gold(store, RUN)
        assert rows(store.read(runs.USAGE).filter("CursorUsageMonthNo = 202609")) == before
        assert rows(store.read(runs.USAGE_ACTIVE), "LastModification") == [(date(2026, 9, 10),), (date(2026, 10, 2),)]
        assert store.read(runs.USAGE_ONBOARD).count() == 2
        assert rows(store.read(runs.USAGE_REJECTS), "CursorUsageUser") == [("q@corp.com",)]
    # Closing September again is allowed and takes the new rows in.
    runs.run_usage(store, more, closing)
    runs.run_usage_gold(store, closing, replace_onboard=True)
    assert store.read(runs.USAGE_ACTIVE).filter("Month_No = 202609").count() == 2
    assert store.frozen_months("cursor") == [202609]


def test_audit_rejects_follow_the_whole_batch(spark, store, identity, headcount):
    load(store, identity, headcount)
    runs.run_audit(store, spark.createDataFrame(GOLDEN[2:], AUDIT), RUN)
    assert store.read(runs.AUDIT_REJECTS).count() == 1
    # The record turns up under a known address: the month has no rejects left.
    runs.run_audit(store, spark.createDataFrame([audit_row("r3", "2026-09-17", "bob.smith@corp.com", CHAT)], AUDIT), RUN)
    assert store.read(runs.AUDIT_REJECTS).count() == 0
    runs.run_audit_gold(store, RUN)
    assert rows(store.read(runs.AUDIT_ACTIVE), "userId", "Request") == [("okta-bob", 1)]
    assert store.read(runs.AUDIT_ONBOARD).count() == 1


def test_headcount_and_identity_runs(spark, store):
    names = [spelled for _, _, *spellings in dimensions.HEADCOUNT_SILVER for spelled in spellings]
    base = dict.fromkeys(names, "x") | {"Total Employees": "1"}

    def row(month, address, division, unit):
        return tuple((base | {"Month": month, "Email [Employee]": address, "Division INC": division, "Business Unit [Employee]": unit, "Country [Employee]": "ES"})[n] for n in names)

    schema = ", ".join(f"`{n}` string" for n in names)
    countries = spark.createDataFrame([("ES", "Spain")], "Country string, DisplayName string")
    bronze = spark.createDataFrame([row("202609", " A@B.C", "D", "old"), row("202610", "a@b.c", "D", "old"), row("202610", "b@b.c", None, "n"), row("bad", "c@b.c", "D", "n")], schema)
    runs.run_headcount(store, bronze, countries, RUN)
    assert rows(store.read(runs.HEADCOUNT), "HCKeyEmail", "HCKeyDivision", "HCDate") == [
        ("202609/a@b.c", "D/Spain", date(2026, 9, 1)),
        ("202610/a@b.c", "D/Spain", date(2026, 10, 1)),
    ]
    store.freeze_append("all", 202609, at=LOADED)
    newer = spark.createDataFrame([row("202609", "a@b.c", "D", "new"), row("202610", "z@b.c", "D", "new")], schema)
    runs.run_headcount(store, newer, countries, RUN)
    assert rows(store.read(runs.HEADCOUNT), "HCKeyEmail", "HCBusinessUnit") == [("202609/a@b.c", "old"), ("202610/z@b.c", "new")]
    runs.run_headcount(store, newer, countries, replace(RUN, close_month=202609))
    assert rows(store.read(runs.HEADCOUNT), "HCKeyEmail", "HCBusinessUnit") == [("202609/a@b.c", "new"), ("202610/z@b.c", "new")]

    people = spark.createDataFrame(
        [("1", "n", "f", "l", " A@b.c", "a@b.c", "e", "North", "o", "2026-09-01", None, "ES ", "T"), ("2", "n", "f", "l", "b@b.c", "b@b.c", "e", "off", "o", "2026-09-01", None, "FR", "T"), ("3", "n", "f", "l", "b@b.c", "bad", "e", "North", "o", "x", None, "FR", "T"), ("4", "n", "f", "l", "d@b.c", "d@b.c", "e", "North", "o", "2026-10-01", None, "FR", "T")],
        "id string, display_name string, first_name string, last_name string, login string, email string, employee_number string, region string, okta_id string, updated_at string, deleted_at string, country string, okta_tenant string",
    )
    runs.run_identity(store, people, countries, RUN, Exclusions(["OFF"], ["other"]))
    assert rows(store.read(runs.IDENTITY), "OktaUserId", "OktaUserEmail", "OktaUserCountry") == [("1", "a@b.c", "Spain"), ("4", "d@b.c", "No Country")]
    runs.run_identity(store, people, countries, replace(RUN, close_month=202609), Exclusions(["OFF"], ["other"]))
    assert rows(store.read(runs.IDENTITY), "OktaUserId") == [("1",)]


def test_priority_base_and_log(spark, identity):
    bronze = spark.createDataFrame([(1, "jane.doe.st@corp.com"), (1, None), (2, "nobody@x.y"), (3, None), (None, "bob.smith@corp.com")], "usage_id int, Source_Email string")
    base = priority.priority_base(bronze)
    assert rows(base, "codex_usage_record_id", "codex_usage_email_normalized") == [(None, "bob.smith@corp.com"), (1, "jane.doe.st@corp.com"), (2, "nobody@x.y"), (3, None)]
    split = priority.priority_silver(bronze, identity, RUN)
    assert rows(split.matched, "codex_usage_record_id", "okta_user_id") == [(1, "okta-jane")]
    assert rows(split.rejects, "codex_usage_record_id", "codex_matching_log_reason") == [(None, "okta_join_miss"), (2, "okta_join_miss"), (3, "okta_join_miss")]


def test_priority_run_writes_both_tables(spark, store, identity, headcount):
    load(store, identity, headcount)
    bronze = spark.createDataFrame([(1, "10jane.doe@corp.com"), (2, "bob.smith.st@else.com"), (3, "x@y.z")], "id int, source_email string")
    runs.run_priority(store, bronze, RUN)
    assert rows(store.read(runs.PRIORITY), "codex_usage_record_id", "okta_user_id") == [(2, "okta-bob")]
    assert rows(store.read(runs.PRIORITY_LOG), "codex_usage_record_id", "codex_matching_log_loaded_at") == [(1, LOADED), (3, LOADED)]


def test_reference_and_core_runs(spark, store):
    def frame(data, schema):
        return spark.createDataFrame(data, schema)

    runs.run_reference(
        store,
        {
            "normalization_countries_core": frame([("c1", "x", " Uno ", None), ("c1", "x", "Dos", None)], "id string, display_name string, `Normalized country` string, execution_date string"),
            "normalization_countries_okta": frame([(" ES", "Old", "2026-01-01"), ("ES ", "New", "2026-02-01")], "Country string, Normalization string, execution_date string"),
            "country_average_hours": frame([("ES", "160", "n/a", "2026-01-01"), ("ES ", "150.5", "38", "2025-01-01")], "`Country Normalized` string, average_month_hours string, AverageWeeklyHours string, execution_date string"),
            "business_unit": frame([(" U ", "1", None)], "business_unit string, oneerp_code string, execution_date string"),
        },
    )
    assert rows(store.read("silver.normalization_countries_okta"), "normalization_countries_okta_normalization") == [("New",)]
    assert rows(store.read("silver.country_average_hours"))[0][:3] == ("ES", Decimal(160), None)
    assert store.read("silver.business_unit").columns[0] == "business_unit_business_unit"
    assert reference.business_unit(frame([("u", "1", None)], "business_unit string, oneerp_code string, execution_date string"), "unit_").columns[0] == "unit_business_unit"
    stamps = "2026-01-01"
    runs.run_core(
        store,
        {
            "core_country": frame([(" c1 ", "2026-01-01"), ("c1", "2026-02-01"), ("c2", None), (" ", None)], "id string, execution_date string"),
            "core_billing": frame([("b1", "t", "i", stamps, stamps, None, "n", "c1", "t", "r", stamps), ("b1", "t", "i", stamps, "2026-03-01", None, "newer", "c1", "t", "r", stamps)], "id string, billing_type string, billing_identifier string, created_at string, updated_at string, deleted_at string, client_name string, country_id string, tenant string, region string, execution_date string"),
            "core_project": frame([("p1", "P", "true", stamps, "x", None, " b1", "no", "t", "1", stamps), ("p2", "P", "?", stamps, None, None, "zz", "no", "t", "1", stamps), ("p3", "P", "?", stamps, None, None, " ", "no", "t", "1", stamps)], "id string, display_name string, active string, create_at string, updated_at string, deleted_at string, billing_id string, corporate string, tenant string, is_public string, execution_date string"),
        },
        Exclusions(),
    )
    assert rows(store.read("silver.core_country"), "country_id", "country_display_name", "country_execution_date") == [("c1", "Dos", datetime(2026, 2, 1)), ("c2", None, None)]
    assert rows(store.read("silver.dim_project"), "dim_project_project_id", "dim_project_client_name", "dim_project_country", "dim_project_active") == [("p1", "newer", "Dos", True), ("p2", None, None, None)]
    assert core.core_asset(frame([(" a ", "d", "c", "x"), ("  ", "d", "c", None)], "id string, display_name string, asset_code string, execution_date string")).collect()[0][:] == ("a", "d", "c", None)


def test_alerts_and_security(spark, store):
    alerts = spark.createDataFrame(
        [(" 7 ", "t", "first", "true", "31/01/2026", "hi", "2026-01-01"), ("7", "t", "second", "true", "2026-02-01", "hi", "2026-01-02"), (" ", "t", "d", "x", None, None, None), (None,) * 7],
        "NotificationID string, notification_type string, description string, IsActive string, publication_date string, severity string, execution_date string",
    )
    runs.run_alerts(store, alerts)
    assert rows(store.read(runs.ALERTS_DIM)) == [("7", "t", "second", "true", date(2026, 2, 1), "hi")]
    columns = ["Email", "Report", "Access", "Codigo", "Conocido", "Nombre Completo", "Pais", "job_title", "Ticket", "Division", "access_scope", "execution_date"]
    data = [tuple(["NULL"] + ["x"] * 10 + ["bad"]), tuple([" a@b.c "] + ["x"] * 11), tuple([" a@b.c "] + ["x"] * 11), tuple([None] + ["x"] * 11)]
    bronze = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))
    runs.run_security(store, bronze)
    figures = {(r.table_name, r.figure): r.value for r in store.read(runs.METRICS).collect()}
    assert figures[runs.ALERTS, "rows_in"] == alerts.count() and figures[runs.SECURITY, "rows_in"] == bronze.count()
    assert figures[runs.ALERTS, "row_count"] == figures[runs.ALERTS, "distinct_ids"] == store.read(runs.ALERTS).count()
    assert rows(store.read(runs.SECURITY_DIM), "email") == [("NULL",), ("a@b.c",), ("a@b.c",)]
    assert notices.security_silver(bronze).filter(F.col("security_execution_date").isNotNull()).count() == 0


def test_fact_reads_one_month_and_hashes_only_groups(spark, store, identity, headcount):
    bronze = spark.createDataFrame([usage_row("2026-09-10", "bob.smith@corp.com")], USAGE)
    store.overwrite(usage.usage_silver(bronze, identity, headcount, RUN).matched, runs.USAGE, usage.MONTH)
    fact = facts.usage_active_fact(store.read(runs.USAGE), replace(RUN, close_month=202609))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(CursorUsageMonthNo" in plan.replace("\n", " ")
    assert "sha2(" not in plan[plan.index("SortAggregate") :]
    assert plan.count("Exchange") == 1


def test_audit_filters_come_before_parsing_and_rows_shuffle_once(spark, identity, headcount, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    spark.createDataFrame(GOLDEN, AUDIT).write.parquet(str(tmp_path / "audit"))
    run = RunContext(close_month=202609)
    bronze = spark.read.parquet(str(tmp_path / "audit"))
    bronze = bronze.filter(audit.audit_scan_predicate(run, bronze))
    plan = audit.audit_base(bronze, run)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(CreationDate,2026-09-01),LessThan(CreationDate,2026-10-01)" in plan.replace("), L", "),L")
    lines = plan.splitlines()
    parse = next(n for n, line in enumerate(lines) if "from_json" in line)
    assert any("Filter" in line and "RLIKE" in line for line in lines[parse:])
    assert plan.count("Exchange hashpartitioning") == 1


def snake(df, **names):
    return df.toDF(*[names.get(c, c) for c in df.columns])


@pytest.mark.parametrize("close", [None, 202609])
def test_runs_find_columns_under_other_headers(spark, store, identity, headcount, close):
    load(store, identity, headcount)
    run = replace(RUN, close_month=close)
    bronze = spark.createDataFrame([audit_row("r2", " 2026-09-16", "bob.smith@corp.com", APPS)], AUDIT)
    runs.run_audit(store, snake(bronze, CreationDate="creation_date", UserId="user_id", RecordId="record_id"), run)
    assert store.read(runs.AUDIT).count() == 1
    rows_ = spark.createDataFrame([usage_row("2026-09-10", "bob.smith@corp.com")], USAGE)
    runs.run_usage(store, snake(rows_, Date="date", User="USER", FileName="file_name"), run)
    assert store.read(runs.USAGE).count() == 1


def test_a_daily_run_needs_its_first_day():
    with pytest.raises(ValueError, match="min_date"):
        RunContext().first_day  # noqa: B018


def test_rejects_without_a_month_stay_where_a_run_leaves_such_rows_out(spark, store, identity, headcount):
    load(store, identity, headcount)
    bronze = spark.createDataFrame([usage_row("no date", "q@corp.com"), usage_row("2026-09-10", "q@corp.com")], USAGE)
    without = lambda: store.read(runs.USAGE_REJECTS).filter(F.col(usage.MONTH).isNull()).count()
    runs.run_usage(store, bronze, RUN)
    assert without() == 1
    closing = replace(RUN, close_month=202609)
    runs.run_usage(store, bronze, closing)
    assert without() == 1
    runs.run_usage_gold(store, closing)
    runs.run_usage(store, bronze, RUN)
    assert without() == 1 and store.frozen_months("cursor") == [202609]


def test_usage_is_read_once_for_both_outcomes_and_nothing_stays_staged(spark, store, identity, headcount, tmp_path):
    import glob

    from tiercraft.session import shared_folder

    load(store, identity, headcount)
    place = shared_folder(spark).removeprefix("file:")
    before = set(glob.glob(f"{place}/stage/*"))
    runs.run_usage(store, spark.createDataFrame([usage_row("2026-09-10", "bob.smith@corp.com")], USAGE), RUN)
    runs.run_audit(store, spark.createDataFrame(GOLDEN, AUDIT), RUN)
    assert set(glob.glob(f"{place}/stage/*")) == before


def test_a_close_that_fails_leaves_the_ledger_and_can_be_repeated(spark, store, identity, headcount, monkeypatch):
    load(store, identity, headcount)
    bronze = spark.createDataFrame([usage_row("2026-09-10", "bob.smith@corp.com")], USAGE)
    countries = spark.createDataFrame([("ES", "Spain")], "Country string, DisplayName string")
    inputs = runs.Inputs(countries, usage=bronze, audit=spark.createDataFrame(GOLDEN, AUDIT))
    closing = replace(RUN, close_month=202609)
    with monkeypatch.context() as broken:
        broken.setattr(runs, "run_audit_gold", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            runs.run_close(store, inputs, closing, Exclusions())
    assert store.frozen_months("cursor") == [] and store.frozen_months("copilot") == []
    runs.run_close(store, inputs, closing, Exclusions())
    assert store.frozen_months("cursor") == [202609] and store.frozen_months("copilot") == [202609]
    runs.run_daily(store, inputs, RUN, Exclusions())
    assert store.read(runs.USAGE_ACTIVE).count() == 1 and store.read(runs.AUDIT_ACTIVE).count() == 2
    assert len(store.read(runs.AUDIT_ONBOARD + "_columns").columns) == 21
    assert store.read(runs.USAGE_ACTIVE + "_columns").columns[0] == "Month_No" or len(store.read(runs.USAGE_ACTIVE + "_columns").columns) == 40
