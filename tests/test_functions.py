from datetime import date, datetime
from decimal import Decimal
from hashlib import sha256

import pytest
from rows import rows
from pyspark.sql import functions as F

from tiercraft.workload.registry import INTERACTIONS
from tiercraft.context import RunContext, frozen_to_skip, month_bounds
from tiercraft.functions import audit_json, dates, email, interactions
from tiercraft.functions.columns import (
    Headers,
    decimals_to_double,
    nonempty,
    to_bool,
    to_decimal,
    to_ts,
    to_whole,
    trim_lower,
    trimmed,
)
from tiercraft.functions.keys import joined_key, surrogate_key


def values(spark, texts, rule, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
    return [r[0] for r in df.select(rule(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def test_headers_match_spelling_variants(spark):
    headers = Headers(["Average weekly hours", "Inc. Roles", "Email [Employee]", "user_name", "UserName"])
    for spelling in ("Average weekly hours", "AverageWeeklyHours", "average_weekly_hours"):
        assert headers.find(spelling) == "Average weekly hours"
    assert headers.find("nothing", "inc._roles") == "Inc. Roles"
    assert headers.find("USER_NAME") == "user_name"  # the exact name comes before the loose one
    assert headers.find("user name") == "UserName"  # of two alike the later one
    with pytest.raises(ValueError, match="user_name"):
        headers.column("absent")
    df = spark.createDataFrame([("x",)], "`Inc. Roles` string")
    assert df.select(Headers(df.columns).column("inc.roles"), Headers(df.columns).column_or_null("b", dtype="int"))\
        .collect()[0][:] == ("x", None)


def test_cleaning_rules(spark):
    assert values(spark, ["  a ", None, "\tb", ""], trimmed) == ["a", None, "\tb", ""]
    assert values(spark, [" A@B.C ", None], trim_lower) == ["a@b.c", None]
    assert values(spark, [" ", "", None, "x"], nonempty) == [False, False, False, True]
    assert values(spark, [" 1.5 ", "x", None], to_decimal) == [Decimal("1.50000000"), None, None]
    assert values(spark, ["2024-01-31 10:00:00", "soon", None], to_ts) == [datetime(2024, 1, 31, 10), None, None]
    assert values(spark, ["true", "no", "1", "maybe", None], to_bool) == [True, False, True, None, None]
    assert values(spark, ["7", "7.9", "-3.0", "x", "", None, " 8 ", ".5", "."], to_whole) == [7, 7, -3, None, None, None, 8, 0, None]


def test_cleaning_rules_do_not_depend_on_ansi(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            assert values(spark, ["x"], to_whole) == [None]
            assert values(spark, ["31/12/2024", "13/13/2024"], dates.parse_date) == [date(2024, 12, 31), None]
            df = spark.createDataFrame([(Decimal("0"), None)], "a decimal(18,8), b decimal(18,8)")
            assert df.select(surrogate_key(df, "a", "b")).first()[0] == sha256(b"0E-8|").hexdigest()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_decimals_to_double(spark):
    df = spark.createDataFrame([(Decimal("1.25"), "x")], "`a.b` decimal(10,2), c string")
    assert decimals_to_double(df).dtypes == [("a.b", "double"), ("c", "string")]


def test_email_rules(spark):
    texts = ["a@b.c", " A@B.C ", "a@b", "a b@c.d", "", None, "a@@b.c"]
    assert values(spark, texts, email.valid_email) == [True, True, False, False, False, False, False]
    texts = ["10jane@x.y", "10@x.y", "110@x.y", "10nobody", None]
    assert values(spark, texts, email.strip_prefix10) == ["jane@x.y", "@x.y", None, None, None]
    assert values(spark, ["a@b@c", "none", None], email.local_part) == ["a", None, None]


def test_email_variants(spark):
    texts = [" 10123@X.Y", "10abc@x.y", "joe.st@x.y", "joe.st", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [tuple(r) for r in df.select(*email.email_variants(F.col("x")).values()).collect()]
    assert got == [
        ("10123@x.y", "123@x.y", None, "10123", None),
        ("10abc@x.y", None, None, "10abc", None),
        ("joe.st@x.y", None, "joe@x.y", "joe.st", "joe"),
        ("joe.st", None, "joe.st", None, None),
        (None, None, None, None, None),
    ]


def test_dates(spark):
    assert values(spark, [202402, 202413, 0, None], dates.month_start, "int") == [date(2024, 2, 1), None, None, None]
    assert values(spark, ["2024-12", "2024-1x"], dates.month_after) == [date(2025, 1, 1), None]
    texts = ["2024-03-02", "02/03/2024", "12/31/2024", "2024-03-02 10:00:00", "nope", None, " 2024-03-02 "]
    day = date(2024, 3, 2)
    assert values(spark, texts, dates.parse_date) == [day, day, date(2024, 12, 31), day, None, None, day]
    assert month_bounds(202412) == (date(2024, 12, 1), date(2025, 1, 1))
    assert RunContext(202407, min_date="2020-01-01").first_day == "2024-07-01"
    assert RunContext(min_date="2020-01-01").first_day == "2020-01-01"
    assert frozen_to_skip([202402, 202401, 202401], 202402) == [202401]


def test_keys(spark):
    df = spark.createDataFrame([("a", None, date(2024, 1, 1))], "a string, b string, d date")
    assert df.select(surrogate_key(df, "d", "a", "b")).first()[0] == sha256(b"2024-01-01|a|").hexdigest()
    assert df.select(joined_key(F.col("a"), F.col("d")), joined_key(F.col("a"), F.col("b"))).first()[:] == (
        "a/2024-01-01",
        None,
    )


def test_interaction_kinds_and_factors(spark):
    cases = [
        ("suite.data.x", "Analyst", "Report", "6", "0.75", "2.5"),
        ("suite.studio.x", None, "Studio agent", "4", "1.00", "1.3"),
        ("suiteagent.x", "Researcher", "Named agent", "5", "1.00", "1.4"),
        ("suiteagent.x", None, "Built-in agent", "3", "1.00", "1.2"),
        ("suite.chat.firm", None, "Chat", "1", "0.75", "0.083333"),
        ("suite.office", None, "Office", "2", "0.625", "0.8"),
        (None, None, "Other", "7", "0.625", "1.7"),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "app string, agent string")
    kind = INTERACTIONS.kind(F.col("app"), F.col("agent"))
    got = df.select(
        kind, INTERACTIONS.use_case_code(kind), INTERACTIONS.automation_factor(kind),
        INTERACTIONS.hours_saved_factor(kind),
    ).collect()
    for row, (_, _, name, code, automation, hours) in zip(got, cases, strict=True):
        assert row[:] == (name, f"CASE-{code}", Decimal(automation), Decimal(hours))
    odd = spark.createDataFrame([("Others",), ("unheard of",), (None,)], "k string")
    k = F.col("k")
    spelled = interactions.Interactions(factors={**INTERACTIONS.factors, "Others": interactions.Factors(None, "0.5", "1")})
    assert [r[:] for r in odd.select(spelled.use_case_code(k), spelled.automation_factor(k)).collect()] == [
        ("CASE-7", Decimal("0.5")),
        ("CASE-7", None),
        ("CASE-7", None),
    ]
    none = interactions.Interactions()
    assert df.select(none.kind(F.col("app"), F.col("agent")), none.use_case_code(F.col("app"))).distinct().collect() == [("Other", None)]


def test_measures_keep_their_decimal_types(spark):
    df = spark.createDataFrame([("Office", 3)], "k string, n int")
    hours = INTERACTIONS.hours_saved_factor(F.col("k"))
    one = F.lit("1").cast("decimal(18,8)")
    got = df.select(
        interactions.hours_saved(F.col("n"), hours, one).alias("s"),
        interactions.hours_total(F.col("n"), hours, INTERACTIONS.automation_factor(F.col("k"))).alias("t"),
    )
    assert got.dtypes == [("s", "decimal(38,6)"), ("t", "decimal(38,9)")]
    assert got.first()[:] == (Decimal("2.400000"), Decimal("3.840000000"))


def test_payload_edges(spark):
    event = '{"CopilotEventData":{"Messages":%s,"AISystemPlugin":%s,"AccessedResources":%s}}'
    cases = {
        "plain": event % ('[{"isPrompt":true},{"isPrompt":null},{"JailbreakDetected":true}]', '[{"Id":"BingWebSearch"}]', '["a",{"b":1}]'),
        "nulls": event % ("null", "null", "null"),
        "object": event % ('{"isPrompt":true}', '{"Id":"x"}', '{"b":1}'),
        "bad array": event % ('"not json"', '[{"Id":"x"}]', "[]"),
        "array as text": event % ('"[{\\"isPrompt\\":true}]"', "[]", "[]"),
        "malformed": '{"CopilotEventData":',
        "null": None,
    }
    df = spark.createDataFrame(list(cases.items()), "name string, text string")
    parsed = audit_json.payload(F.col("text"))
    got = {
        r[0]: r[1:]
        for r in df.select(
            "name",
            audit_json.size_or_zero(audit_json.messages(parsed)),
            audit_json.prompt_count(audit_json.messages(parsed)),
            audit_json.any_jailbreak(audit_json.messages(parsed)),
            audit_json.size_or_zero(audit_json.plugins(parsed)),
            audit_json.any_web_search(audit_json.plugins(parsed)),
            audit_json.size_or_zero(audit_json.resources(parsed)),
        ).collect()
    }
    assert got == {
        "plain": (3, 1, True, 1, True, 2),
        "nulls": (0, 0, False, 0, False, 0),
        "object": (1, 1, False, 1, False, 0),
        "bad array": (0, 0, False, 1, False, 0),
        "array as text": (1, 1, False, 0, False, 0),
        "malformed": (0, 0, False, 0, False, 0),
        "null": (0, 0, False, 0, False, 0),
    }


def test_payload_scalars_and_first_model(spark):
    text = (
        '{"AppIdentity":5,"AgentName":{"a":1},"CopilotEventData":{"AppHost":"Word","ThreadId":7,'
        '"ModelTransparencyDetails":[{"ModelName":"m0"},{"ModelName":"m1","ModelProviderName":"p1"}]}}'
    )
    single = '{"CopilotEventData":{"ModelTransparencyDetails":{"ModelName":"m"}}}'
    df = spark.createDataFrame([(text,), (single,)], "t string")
    parsed = audit_json.payload(F.col("t"))
    got = df.select(
        parsed["AppIdentity"], parsed["AgentName"], audit_json.event_field(parsed, "ThreadId"),
        audit_json.first_model_field(F.col("t"), "ModelName"),
        audit_json.first_model_field(F.col("t"), "ModelProviderName"),
    ).collect()
    assert got[0][:] == ("5", '{"a":1}', "7", "m0", None)
    assert got[1][3:] == (None, None)
    assert rows(df.select(F.length("t")))
