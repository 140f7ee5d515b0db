from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gamepulse.functions import casts, channel, times
from gamepulse.plans.points import points_rule, whole


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn("v").alias("r")).first()[0]


@pytest.mark.parametrize(("text", "want"), [
    ("7", 7), ("-7", -7), ("+7", 7), (" 7", None), ("7 ", None), ("", None), ("x", None), ("7.0", None),
    ("2147483647", 2147483647), ("2147483648", None), ("7\n", None),
])
def test_strict_int(spark, text, want):
    assert one(spark, text, casts.strict_int) == want


@pytest.mark.parametrize(("text", "want"), [("", 0), ("5", 5), ("x", None)])
def test_blank_as_zero(spark, text, want):
    assert one(spark, text, casts.blank_as_zero_int) == want
    assert one(spark, text, casts.blank_as_zero_double) == want


@pytest.mark.parametrize(("text", "want"), [("", "21"), ("\\N", "pyw"), ("x", "x"), (None, None)])
def test_channel_default(spark, text, want):
    assert one(spark, text, channel.default_channel) == want


@pytest.mark.parametrize(("text", "want"), [
    ("", ("21", "", "")), ("0", ("21", "", "")), ("solo", ("solo", "", "")), ("a_b", ("a_b", "", "")),
    ("a_b_", ("a_b_", "", "")), ("a__c", ("a", "", "c")), ("_a_b", ("", "a", "b")), ("___", ("___", "", "")),
    ("a_b_c_d", ("a", "b", "c")), ("a_b_c_", ("a", "b", "c")), (None, (None, None, None)),
])
def test_channel_split(spark, text, want):
    df = spark.createDataFrame([(text,)], "expand_channel string")
    assert tuple(channel.split_channel(df).first()) == want


def split_model(text):
    """The rule in plain Python: trailing blanks are no parts, fewer than three parts stay whole."""
    if text in ("", "0"):
        return ("21", "", "")
    parts = text.split("_")
    while parts and parts[-1] == "":
        parts.pop()
    return (text, "", "") if len(parts) < 3 else tuple(parts[:3])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab0_", max_size=9), min_size=200, max_size=300))
def test_channel_split_of_many_texts(spark, texts):
    df = spark.createDataFrame([(t, t) for t in texts], "expand_channel string, t string")
    got = {r["t"]: (r["parent_channel"], r["child_channel"], r["ad_label"]) for r in channel.split_channel(df).collect()}
    assert got == {t: split_model(t) for t in texts}


@pytest.mark.parametrize(("sizes", "passes"), [
    ((10, 10, 15), True), ((11, 10, 15), False), ((10, 11, 15), False), ((10, 10, 16), False),
])
def test_length_gate(spark, sizes, passes):
    text = "_".join("x" * n for n in sizes)
    valid, rejects = channel.gate_channel(
        channel.split_channel(spark.createDataFrame([(text,)], "expand_channel string"))
    )
    assert (valid.count(), rejects.count()) == ((1, 0) if passes else (0, 1))


def test_null_channel_is_rejected(spark):
    df = channel.split_channel(spark.createDataFrame([(None,)], "expand_channel string"))
    valid, rejects = channel.gate_channel(df)
    assert (valid.count(), rejects.count()) == (0, 1)


@pytest.mark.parametrize(("stamp", "want"), [
    ("29/Jun/2017:16:54:53 +0800", "2017-06-29 16"), ("01/Sept/2016:00:01:02 +0800", "2016-09-01 00"),
    ("01/Sep/2016:23:01:02 +0800", "2016-09-01 23"), ("01/Foo/2016:23:01:02 +0800", None),
    ("31/Feb/2016:23:01:02 +0800", None), ("junk", None),
])
def test_access_log_hour(spark, stamp, want):
    assert one(spark, f"192.0.2.1 - - [{stamp}] \"GET /\"", times.access_log_hour) == want


def test_access_log_hour_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = one(spark, "x [26/Mar/2017:02:30:00 +0800] x", times.access_log_hour)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == "2017-03-26 02"


@pytest.mark.parametrize(("amount", "want"), [
    (0.0, 0.0), (0.6, 1.0), (2.0, 1.0), (3.8, 1.0), (5.0, 2.0), (-1.0, 0.0), (-5.0, -2.0), (1e13, 5e12),
])
def test_points_rule(spark, amount, want):
    assert one(spark, amount, lambda c: points_rule(c, 50), "double") == want


def test_whole_points(spark):
    assert [one(spark, v, whole, "double") for v in (1.9, -1.9, float("nan"), 3.0)] == [1, -1, None, 3]


def test_day_range_is_inclusive_and_skips_bad_times(spark):
    times_ = ["2024-01-04 23:59:59", "2024-01-05 00:00:00", "2024-01-06 23:59:59", "2024-01-07 00:00:00",
              "2024-01-05", "junk", "", None, "0000-00-00 00:00:00", "2024-01-1x 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times_], "t string")
    got = {r[0] for r in times.day_range(df, "t", "2024-01-05", date(2024, 1, 6)).collect()}
    assert got == {"2024-01-05 00:00:00", "2024-01-06 23:59:59", "2024-01-05"}


def test_day_range_reaches_the_scan(spark, tmp_path):
    df = spark.range(5).select(F.lit("2024-01-05 10:00:00").alias("t"))
    df.write.parquet(str(tmp_path / "p"))
    ranged = times.day_range(spark.read.parquet(str(tmp_path / "p")), "t", "2024-01-05", "2024-01-06")
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,2024-01-05)" in plan and "LessThan(t,2024-01-07)" in plan
