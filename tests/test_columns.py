from __future__ import annotations

from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from riskweave.functions import columns as C


def values(spark, kind, inputs, expression):
    df = spark.createDataFrame([(v,) for v in inputs], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "hour, transaction, login",
    [
        (0, "Night (12AM-6AM)", "Night (12AM-6AM)"),
        (5, "Night (12AM-6AM)", "Night (12AM-6AM)"),
        (6, "Night (12AM-6AM)", "Morning (6AM-12PM)"),
        (7, "Morning (7AM-11AM)", "Morning (6AM-12PM)"),
        (11, "Morning (7AM-11AM)", "Morning (6AM-12PM)"),
        (12, "Afternoon (12PM-5PM)", "Afternoon (12PM-6PM)"),
        (17, "Afternoon (12PM-5PM)", "Afternoon (12PM-6PM)"),
        (18, "Evening (6PM-11PM)", "Evening (6PM-12AM)"),
        (23, "Evening (6PM-11PM)", "Evening (6PM-12AM)"),
    ],
)
def test_time_of_day_has_two_different_nights(spark, hour, transaction, login):
    moment = [datetime(2024, 1, 5, hour, 59)]
    assert values(spark, "timestamp_ntz", moment, C.transaction_time_of_day) == [transaction]
    assert values(spark, "timestamp_ntz", moment, C.login_time_of_day) == [login]


def test_age_tier(spark):
    ages = [None, 18, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, 90]
    assert values(spark, "bigint", ages, C.age_tier) == [
        "Unknown",
        "Under 25",
        "Under 25",
        "25-34",
        "25-34",
        "35-44",
        "35-44",
        "45-54",
        "45-54",
        "55-64",
        "55-64",
        "65+",
        "65+",
    ]


def test_customer_risk_level(spark):
    assert values(spark, "bigint", [None, 0, 2, 3, 5, 6], C.customer_risk_level) == [
        "Low",
        "Low",
        "Low",
        "Medium",
        "Medium",
        "High",
    ]


def test_merchant_category_and_flag(spark):
    scores = [None, 0.19, 0.2, 0.49, 0.5, 0.69, 0.7]
    assert values(spark, "double", scores, C.merchant_risk_category) == [
        "Low Risk",
        "Low Risk",
        "Medium Risk",
        "Medium Risk",
        "High Risk",
        "High Risk",
        "High Risk",
    ]


def test_missing_amount_is_high_tier_but_not_high_value(spark):
    amounts = [None, 1.0, 100.0, 100.01, 150.0, 150.01, 500.0]
    assert values(spark, "double", amounts, C.amount_tier) == [
        "High",
        "Low",
        "Low",
        "Mid",
        "Mid",
        "High",
        "High",
    ]
    assert values(spark, "double", amounts, C.is_high_value) == [
        False,
        False,
        False,
        False,
        False,
        True,
        True,
    ]


def test_elevated_fraud_risk(spark):
    cases = [
        ("High", False, True, 151.0, True),
        ("High", False, False, 150.0, False),
        ("Low", True, True, 500.0, False),
        ("Low", True, True, 500.01, True),
        (None, None, True, 900.0, False),
        ("High", None, True, None, True),
        ("Low", True, False, None, False),
    ]
    df = spark.createDataFrame(cases, "l string, h boolean, v boolean, a double, want boolean")
    got = df.select(
        C.elevated_fraud_risk(F.col("l"), F.col("h"), F.col("v"), F.col("a")), "want"
    ).collect()
    assert [r[0] for r in got] == [r[1] for r in got]


def test_missing_place_is_a_mismatch_and_has_no_distance(spark):
    cases = [
        (40.0, -80.0, 40.009, -80.009, False),
        (40.0, -80.0, 40.02, -80.0, True),
        (40.0, -80.0, 40.0, -80.02, True),
        (None, -80.0, 40.0, -80.0, True),
        (40.0, -80.0, 40.0, None, True),
    ]
    df = spark.createDataFrame(cases, "a double, b double, c double, d double, want boolean")
    place = [F.col(c) for c in "abcd"]
    got = df.select(C.geo_mismatch(*place), "want", C.degrees_between(*place)).collect()
    assert [r[0] for r in got] == [r[1] for r in got]
    assert [r[2] is None for r in got] == [False, False, False, True, True]


def test_distance_is_euclidean_in_degrees(spark):
    df = spark.createDataFrame([(0.0, 0.0, 3.0, 4.0)], "a double, b double, c double, d double")
    assert df.select(C.degrees_between(*[F.col(c) for c in "abcd"])).first()[0] == 5.0


def test_account_age_day_part_matches_calendar_age(spark):
    days = [date(2023, 12, 25) + timedelta(d) for d in range(0, 110)]
    days += [date(2020, 2, 28), date(2020, 2, 29), date(2020, 3, 31), date(2019, 1, 31)]
    as_ofs = [date(2024, 2, 1), date(2024, 2, 29), date(2024, 3, 30), date(2023, 3, 1)]
    pairs = [(created, as_of) for created in days for as_of in as_ofs]
    df = spark.createDataFrame(pairs, "c date, a date")
    got = df.select(
        "c",
        "a",
        C.account_age_day_part(F.col("c"), F.col("a")),
        C.account_age_total_days(F.col("c"), F.col("a")),
    ).collect()
    con = duckdb.connect()
    for created, as_of, part, total in got:
        want = con.execute("SELECT date_part('day', age(?::DATE, ?::DATE))", [as_of, created])
        assert part == want.fetchone()[0], (created, as_of)
        assert total == (as_of - created).days


def test_weekday_counts_from_sunday(spark):
    friday_to_monday = [datetime(2024, 1, day, 10) for day in (5, 6, 7, 8)]
    kind = "timestamp_ntz"
    assert values(spark, kind, friday_to_monday, C.sunday_based_weekday) == [5, 6, 0, 1]
    assert values(spark, kind, friday_to_monday, C.is_weekend) == [False, True, True, False]
    assert values(spark, kind, [None], C.is_weekend) == [False]


def test_surrogate_key_text(spark):
    df = spark.createDataFrame(
        [(7, datetime(2024, 1, 5, 1, 2, 3, 500000)), (None, None)], "a bigint, b timestamp_ntz"
    )
    keys = [r[0] for r in df.select(C.surrogate_key(F.col("a"), F.col("b"))).collect()]
    con = duckdb.connect()
    null = "_dbt_utils_surrogate_key_null_"
    for key, text in zip(keys, ["7-2024-01-05 01:02:03.5", f"{null}-{null}"]):
        assert key == con.execute("SELECT md5(?)", [text]).fetchone()[0]


def test_trim_takes_spaces_only(spark):
    got = values(spark, "string", ["  a ", "\ta\t", None], lambda c: C.cleaned(c, "Unknown"))
    assert got == ["a", "\ta\t", "Unknown"]


def test_lookups(spark):
    assert values(spark, "string", ["Crypto", "Other", None], C.category_risk) == [0.7, None, None]
    assert values(spark, "string", ["Low", "Medium", "High", None], C.risk_level_code) == [
        0,
        1,
        2,
        None,
    ]
