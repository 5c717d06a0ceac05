from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskweave.operators.features import (
    amount_statistics,
    enrich_for_rules,
    enrich_transactions,
    failed_logins,
    last_logins,
    with_amount_zscore,
    zscore_from_statistics,
)
from riskweave.operators.login_context import context_by_segments, context_by_window
from riskweave.operators.skew import KeySkew, measure_skew
from tests.conftest import at, rows

TX = "transaction_id bigint, customer_id bigint, transaction_timestamp timestamp_ntz"
LOGIN = (
    "login_attempt_id string, customer_id bigint, login_timestamp timestamp_ntz,"
    " is_success boolean, login_time_of_day string, is_weekend_login boolean,"
    " night_login_attempts bigint"
)


def login(name, customer, moment, success=False, band="Morning", weekend=False, nights=0):
    return (name, customer, moment, success, band, weekend, nights)


def by_window(tx, logins):
    return context_by_window(tx, logins)


def by_segments(tx, logins):
    return context_by_segments(tx, logins, partitions=7)


FORMS = [by_window, by_segments]


def context(spark, form, transactions, logins):
    result = form(spark.createDataFrame(transactions, TX), spark.createDataFrame(logins, LOGIN))
    picked = result.select("transaction_id", "last_login.login_attempt_id", "failed_logins")
    return {r[0]: (r[1], r[2]) for r in picked.collect()}


@pytest.mark.parametrize("form", FORMS)
def test_both_ends_of_the_look_back_count(spark, form):
    tx = [(1, 1, at("10 12:00"))]
    at_both_ends = [login("a", 1, at("09 12:00")), login("b", 1, at("10 12:00"))]
    assert context(spark, form, tx, at_both_ends) == {1: ("b", 2)}
    outside = [
        login("a", 1, at("09 11:59:59.999999")),
        login("b", 1, at("10 12:00:00.000001")),
    ]
    assert context(spark, form, tx, outside) == {1: ("a", 0)}


@pytest.mark.parametrize("form", FORMS)
def test_largest_id_is_last_at_one_instant(spark, form):
    tx = [(1, 1, at("10 12:00"))]
    logins = [login("b", 1, at("10 11:00")), login("c", 1, at("10 11:00")), login("a", 1, at("10 11:00"))]
    assert context(spark, form, tx, logins) == {1: ("c", 3)}


@pytest.mark.parametrize("form", FORMS)
def test_successful_and_unknown_logins_are_not_failures(spark, form):
    tx = [(1, 1, at("10 12:00"))]
    logins = [login("a", 1, at("10 11:00"), True), login("b", 1, at("10 11:30"), None)]
    assert context(spark, form, tx, logins) == {1: ("b", 0)}


@pytest.mark.parametrize("form", FORMS)
def test_rows_without_customer_or_logins_stay(spark, form):
    tx = [(1, 1, at("10 12:00")), (2, None, at("10 12:00")), (3, 5, at("10 12:00")), (4, 1, None)]
    logins = [login("a", 1, at("10 13:00")), login("b", None, at("10 11:00")), login("c", 1, None)]
    nothing = (None, 0)
    assert context(spark, form, tx, logins) == {1: nothing, 2: nothing, 3: nothing, 4: nothing}


@pytest.mark.parametrize("form", FORMS)
def test_repeated_transactions_stay_repeated(spark, form):
    tx = spark.createDataFrame([(1, 1, at("10 12:00"))] * 3 + [(2, 1, at("10 12:00"))], TX)
    logins = spark.createDataFrame([login("a", 1, at("10 11:00"))], LOGIN)
    got = rows(form(tx, logins), "transaction_id", "failed_logins")
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1)]


def random_events(seed, customers, n_tx, n_logins):
    """Events on a coarse time grid, so ties and exact distances are frequent.

    Customer 1 has at least a third of everything.
    """
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def moment():
        return start + timedelta(hours=rng.randrange(0, 24 * 6, 2))

    def who():
        return 1 if rng.random() < 0.4 else rng.choice([*range(2, customers), None])

    tx = [(i, who(), moment()) for i in range(n_tx)]
    logins = [login(f"{i:05d}", who(), moment(), rng.random() < 0.4) for i in range(n_logins)]
    return tx, logins


def brute_force(transactions, logins):
    result = {}
    for tx, customer, moment in transactions:
        before = [
            row for row in logins if customer is not None and row[1] == customer and row[2] <= moment
        ]
        last = max(before, key=lambda row: (row[2], row[0]))[0] if before else None
        failed = [r for r in before if not r[3] and r[2] >= moment - timedelta(hours=24)]
        result[tx] = (last, len(failed))
    return result


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, form, seed):
    tx, logins = random_events(seed, 6, 120, 300)
    assert context(spark, form, tx, logins) == brute_force(tx, logins)


def test_hot_customers_are_split_off_and_nothing_changes(spark):
    tx, logins = random_events(3, 12, 200, 400)
    frames = [spark.createDataFrame(tx, TX), spark.createDataFrame(logins, LOGIN)]
    skew = measure_skew("customer_id", frames, limit=150)
    assert rows(skew.hot) == [(1,)]
    want = brute_force(tx, logins)
    got = last_logins(*frames, skew=skew).join(
        failed_logins(*frames, skew=skew).select("transaction_id", "failed_logins_24h"),
        "transaction_id",
    )
    picked = got.select("transaction_id", "last_login_attempt_id", "failed_logins_24h")
    assert {r[0]: (r[1], r[2]) for r in picked.collect()} == want


def test_no_hot_customer_needs_no_split(spark):
    tx, logins = random_events(3, 12, 20, 40)
    frames = [spark.createDataFrame(tx, TX), spark.createDataFrame(logins, LOGIN)]
    skew = measure_skew("customer_id", frames)
    assert skew.hot is None
    assert skew.split(frames[0]) == (frames[0], None)


def test_features_from_the_last_login(spark):
    tx = spark.createDataFrame(
        [(1, 1, at("10 12:00"), 40.0, -80.0, 40.0, -80.0), (2, 2, at("10 12:00"), 40.0, -80.0, None, None)],
        TX + ", latitude double, longitude double, customer_home_latitude double,"
        " customer_home_longitude double",
    )
    logins = spark.createDataFrame(
        [
            login("a", 1, at("10 10:00"), band="Morning (6AM-12PM)"),
            login("b", 1, at("10 11:00"), band="Night (12AM-6AM)", weekend=True, nights=2),
        ],
        LOGIN,
    )
    got = rows(
        enrich_transactions(tx, logins),
        "transaction_id",
        "failed_logins_24h",
        "geo_mismatch",
        "odd_hours",
        "weekend_login",
        "night_login",
    )
    assert got == [(1, 2, False, True, True, True), (2, 0, True, False, False, False)]


AMOUNT = "transaction_id bigint, customer_id bigint, transaction_amount double"


def amounts():
    data = [(1, 1, 5.0)]  # a single row: deviation 0
    data += [(10 + i, 2, 7.0) for i in range(3)]  # all equal: deviation 0
    data += [(20 + i, 3, 1.0) for i in range(9)] + [(29, 3, 100.0)]  # 10 rows
    data += [(40 + i, 4, 1.0) for i in range(10)] + [(50, 4, 100.0)]  # 11 rows
    data += [(60, 5, None), (61, 5, 2.0), (62, 5, 4.0)]
    data += [(70, None, 3.0), (71, None, 9.0)]
    return data


def zscores(df):
    return {r[0]: r[1] for r in df.select("transaction_id", "amount_zscore").collect()}


@pytest.mark.parametrize("hot", [[], [3], [2, 4]])
def test_zscores(spark, hot):
    df = spark.createDataFrame(amounts(), AMOUNT)
    keys = spark.createDataFrame([(k,) for k in hot], "customer_id bigint") if hot else None
    z = zscores(with_amount_zscore(df, KeySkew("customer_id", keys)))
    assert len(z) == len(amounts())
    assert z[1] == 0.0 and z[10] == 0.0
    # With n rows no score exceeds sqrt(n - 1).
    assert z[29] == pytest.approx(3.0) and z[29] <= 3.0 + 1e-9
    assert z[50] == pytest.approx(10**0.5)
    assert z[60] is None and z[61] == pytest.approx(-1.0) and z[62] == pytest.approx(1.0)
    assert z[70] is None and z[71] is None


def test_given_statistics_give_the_same_scores(spark):
    df = spark.createDataFrame(amounts(), AMOUNT)
    own = zscores(with_amount_zscore(df))
    given = zscores(zscore_from_statistics(df, amount_statistics(df)))
    assert given == pytest.approx({k: v for k, v in own.items()}, nan_ok=True)


def test_a_missing_key_can_be_hot(spark):
    df = spark.createDataFrame([(None,)] * 5 + [(1,)], "customer_id bigint")
    skew = measure_skew("customer_id", [df], limit=3)
    assert skew.rows == 5
    cold, hot = skew.split(df.withColumn("x", F.lit(1)))
    assert rows(cold) == [(1, 1)] and rows(hot) == [(None, 1)] * 5


@pytest.mark.parametrize("limit", [10**6, 40])
def test_features_for_rules_do_not_depend_on_the_split(spark, limit):
    """With and without hot customers; equal to features and scores one by one."""
    tx, logins = random_events(8, 9, 150, 300)
    data = [(*t, float(t[0] % 17) or None, 40.0, -80.0, 40.0, -80.0) for t in tx]
    mart = spark.createDataFrame(
        data,
        TX + ", transaction_amount double, latitude double, longitude double,"
        " customer_home_latitude double, customer_home_longitude double",
    )
    events = spark.createDataFrame(logins, LOGIN)
    skew = measure_skew("customer_id", [mart, events], limit)
    assert (skew.hot is None) == (limit > 1000)
    none = KeySkew("customer_id", None)
    want = with_amount_zscore(enrich_transactions(mart, events, skew=none), none)
    got = enrich_for_rules(mart, events, skew=skew)

    def rounded(df):
        return rows(df.withColumn("amount_zscore", F.round("amount_zscore", 9)))

    assert rounded(got) == rounded(want)
