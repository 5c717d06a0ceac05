"""Transaction and login facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import columns as C

TRANSACTION_COLUMNS = (
    "transaction_id",
    "customer_id",
    "merchant_id",
    "transaction_timestamp",
    "transaction_amount",
    "device_id",
    "ip_address",
    "channel",
    "latitude",
    "longitude",
    "transaction_time_of_day",
    "is_high_value_transaction",
    "has_elevated_fraud_risk",
    "distance_from_home",
)

# Customer attributes a mart publishes, by their name in the mart.
MART_CUSTOMER_COLUMNS = {
    "customer_age": "age",
    "customer_past_fraud_count": "past_fraud_count",
    "customer_home_ip": "home_ip",
    "customer_home_latitude": "home_latitude",
    "customer_home_longitude": "home_longitude",
    "customer_has_fraud_history": "has_fraud_history",
    "customer_age_tier": "age_tier",
    "customer_risk_level": "risk_level",
}


def amount_tiers(staged: DataFrame) -> DataFrame:
    """Amount tier of each transaction; not part of the published fact."""
    return staged.select(
        "transaction_id",
        "transaction_amount",
        C.amount_tier(F.col("transaction_amount")).alias("transaction_amount_tier"),
    )


def transactions_with_customer(
    staged: DataFrame, profile: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """The fact's columns, the mart's customer attributes, and ``keep``.

    Fact and mart need the same customer row, so it is joined once for both;
    customer_id is unique in the dimension (see the quality checks). No size is
    assumed for either side: the adaptive planner broadcasts the dimension when
    its measured size allows and otherwise splits oversized customers.
    """
    attributes = profile.select(
        "customer_id",
        *[F.col(source).alias(name) for name, source in MART_CUSTOMER_COLUMNS.items()],
    )
    amount = F.col("transaction_amount")
    high_value = C.is_high_value(amount)
    fact = {
        "transaction_time_of_day": C.transaction_time_of_day(F.col("transaction_timestamp")),
        "is_high_value_transaction": high_value,
        "has_elevated_fraud_risk": C.elevated_fraud_risk(
            F.col("customer_risk_level"), F.col("customer_has_fraud_history"), high_value, amount
        ),
        "distance_from_home": C.degrees_between(
            F.col("customer_home_latitude"),
            F.col("customer_home_longitude"),
            F.col("latitude"),
            F.col("longitude"),
        ),
    }
    joined = staged.join(attributes, "customer_id", "left").withColumns(fact)
    return joined.select(*TRANSACTION_COLUMNS, *MART_CUSTOMER_COLUMNS, *keep)


def transaction_fact(staged: DataFrame, profile: DataFrame) -> DataFrame:
    return transactions_with_customer(staged, profile).select(*TRANSACTION_COLUMNS)


def _login_parts(staged: DataFrame) -> DataFrame:
    ts = F.col("login_timestamp")
    return staged.select(
        "customer_id",
        "login_timestamp",
        "is_success",
        F.month(ts).cast("bigint").alias("login_month"),
        F.year(ts).cast("bigint").alias("login_year"),
        C.sunday_based_weekday(ts).alias("login_day_of_week"),
        F.hour(ts).cast("bigint").alias("login_hour"),
        C.login_time_of_day(ts).alias("login_time_of_day"),
        C.is_weekend(ts).alias("is_weekend_login"),
    )


def customer_login_metrics(staged: DataFrame) -> DataFrame:
    """Lifetime login counts per customer."""
    return (
        _login_parts(staged)
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("total_login_attempts"),
            F.count_if(~F.col("is_success")).alias("failed_login_attempts"),
            F.count_if("is_weekend_login").alias("weekend_login_attempts"),
            F.count_if(F.col("login_time_of_day") == C.LOGIN_NIGHT).alias("night_login_attempts"),
        )
    )


def login_keys(staged: DataFrame) -> DataFrame:
    return staged.select(
        "customer_id",
        "login_timestamp",
        C.surrogate_key(F.col("customer_id"), F.col("login_timestamp")).alias("login_attempt_id"),
    )


def login_fact(staged: DataFrame) -> DataFrame:
    """Each login with its parts and its customer's lifetime counts.

    The counts are aggregated before the shuffle and joined back. A window over
    the customer would read the logins once less, but holds all logins of a
    customer in one task; the join's oversized partitions can be split. Logins
    without a customer find no counts.
    """
    parts = _login_parts(staged)
    joined = parts.join(customer_login_metrics(staged), "customer_id", "left")
    key = C.surrogate_key(F.col("customer_id"), F.col("login_timestamp"))
    return joined.select(
        key.alias("login_attempt_id"),
        *parts.columns,
        "total_login_attempts",
        "failed_login_attempts",
        "weekend_login_attempts",
        "night_login_attempts",
    )
