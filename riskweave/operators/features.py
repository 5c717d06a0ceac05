"""Behavioural features of transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.functions import columns as C
from riskweave.operators.login_context import (
    FAILED,
    LAST,
    LOOKBACK_HOURS,
    context_by_segments,
    context_by_window,
    timeline_partitions,
    with_login_context,
)
from riskweave.operators.skew import KeySkew, measure_skew

LOGIN_FLAGS = ("odd_hours", "weekend_login", "night_login")
FEATURES = ("failed_logins_24h", "geo_mismatch", *LOGIN_FLAGS)


def last_logins(transactions: DataFrame, logins: DataFrame, **options) -> DataFrame:
    """As-of join: each transaction with its customer's last login."""
    return with_login_context(transactions, logins, **options).select(
        "transaction_id",
        "customer_id",
        "transaction_timestamp",
        F.col(f"{LAST}.login_attempt_id").alias("last_login_attempt_id"),
        F.col(f"{LAST}.login_timestamp").alias("last_login_timestamp"),
    )


def failed_logins(transactions: DataFrame, logins: DataFrame, **options) -> DataFrame:
    """Each transaction with the number of failed logins in the look-back."""
    return with_login_context(transactions, logins, **options).select(
        "transaction_id",
        "customer_id",
        "transaction_timestamp",
        F.col(FAILED).alias("failed_logins_24h"),
    )


def _login_flags(logins: DataFrame) -> DataFrame:
    """What the features need of a login; flags instead of text keep the shuffle small.

    ``night_login`` looks at the customer's lifetime count of night logins, later
    ones included, as the published feature does.
    """
    flags = {
        "odd_hours": F.col("login_time_of_day") == C.LOGIN_NIGHT,
        "weekend_login": F.col("is_weekend_login"),
        "night_login": F.col("night_login_attempts") > 0,
    }
    return logins.select(
        "customer_id",
        "login_timestamp",
        "login_attempt_id",
        "is_success",
        *[flag.alias(name) for name, flag in flags.items()],
    )


def _with_features(context: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The five behavioural features behind the given columns."""
    mismatch = C.geo_mismatch(
        F.col("latitude"),
        F.col("longitude"),
        F.col("customer_home_latitude"),
        F.col("customer_home_longitude"),
    )
    return context.select(
        *columns,
        F.col(FAILED).alias("failed_logins_24h"),
        mismatch.alias("geo_mismatch"),
        *[C.or_false(F.col(f"{LAST}.{flag}")).alias(flag) for flag in LOGIN_FLAGS],
    )


def ordinary_features(
    transactions: DataFrame, logins: DataFrame, zscore: bool, hours: int = LOOKBACK_HOURS
) -> DataFrame:
    """Features for customers that fit one task: one exchange, also with ``zscore``."""
    context = context_by_window(transactions, _login_flags(logins), hours, LOGIN_FLAGS)
    enriched = _with_features(context, transactions.columns)
    return _zscore_by_window(enriched) if zscore else enriched


def hot_features(
    transactions: DataFrame,
    logins: DataFrame,
    zscore: bool,
    skew: KeySkew,
    hours: int = LOOKBACK_HOURS,
) -> DataFrame:
    """The same for hot customers, none of which is ever in one task.

    Amount statistics come from the transactions as given, not from their
    enriched form.
    """
    partitions = timeline_partitions(transactions, skew)
    context = context_by_segments(
        transactions, _login_flags(logins), hours, LOGIN_FLAGS, partitions
    )
    enriched = _with_features(context, transactions.columns)
    if not zscore:
        return enriched
    return zscore_from_statistics(enriched, amount_statistics(transactions))


def _features(
    transactions: DataFrame, logins: DataFrame, zscore: bool, hours: int, skew: KeySkew | None
) -> DataFrame:
    skew = skew or measure_skew("customer_id", [transactions, logins])
    cold_tx, hot_tx = skew.split(transactions)
    cold_logins, hot_logins = skew.split(logins)
    ordinary = ordinary_features(cold_tx, cold_logins, zscore, hours)
    if hot_tx is None:
        return ordinary
    return ordinary.unionByName(hot_features(hot_tx, hot_logins, zscore, skew, hours))


def features_from_flags(
    transactions: DataFrame,
    logins: DataFrame,
    hours: int = LOOKBACK_HOURS,
    skew: KeySkew | None = None,
) -> DataFrame:
    """``enrich_transactions`` for logins that already carry the flags of ``LOGIN_FLAGS``."""
    context = with_login_context(transactions, logins, hours, skew, LOGIN_FLAGS)
    return _with_features(context, transactions.columns)


def enrich_transactions(
    transactions: DataFrame,
    logins: DataFrame,
    hours: int = LOOKBACK_HOURS,
    skew: KeySkew | None = None,
) -> DataFrame:
    """Mart transactions plus the five behavioural features."""
    return _features(transactions, logins, False, hours, skew)


def enrich_for_rules(
    transactions: DataFrame,
    logins: DataFrame,
    hours: int = LOOKBACK_HOURS,
    skew: KeySkew | None = None,
) -> DataFrame:
    """``enrich_transactions`` plus ``amount_zscore``."""
    return _features(transactions, logins, True, hours, skew)


def amount_statistics(transactions: DataFrame) -> DataFrame:
    """Mean and population deviation of the amount per customer."""
    return transactions.groupBy("customer_id").agg(
        F.avg("transaction_amount").alias("amount_mean"),
        F.stddev_pop("transaction_amount").alias("amount_deviation"),
    )


def _zscore(mean: Column, deviation: Column) -> Column:
    """A deviation of zero divides by one."""
    divisor = F.when(deviation == 0, 1.0).otherwise(deviation)
    return ((F.col("transaction_amount") - mean) / divisor).alias("amount_zscore")


def zscore_from_statistics(transactions: DataFrame, statistics: DataFrame) -> DataFrame:
    """Add ``amount_zscore`` from given per-customer statistics."""
    joined = transactions.join(statistics, "customer_id", "left")
    return joined.select(
        *transactions.columns, _zscore(F.col("amount_mean"), F.col("amount_deviation"))
    )


def _zscore_by_window(transactions: DataFrame) -> DataFrame:
    """Keeps a partitioning by customer: no shuffle if there is one already."""
    customer = Window.partitionBy("customer_id")
    amount = F.col("transaction_amount")
    score = _zscore(F.avg(amount).over(customer), F.stddev_pop(amount).over(customer))
    known = F.when(F.col("customer_id").isNotNull(), score)
    return transactions.select("*", known.alias("amount_zscore"))


def with_amount_zscore(transactions: DataFrame, skew: KeySkew | None = None) -> DataFrame:
    """Add ``amount_zscore`` within the customer's own transactions.

    Ordinary customers use a window. Hot customers are aggregated before the
    shuffle and their few statistics joined back. Transactions without a customer
    or without an amount have no score.
    """
    skew = skew or measure_skew("customer_id", [transactions])
    cold, hot = skew.split(transactions)
    scored = _zscore_by_window(cold)
    if hot is None:
        return scored
    return scored.unionByName(zscore_from_statistics(hot, amount_statistics(hot)))


def feature_means(enriched: DataFrame) -> DataFrame:
    """Mean of each behavioural feature, booleans as 0 and 1."""
    return enriched.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in FEATURES])
