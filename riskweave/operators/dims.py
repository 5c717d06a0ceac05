"""Customer and merchant dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import columns as C
from riskweave.operators.ordered import dense_key_by

CUSTOMER_COLUMNS = (
    "customer_sk",
    "customer_id",
    "account_creation_date",
    "age",
    "past_fraud_count",
    "home_device",
    "home_ip",
    "home_latitude",
    "home_longitude",
    "has_fraud_history",
    "account_age_days",
    "account_creation_month",
    "account_creation_year",
    "age_tier",
    "risk_level",
)


def customer_profile(staged: DataFrame, as_of: date | str) -> DataFrame:
    """The customer dimension without its surrogate key.

    Facts and marts join on the business key, so they use this lazy frame and
    never pay for the numbering.
    """
    created = F.col("account_creation_date").cast("date")
    return staged.select(
        *staged.columns,
        (F.col("past_fraud_count") > 0).alias("has_fraud_history"),
        C.account_age_day_part(created, F.lit(str(as_of)).cast("date")).alias("account_age_days"),
        F.month("account_creation_date").cast("bigint").alias("account_creation_month"),
        F.year("account_creation_date").cast("bigint").alias("account_creation_year"),
        C.age_tier(F.col("age")).alias("age_tier"),
        C.customer_risk_level(F.col("past_fraud_count")).alias("risk_level"),
    )


def customer_dimension(staged: DataFrame, as_of: date | str) -> DataFrame:
    """The customer dimension, numbered 1..n in the order of customer_id."""
    profile = customer_profile(staged, as_of)
    return dense_key_by(profile, "customer_id", "customer_sk").select(*CUSTOMER_COLUMNS)


def account_age(staged: DataFrame, as_of: date | str) -> DataFrame:
    """Both readings of the account's age: day component and whole days."""
    created = F.col("account_creation_date").cast("date")
    today = F.lit(str(as_of)).cast("date")
    return staged.select(
        "customer_id",
        C.account_age_day_part(created, today).alias("account_age_days"),
        C.account_age_total_days(created, today).alias("account_age_total_days"),
    )


def merchant_dimension(staged: DataFrame) -> DataFrame:
    score = F.col("merchant_risk_score")
    return staged.select(
        "merchant_id",
        "merchant_name",
        "merchant_category",
        "merchant_risk_score",
        "ingestion_date",
        (score >= C.HIGH_RISK_MERCHANT_FROM).alias("is_high_risk_merchant"),
        C.merchant_risk_category(score).alias("merchant_risk_category"),
    )


def category_risk_map(staged: DataFrame) -> DataFrame:
    """Each merchant with the risk score its category stands for."""
    return staged.select(
        "merchant_id",
        "merchant_category",
        C.category_risk(F.col("merchant_category")).alias("category_risk_score"),
    )
