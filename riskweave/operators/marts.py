"""The two published marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.facts import transactions_with_customer
from riskweave.schemas import MARTS


def transaction_mart(staged: DataFrame, profile: DataFrame, merchants: DataFrame) -> DataFrame:
    """Transactions with the risk context of customer and merchant.

    A merchant present in several snapshots repeats the transaction, as a left
    join does; ``latest_merchants`` beforehand avoids that. Merchants come first
    so that, where shuffles are needed, the rows end up partitioned by customer,
    which is what the features are computed by.
    """
    context = merchants.select(
        "merchant_id", "merchant_name", "merchant_risk_category", "is_high_risk_merchant"
    )
    with_merchant = staged.drop("ingestion_date").join(context, "merchant_id", "left")
    mart = transactions_with_customer(with_merchant, profile, keep=context.columns[1:])
    return mart.select(*MARTS["v_transaction"].names)


def login_mart(fact: DataFrame, profile: DataFrame) -> DataFrame:
    risk = profile.select(
        "customer_id",
        F.col("risk_level").alias("customer_risk_level"),
        F.col("has_fraud_history").alias("customer_has_fraud_history"),
    )
    return fact.join(risk, "customer_id", "left").select(*MARTS["v_login_attempt"].names)
