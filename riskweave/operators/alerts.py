"""Alerts, who to notify, and the riskiest customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.schemas import ALERTS

# What an alert raised by the model carries, and the message sent.
MODEL_RISK_SCORE = 1
MODEL_FLAG = "ML_MODEL"
MESSAGE = "Sending email to customer %s..."


def _as_alerts(df: DataFrame, risk_score: Column, flags: Column) -> DataFrame:
    columns = {
        "transaction_id": F.col("transaction_id"),
        "customer_id": F.col("customer_id"),
        "transaction_timestamp": F.col("transaction_timestamp"),
        "risk_score": risk_score,
        "flags": flags,
    }
    return df.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in ALERTS])


def rule_alerts(scored: DataFrame) -> DataFrame:
    """An alert, with score and flags, for every transaction labelled 1."""
    return _as_alerts(scored.where("label = 1"), F.col("risk_score"), F.col("flags"))


def model_alerts(predictions: DataFrame) -> DataFrame:
    """An alert for every transaction the model predicts as fraud."""
    return _as_alerts(
        predictions.where("prediction = 1"), F.lit(MODEL_RISK_SCORE), F.lit(MODEL_FLAG)
    )


def alert_kind() -> Column:
    """Who raised an alert: the model or the rules."""
    return F.when(F.col("flags") == MODEL_FLAG, "model").otherwise("rules")


def one_per_key(alerts: DataFrame) -> DataFrame:
    """One alert for each transaction and kind, of several the highest by score and flags."""
    rest = [c for c in alerts.columns if c not in ("transaction_id", "risk_score", "flags")]
    highest = F.max(F.struct("risk_score", "flags", *rest)).alias("_alert")
    best = alerts.groupBy("transaction_id", alert_kind().alias("_kind")).agg(highest)
    return best.select("transaction_id", "_alert.*").select(*alerts.columns)


def new_alerts(alerts: DataFrame, stored: DataFrame) -> DataFrame:
    """One alert for each transaction and kind that has none yet."""
    known = stored.select("transaction_id", alert_kind().alias("_kind"))
    fresh = one_per_key(alerts).withColumn("_kind", alert_kind())
    return fresh.join(known, ["transaction_id", "_kind"], "left_anti").select(*alerts.columns)


def top_risky_customers(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Customers by total risk score, highest first, equal totals by id."""
    totals = alerts.groupBy("customer_id").agg(F.sum("risk_score").alias("total_risk_score"))
    return totals.orderBy(F.desc("total_risk_score"), "customer_id").limit(n)


def notification_feed(alerts: DataFrame) -> DataFrame:
    """One message per alert."""
    message = F.format_string(MESSAGE, "customer_id")
    return alerts.select("transaction_id", "customer_id", message.alias("message"))


def customers_to_notify(alerts: DataFrame) -> DataFrame:
    """One message per customer, however many alerts there are."""
    return notification_feed(alerts).select("customer_id", "message").distinct()
