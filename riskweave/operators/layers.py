"""Landing and staging layers: pick, rename, clean."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import cleaned


def run_timestamp(moment: datetime | str) -> Column:
    """The one load time of a run, as a literal: never a per-row clock."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def land_customers(customers: DataFrame, loaded_at: Column) -> DataFrame:
    return customers.select(
        "CustomerID",
        "AccountCreationDate",
        "Age",
        "PastFraudCount",
        "HomeDevice",
        "HomeIP",
        "HomeLat",
        "HomeLon",
        loaded_at.alias("ingestion_date"),
    )


def land_merchants(merchants: DataFrame, loaded_at: Column) -> DataFrame:
    return merchants.select(
        "MerchantID",
        "MerchantName",
        "Category",
        "MerchantRiskScore",
        loaded_at.alias("ingestion_date"),
    )


def land_transactions(transactions: DataFrame, loaded_at: Column) -> DataFrame:
    return transactions.select(
        "TransactionID",
        "CustomerID",
        "Timestamp",
        "TransactionAmount",
        "DeviceID",
        "IP_Address",
        "Lat",
        "Lon",
        "Channel",
        "MerchantID",
        loaded_at.alias("ingestion_date"),
    )


def land_login_attempts(logins: DataFrame) -> DataFrame:
    """Logins keep the load time of their source."""
    return logins.select("CustomerID", "LoginTimestamp", "Success", "ingestion_date")


def stage_customers(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("CustomerID").alias("customer_id"),
        F.col("AccountCreationDate").alias("account_creation_date"),
        F.col("Age").alias("age"),
        F.coalesce("PastFraudCount", F.lit(0)).cast("bigint").alias("past_fraud_count"),
        cleaned(F.col("HomeDevice"), "Unknown").alias("home_device"),
        cleaned(F.col("HomeIP")).alias("home_ip"),
        F.col("HomeLat").alias("home_latitude"),
        F.col("HomeLon").alias("home_longitude"),
    )


def stage_merchants(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("MerchantID").alias("merchant_id"),
        cleaned(F.col("MerchantName"), "Unnamed Merchant").alias("merchant_name"),
        cleaned(F.col("Category"), "Uncategorized").alias("merchant_category"),
        F.coalesce("MerchantRiskScore", F.lit(0.5)).alias("merchant_risk_score"),
        "ingestion_date",
    )


def stage_transactions(landed: DataFrame) -> DataFrame:
    """An amount of zero means the amount is not known."""
    return landed.select(
        F.col("TransactionID").alias("transaction_id"),
        F.col("CustomerID").alias("customer_id"),
        F.col("MerchantID").alias("merchant_id"),
        F.col("Timestamp").alias("transaction_timestamp"),
        F.nullif(F.col("TransactionAmount"), F.lit(0.0)).alias("transaction_amount"),
        cleaned(F.col("DeviceID"), "Unknown").alias("device_id"),
        cleaned(F.col("IP_Address"), "Unknown").alias("ip_address"),
        cleaned(F.col("Channel"), "Unknown").alias("channel"),
        F.col("Lat").alias("latitude"),
        F.col("Lon").alias("longitude"),
        "ingestion_date",
    )


def stage_login_attempts(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("CustomerID").alias("customer_id"),
        F.col("LoginTimestamp").alias("login_timestamp"),
        F.col("Success").alias("is_success"),
        "ingestion_date",
    )


def latest_merchants(staged: DataFrame) -> DataFrame:
    """One row per merchant: its newest snapshot.

    Repeated loads add a snapshot per run. The snapshots of one merchant meet in
    a partial aggregate on every task, so a merchant repeated very often costs
    no more than any other. Equal load times are settled by the other columns.
    """
    payload = [name for name in staged.columns if name not in ("merchant_id", "ingestion_date")]
    newest = staged.groupBy("merchant_id").agg(
        F.max(F.struct("ingestion_date", *payload)).alias("newest")
    )
    return newest.select(
        "merchant_id",
        *[F.col(f"newest.{name}").alias(name) for name in staged.columns if name != "merchant_id"],
    )
