"""Declared schemas: no read infers anything."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


LONG, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
TEXT, BOOL, TS = T.StringType(), T.BooleanType(), T.TimestampNTZType()

# The four source tables, partition columns included.
SOURCES = {
    "customers": _struct(
        ("CustomerID", LONG),
        ("AccountCreationDate", TS),
        ("Age", LONG),
        ("AvgTransactionAmount", DOUBLE),
        ("PastFraudCount", LONG),
        ("HomeDevice", TEXT),
        ("HomeIP", TEXT),
        ("HomeLat", DOUBLE),
        ("HomeLon", DOUBLE),
        ("ingestion_date", TS),
        ("AccountCreationMonth", INT),
    ),
    "merchants": _struct(
        ("MerchantID", LONG),
        ("MerchantName", TEXT),
        ("Category", TEXT),
        ("MerchantRiskScore", DOUBLE),
        ("ingestion_date", TS),
    ),
    "transactions": _struct(
        ("TransactionID", LONG),
        ("CustomerID", LONG),
        ("Timestamp", TS),
        ("TransactionAmount", DOUBLE),
        ("DeviceID", TEXT),
        ("IP_Address", TEXT),
        ("Lat", DOUBLE),
        ("Lon", DOUBLE),
        ("Channel", TEXT),
        ("MerchantID", LONG),
        ("ingestion_date", TS),
        ("TimestampMonth", INT),
    ),
    "login_attempts": _struct(
        ("CustomerID", LONG),
        ("LoginTimestamp", TS),
        ("Success", BOOL),
        ("ingestion_date", TS),
        ("LoginTimestampMonth", INT),
    ),
}

# The column each source table is partitioned by.
PARTITION_COLUMN = {
    "customers": "AccountCreationMonth",
    "merchants": "ingestion_date",
    "transactions": "TimestampMonth",
    "login_attempts": "LoginTimestampMonth",
}

# The two published marts.
MARTS = {
    "v_transaction": _struct(
        ("transaction_id", LONG),
        ("customer_id", LONG),
        ("merchant_id", LONG),
        ("transaction_timestamp", TS),
        ("transaction_amount", DOUBLE),
        ("device_id", TEXT),
        ("ip_address", TEXT),
        ("channel", TEXT),
        ("latitude", DOUBLE),
        ("longitude", DOUBLE),
        ("transaction_time_of_day", TEXT),
        ("is_high_value_transaction", BOOL),
        ("has_elevated_fraud_risk", BOOL),
        ("distance_from_home", DOUBLE),
        ("customer_age", LONG),
        ("customer_past_fraud_count", LONG),
        ("customer_home_ip", TEXT),
        ("customer_home_latitude", DOUBLE),
        ("customer_home_longitude", DOUBLE),
        ("customer_has_fraud_history", BOOL),
        ("customer_age_tier", TEXT),
        ("customer_risk_level", TEXT),
        ("merchant_name", TEXT),
        ("merchant_risk_category", TEXT),
        ("is_high_risk_merchant", BOOL),
    ),
    "v_login_attempt": _struct(
        ("login_attempt_id", TEXT),
        ("customer_id", LONG),
        ("login_timestamp", TS),
        ("is_success", BOOL),
        ("login_month", LONG),
        ("login_year", LONG),
        ("login_day_of_week", LONG),
        ("login_hour", LONG),
        ("login_time_of_day", TEXT),
        ("is_weekend_login", BOOL),
        ("customer_risk_level", TEXT),
        ("customer_has_fraud_history", BOOL),
        ("total_login_attempts", LONG),
        ("failed_login_attempts", LONG),
        ("weekend_login_attempts", LONG),
        ("night_login_attempts", LONG),
    ),
}

ALERTS = _struct(
    ("transaction_id", TEXT),
    ("customer_id", TEXT),
    ("transaction_timestamp", TS),
    ("risk_score", INT),
    ("flags", TEXT),
)

ALERTS_TABLE = T.StructType(
    [T.StructField("id", LONG, True), *ALERTS.fields, T.StructField("inserted_at", TS, True)]
)

# The provided star-schema tables the source tables are derived from.
PROVIDED = {
    "customer": _struct(
        ("c_custkey", LONG),
        ("c_name", TEXT),
        ("c_nationkey", INT),
        ("c_acctbal", DOUBLE),
        ("c_mktsegment", TEXT),
    ),
    "supplier": _struct(
        ("s_suppkey", LONG),
        ("s_name", TEXT),
        ("s_nationkey", INT),
        ("s_acctbal", DOUBLE),
    ),
    "events": _struct(
        ("event_id", LONG),
        ("ts", TS),
        ("user_id", LONG),
        ("event_type", TEXT),
        ("value", DOUBLE),
        ("props", TEXT),
    ),
}
