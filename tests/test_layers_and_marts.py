from __future__ import annotations

from datetime import date, datetime

import pytest

from riskweave.operators import dims, layers, marts
from riskweave.plans.warehouse import Warehouse
from riskweave.schemas import MARTS, SOURCES
from riskweave.sources.tables import conform
from tests.conftest import at, rows

CUSTOMER = (
    "CustomerID bigint, AccountCreationDate timestamp_ntz, Age bigint, PastFraudCount bigint,"
    " HomeDevice string, HomeIP string, HomeLat double, HomeLon double"
)
MERCHANT = "MerchantID bigint, MerchantName string, Category string, MerchantRiskScore double"
TRANSACTION = (
    "TransactionID bigint, CustomerID bigint, Timestamp timestamp_ntz, TransactionAmount double,"
    " DeviceID string, IP_Address string, Lat double, Lon double, Channel string,"
    " MerchantID bigint"
)
LOGIN = (
    "CustomerID bigint, LoginTimestamp timestamp_ntz, Success boolean,"
    " ingestion_date timestamp_ntz"
)


@pytest.fixture
def warehouse(spark):
    created = datetime(2020, 1, 1)
    customers = [
        (1, created, 30, None, None, " 1.1.1.1 ", 40.0, -80.0),
        (2, created, None, 6, " dev ", None, None, None),
    ]
    merchants = [(10, None, None, None), (11, " Shop ", "Crypto", 0.7)]
    transactions = [
        (100, 1, at("05 06:30"), 0.0, None, None, 40.0, -80.0, None, 10),
        (101, 2, at("05 07:00"), 151.0, " d ", " 9.9.9.9", 41.0, -81.0, " ATM ", 11),
        (102, 3, at("05 18:00"), 10.0, "d", "i", 41.0, -81.0, "POS", 99),
        (103, None, at("05 18:00"), 10.0, "d", "i", 41.0, -81.0, "POS", None),
    ]
    logins = [
        (1, at("06 03:00"), False, at("06 03:00")),
        (1, at("05 12:00"), True, at("05 12:00")),
        (None, at("05 12:00"), False, at("05 12:00")),
    ]
    return Warehouse(
        {
            "customers": spark.createDataFrame(customers, CUSTOMER),
            "merchants": spark.createDataFrame(merchants, MERCHANT),
            "transactions": spark.createDataFrame(transactions, TRANSACTION),
            "login_attempts": spark.createDataFrame(logins, LOGIN),
        },
        "2024-02-01 00:00:00",
        date(2024, 2, 1),
    )


def test_run_timestamp_is_one_literal(warehouse):
    for name in ("landing_customer", "landing_merchant", "landing_transaction"):
        stamps = {r[0] for r in getattr(warehouse, name).select("ingestion_date").collect()}
        assert stamps == {datetime(2024, 2, 1)}
    kept = {r[0] for r in warehouse.landing_login_attempt.select("ingestion_date").collect()}
    assert kept == {at("06 03:00"), at("05 12:00")}


def test_staging_defaults(warehouse):
    got = rows(warehouse.stg_customer, "customer_id", "past_fraud_count", "home_device", "home_ip")
    assert got == [(1, 0, "Unknown", "1.1.1.1"), (2, 6, "dev", None)]
    got = rows(warehouse.stg_merchant.drop("ingestion_date"))
    assert got == [
        (10, "Unnamed Merchant", "Uncategorized", 0.5),
        (11, "Shop", "Crypto", 0.7),
    ]
    got = rows(
        warehouse.stg_transaction.where("transaction_id < 102"),
        "transaction_id",
        "transaction_amount",
        "device_id",
        "ip_address",
        "channel",
    )
    assert got == [(100, None, "Unknown", "Unknown", "Unknown"), (101, 151.0, "d", "9.9.9.9", "ATM")]


def test_staging_merchant_without_score_is_high_risk(warehouse):
    got = rows(
        warehouse.dim_merchant, "merchant_id", "merchant_risk_category", "is_high_risk_merchant"
    )
    assert got == [(10, "High Risk", False), (11, "High Risk", True)]


def test_mart_keeps_unmatched_rows(warehouse):
    mart = warehouse.v_transaction
    assert mart.columns == MARTS["v_transaction"].names
    got = rows(
        mart,
        "transaction_id",
        "customer_risk_level",
        "merchant_name",
        "has_elevated_fraud_risk",
        "distance_from_home",
    )
    assert got == [
        (100, "Low", "Unnamed Merchant", False, 0.0),
        (101, "High", "Shop", True, None),
        (102, None, None, False, None),
        (103, None, None, False, None),
    ]


def test_fact_has_the_rows_of_staging(warehouse):
    assert warehouse.fact_transaction.count() == warehouse.stg_transaction.count()
    assert warehouse.fact_login_attempt.count() == warehouse.stg_login_attempt.count()


def test_repeated_merchants_repeat_transactions(warehouse):
    again = warehouse.stg_merchant.unionByName(warehouse.stg_merchant)
    mart = marts.transaction_mart(
        warehouse.stg_transaction, warehouse.customer_profile, dims.merchant_dimension(again)
    )
    assert mart.count() == 6
    once = marts.transaction_mart(
        warehouse.stg_transaction,
        warehouse.customer_profile,
        dims.merchant_dimension(layers.latest_merchants(again)),
    )
    assert once.count() == 4


def test_latest_snapshot_wins_whole(spark):
    schema = "merchant_id bigint, merchant_name string, merchant_category string,"
    schema += " merchant_risk_score double, ingestion_date timestamp_ntz"
    snapshots = [
        (1, "old", "Retail", 0.9, at("01 00:00")),
        (1, "new", "Crypto", 0.1, at("02 00:00")),
        (2, "only", "Retail", 0.2, at("01 00:00")),
    ]
    got = rows(layers.latest_merchants(spark.createDataFrame(snapshots, schema)))
    assert got == [snapshots[1], snapshots[2]]


def test_login_counts(warehouse):
    got = rows(
        warehouse.fact_login_attempt,
        "customer_id",
        "login_hour",
        "is_weekend_login",
        "total_login_attempts",
        "failed_login_attempts",
        "weekend_login_attempts",
        "night_login_attempts",
    )
    # Saturday 6th at night, Friday 5th at noon; no counts without a customer.
    assert got == [
        (1, 12, False, 2, 1, 1, 1),
        (1, 3, True, 2, 1, 1, 1),
        (None, 12, False, None, None, None, None),
    ]


def test_login_mart_columns(warehouse):
    mart = warehouse.v_login_attempt
    assert mart.columns == MARTS["v_login_attempt"].names
    assert mart.count() == 3


def test_mart_types_match_the_declared_schemas(warehouse):
    for name in MARTS:
        got = {f.name: f.dataType for f in getattr(warehouse, name).schema}
        assert got == {f.name: f.dataType for f in MARTS[name]}


def test_conform_fills_declared_columns(warehouse):
    customers = conform("customers", warehouse.sources["customers"])
    assert customers.schema.names == SOURCES["customers"].names
    assert {r[0] for r in customers.select("AccountCreationMonth").collect()} == {1}
