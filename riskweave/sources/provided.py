"""The four source tables, derived from the provided star schema.

The text of each query is portable: the tests' reference database runs the same
text with the table names filled in, so both engines start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.schemas import PROVIDED

DERIVATIONS = {
    "customers": """
        SELECT c_custkey AS CustomerID,
          DATE '2020-01-01' + CAST(c_custkey % 1000 AS INT) AS AccountCreationDate,
          CASE WHEN c_custkey % 37 = 5 THEN NULL ELSE 18 + c_custkey % 60 END AS Age,
          CAST(CASE WHEN c_custkey % 41 = 4 THEN NULL WHEN c_custkey % 50 = 7 THEN 6
                    WHEN c_custkey % 25 = 3 THEN 3 WHEN c_custkey % 10 = 0 THEN 1
                    ELSE 0 END AS BIGINT) AS PastFraudCount,
          CASE WHEN c_custkey % 53 = 6 THEN NULL
               ELSE ' dev_' || CAST(1000 + c_custkey % 9000 AS STRING) || ' ' END AS HomeDevice,
          '192.168.' || CAST(c_custkey % 255 AS STRING) || '.'
                     || CAST(c_custkey % 7 AS STRING) || ' ' AS HomeIP,
          CASE WHEN c_custkey % 43 = 8 THEN NULL
               ELSE 3e1 + CAST(c_custkey % 150 AS DOUBLE) * 1e-1 END AS HomeLat,
          CASE WHEN c_custkey % 43 = 8 THEN NULL
               ELSE -1e2 + CAST(c_custkey % 300 AS DOUBLE) * 1e-1 END AS HomeLon
        FROM {customer}""",
    "merchants": """
        SELECT s_suppkey AS MerchantID,
          CASE WHEN s_suppkey % 17 = 9 THEN NULL ELSE ' ' || s_name || ' ' END AS MerchantName,
          CASE s_suppkey % 7 WHEN 0 THEN 'Groceries' WHEN 1 THEN 'Retail' WHEN 2 THEN 'Travel'
               WHEN 3 THEN 'Online' WHEN 4 THEN 'Gambling' WHEN 5 THEN 'Crypto' END AS Category,
          CASE s_suppkey % 7 WHEN 0 THEN 1e-1 WHEN 1 THEN 2e-1 WHEN 2 THEN 15e-2
               WHEN 3 THEN 25e-2 WHEN 4 THEN 8e-1 WHEN 5 THEN 7e-1 END AS MerchantRiskScore
        FROM {supplier}""",
    "transactions": """
        SELECT event_id AS TransactionID,
          CASE WHEN event_id % 97 = 1 THEN CAST(-1 AS BIGINT) ELSE user_id END AS CustomerID,
          ts AS Timestamp,
          CASE WHEN event_id % 89 = 2 THEN 0e0 WHEN event_id % 61 = 3 THEN value * 2e1
               ELSE value * 2e0 END AS TransactionAmount,
          CASE WHEN event_id % 31 = 4 THEN NULL
               ELSE ' dev_' || CAST(1000 + user_id % 9000 AS STRING) END AS DeviceID,
          CASE WHEN event_id % 29 = 5 THEN NULL
               ELSE '10.0.' || CAST(event_id % 255 AS STRING) || '.1 ' END AS IP_Address,
          3e1 + CAST(user_id % 150 AS DOUBLE) * 1e-1
              + CASE WHEN event_id % 10 = 0 THEN 15e-1 ELSE 1e-3 END AS Lat,
          -1e2 + CAST(user_id % 300 AS DOUBLE) * 1e-1
               + CASE WHEN event_id % 10 = 0 THEN 25e-1 ELSE 2e-3 END AS Lon,
          CASE event_id % 6 WHEN 0 THEN 'Online' WHEN 1 THEN 'POS' WHEN 2 THEN 'ATM'
               WHEN 3 THEN 'MobileApp' WHEN 4 THEN 'Web' END AS Channel,
          event_id % 103 AS MerchantID
        FROM {events} WHERE event_type = 'purchase'""",
    "login_attempts": """
        SELECT user_id AS CustomerID, ts AS LoginTimestamp,
          event_type NOT IN ('error', 'signup') AS Success, ts AS ingestion_date
        FROM {events} WHERE event_type <> 'purchase'""",
}

_ORIGIN = {
    "customers": "customer",
    "merchants": "supplier",
    "transactions": "events",
    "login_attempts": "events",
}


def provided_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(PROVIDED[name]).parquet(f"{folder}/{name}.parquet")


def derive_source(name: str, origin: DataFrame) -> DataFrame:
    """One source table from its star-schema origin; works on streams too."""
    return origin.sparkSession.sql(DERIVATIONS[name], **{_ORIGIN[name]: origin})


def provided_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four source tables of one data folder."""
    return {
        name: derive_source(name, provided_table(spark, folder, origin))
        for name, origin in _ORIGIN.items()
    }


def stored_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The same with the types that the files have, whatever is declared."""
    return {
        name: derive_source(name, spark.read.parquet(f"{folder}/{origin}.parquet"))
        for name, origin in _ORIGIN.items()
    }
