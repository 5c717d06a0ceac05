"""The SQL twin of each query, for a single-node engine over the same tables.

Every statement is written against the provided tables alone. It states the
result in the plainest relational way and shares nothing with the Spark side but
the text that derives the source tables and the fixed values.
"""

from __future__ import annotations

from riskweave.functions.columns import CATEGORY_RISK
from riskweave.sources.provided import DERIVATIONS

_RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"
_AS_OF = "DATE '2024-02-01'"

_SOURCES = {
    name: text.format(customer="customer", supplier="supplier", events="events")
    for name, text in DERIVATIONS.items()
}

# The rules' weights, and their names in the order they are listed.
_SCORE = """(f1::INT + 2 * f2::INT + 2 * f3::INT + 2 * f4::INT + 2 * f5::INT
             + f6::INT + f7::INT + f8::INT + 2 * f9::INT)::INT"""
_FLAGS = """concat_ws(',', CASE WHEN f1 THEN 'FAILED_LOGIN' END,
    CASE WHEN f2 THEN 'GEO_MISMATCH' END, CASE WHEN f3 THEN 'HIGH_RISK_MERCHANT' END,
    CASE WHEN f4 THEN 'CUSTOMER_RISK' END, CASE WHEN f5 THEN 'PAST_FRAUD' END,
    CASE WHEN f6 THEN 'ODD_HOURS' END, CASE WHEN f7 THEN 'WEEKEND_LOGIN' END,
    CASE WHEN f8 THEN 'NIGHT_LOGIN' END, CASE WHEN f9 THEN 'AMOUNT_OUTLIER' END)"""

# Named steps in dependency order; a statement may select from any of them.
_STEPS = {
    **_SOURCES,
    "landing_customer": f"""
        SELECT CustomerID, AccountCreationDate, Age, PastFraudCount, HomeDevice, HomeIP,
               HomeLat, HomeLon, {_RUN_TS} AS ingestion_date
        FROM customers""",
    "landing_merchant": f"""
        SELECT MerchantID, MerchantName, Category, MerchantRiskScore,
               {_RUN_TS} AS ingestion_date
        FROM merchants""",
    "landing_transaction": f"""
        SELECT TransactionID, CustomerID, Timestamp, TransactionAmount, DeviceID, IP_Address,
               Lat, Lon, Channel, MerchantID, {_RUN_TS} AS ingestion_date
        FROM transactions""",
    "landing_login_attempt": """
        SELECT CustomerID, LoginTimestamp, Success, ingestion_date FROM login_attempts""",
    "stg_customer": """
        SELECT CustomerID AS customer_id, AccountCreationDate AS account_creation_date,
               Age AS age, ifnull(PastFraudCount, 0) AS past_fraud_count,
               trim(ifnull(HomeDevice, 'Unknown')) AS home_device, trim(HomeIP) AS home_ip,
               HomeLat AS home_latitude, HomeLon AS home_longitude
        FROM landing_customer""",
    "stg_merchant": """
        SELECT MerchantID AS merchant_id,
               trim(ifnull(MerchantName, 'Unnamed Merchant')) AS merchant_name,
               trim(ifnull(Category, 'Uncategorized')) AS merchant_category,
               ifnull(MerchantRiskScore, 5e-1) AS merchant_risk_score, ingestion_date
        FROM landing_merchant""",
    "stg_transaction": """
        SELECT TransactionID AS transaction_id, CustomerID AS customer_id,
               MerchantID AS merchant_id, Timestamp AS transaction_timestamp,
               CASE WHEN TransactionAmount <> 0 THEN TransactionAmount END AS transaction_amount,
               trim(ifnull(DeviceID, 'Unknown')) AS device_id,
               trim(ifnull(IP_Address, 'Unknown')) AS ip_address,
               trim(ifnull(Channel, 'Unknown')) AS channel,
               Lat AS latitude, Lon AS longitude, ingestion_date
        FROM landing_transaction""",
    "stg_login_attempt": """
        SELECT CustomerID AS customer_id, LoginTimestamp AS login_timestamp,
               Success AS is_success, ingestion_date
        FROM landing_login_attempt""",
    "dim_customer": f"""
        SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, s.*,
               past_fraud_count > 0 AS has_fraud_history,
               date_part('day', age({_AS_OF}, account_creation_date)) AS account_age_days,
               month(account_creation_date) AS account_creation_month,
               year(account_creation_date) AS account_creation_year,
               -- Fixed values: the age bands and the fraud counts above which a level starts.
               CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 25 THEN 'Under 25'
                    WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
                    WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64'
                    ELSE '65+' END AS age_tier,
               CASE WHEN past_fraud_count > 5 THEN 'High' WHEN past_fraud_count > 2
                    THEN 'Medium' ELSE 'Low' END AS risk_level
        FROM stg_customer s""",
    "dim_merchant": """
        SELECT s.*, merchant_risk_score >= 7e-1 AS is_high_risk_merchant,
               CASE WHEN merchant_risk_score < 2e-1 THEN 'Low Risk'
                    WHEN merchant_risk_score < 5e-1 THEN 'Medium Risk'
                    ELSE 'High Risk' END AS merchant_risk_category
        FROM stg_merchant s""",
    "fact_transaction": """
        SELECT transaction_id, customer_id, merchant_id, transaction_timestamp,
               transaction_amount, device_id, ip_address, channel, latitude, longitude,
               CASE WHEN hour(transaction_timestamp) <= 6 THEN 'Night (12AM-6AM)'
                    WHEN hour(transaction_timestamp) <= 11 THEN 'Morning (7AM-11AM)'
                    WHEN hour(transaction_timestamp) <= 17 THEN 'Afternoon (12PM-5PM)'
                    ELSE 'Evening (6PM-11PM)' END AS transaction_time_of_day,
               ifnull(transaction_amount > 150, false) AS is_high_value_transaction,
               ifnull(risk_level = 'High' AND transaction_amount > 150, false)
                 OR ifnull(has_fraud_history AND transaction_amount > 500, false)
                 AS has_elevated_fraud_risk,
               round(sqrt(pow(home_latitude - latitude, 2) + pow(home_longitude - longitude, 2)),
                     9) AS distance_from_home
        FROM stg_transaction LEFT JOIN dim_customer USING (customer_id)""",
    "login_parts": """
        SELECT customer_id, login_timestamp, is_success,
               month(login_timestamp) AS login_month, year(login_timestamp) AS login_year,
               dayofweek(login_timestamp) AS login_day_of_week,
               hour(login_timestamp) AS login_hour,
               CASE hour(login_timestamp) // 6 WHEN 0 THEN 'Night (12AM-6AM)'
                    WHEN 1 THEN 'Morning (6AM-12PM)' WHEN 2 THEN 'Afternoon (12PM-6PM)'
                    ELSE 'Evening (6PM-12AM)' END AS login_time_of_day,
               isodow(login_timestamp) >= 6 AS is_weekend_login
        FROM stg_login_attempt""",
    "customer_login_metrics": """
        SELECT customer_id, count(*) AS total_login_attempts,
               count(*) FILTER (NOT is_success) AS failed_login_attempts,
               count(*) FILTER (is_weekend_login) AS weekend_login_attempts,
               count(*) FILTER (login_hour < 6) AS night_login_attempts
        FROM login_parts GROUP BY customer_id""",
    "fact_login_attempt": """
        SELECT md5(p.customer_id::VARCHAR || '-' || login_timestamp::VARCHAR)
                 AS login_attempt_id, p.*, m.* EXCLUDE (customer_id)
        FROM login_parts p LEFT JOIN customer_login_metrics m ON p.customer_id = m.customer_id""",
    "v_transaction": """
        SELECT f.*, c.age AS customer_age, c.past_fraud_count AS customer_past_fraud_count,
               c.home_ip AS customer_home_ip, c.home_latitude AS customer_home_latitude,
               c.home_longitude AS customer_home_longitude,
               c.has_fraud_history AS customer_has_fraud_history,
               c.age_tier AS customer_age_tier, c.risk_level AS customer_risk_level,
               m.merchant_name, m.merchant_risk_category, m.is_high_risk_merchant
        FROM fact_transaction f
        LEFT JOIN dim_customer c ON c.customer_id = f.customer_id
        LEFT JOIN dim_merchant m ON m.merchant_id = f.merchant_id""",
    "v_login_attempt": """
        SELECT l.*, c.risk_level AS customer_risk_level,
               c.has_fraud_history AS customer_has_fraud_history
        FROM fact_login_attempt l LEFT JOIN dim_customer c ON c.customer_id = l.customer_id""",
    "last_logins": """
        SELECT t.transaction_id, t.customer_id, t.transaction_timestamp, l.login_attempt_id,
               l.login_timestamp, l.login_hour, l.is_weekend_login, l.night_login_attempts
        FROM stg_transaction t ASOF LEFT JOIN fact_login_attempt l
          ON t.customer_id = l.customer_id AND t.transaction_timestamp >= l.login_timestamp""",
    "failures": """
        SELECT t.transaction_id, t.customer_id, t.transaction_timestamp,
               count(l.customer_id) AS failed_logins_24h
        FROM stg_transaction t LEFT JOIN stg_login_attempt l
          ON l.customer_id = t.customer_id AND NOT l.is_success
         AND l.login_timestamp BETWEEN t.transaction_timestamp - INTERVAL 24 HOUR
                                   AND t.transaction_timestamp
        GROUP BY ALL""",
    "enriched": """
        SELECT v.*, f.failed_logins_24h,
               NOT ifnull(abs(latitude - customer_home_latitude) < 1e-2
                      AND abs(longitude - customer_home_longitude) < 1e-2, false) AS geo_mismatch,
               ifnull(login_hour < 6, false) AS odd_hours,
               ifnull(is_weekend_login, false) AS weekend_login,
               ifnull(night_login_attempts > 0, false) AS night_login
        FROM v_transaction v
        JOIN failures f ON f.transaction_id = v.transaction_id
        JOIN last_logins l ON l.transaction_id = v.transaction_id""",
    "deviations": """
        SELECT customer_id, avg(transaction_amount) AS mean,
               stddev_pop(transaction_amount) AS deviation
        FROM stg_transaction GROUP BY customer_id""",
    "zscores": """
        SELECT transaction_id, t.customer_id, transaction_amount,
               round((transaction_amount - mean) / CASE deviation WHEN 0 THEN 1 ELSE deviation END,
                     6) AS amount_zscore
        FROM stg_transaction t LEFT JOIN deviations d ON d.customer_id = t.customer_id""",
    "fired": """
        SELECT e.*, amount_zscore,
               failed_logins_24h > 3 AS f1, geo_mismatch AS f2,
               ifnull(is_high_risk_merchant, false) AS f3,
               ifnull(customer_risk_level <> 'Low', false) AS f4,
               ifnull(customer_past_fraud_count > 0, false) AS f5,
               odd_hours AS f6, weekend_login AS f7, night_login AS f8,
               ifnull(abs(amount_zscore) > 3, false) AS f9
        FROM enriched e JOIN zscores z ON z.transaction_id = e.transaction_id""",
    "weighted": f"SELECT *, {_SCORE} AS risk_score, {_FLAGS} AS flags FROM fired",
    "scored": "SELECT *, (risk_score >= 5)::INT AS label FROM weighted",
    "alerts": """
        SELECT transaction_id::VARCHAR AS transaction_id, customer_id::VARCHAR AS customer_id,
               transaction_timestamp, risk_score, flags
        FROM scored WHERE label = 1""",
    "snapshots": """
        SELECT merchant_id, merchant_name, merchant_category, merchant_risk_score,
               TIMESTAMP '2024-01-01 00:00:00' AS ingestion_date FROM stg_merchant
        UNION ALL
        SELECT merchant_id, merchant_name, merchant_category, merchant_risk_score + 25e-2,
               ingestion_date FROM stg_merchant""",
    "split": """
        SELECT transaction_id, label,
               CASE WHEN 5 * row_number() OVER (PARTITION BY label
                          ORDER BY md5(transaction_id::VARCHAR), transaction_id)
                         <= count(*) OVER (PARTITION BY label)
                    THEN 'test' ELSE 'train' END AS split
        FROM scored""",
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in _STEPS.items())


def _select(statement: str) -> str:
    return f"{_WITH}\n{statement}"


# ---- data quality ----------------------------------------------------------


# The declared expectations, listed apart from the checks that run.
_EXPECTATIONS = (
    ("raw_customer", "not_null", "CustomerID"),
    ("raw_customer", "not_null", "AccountCreationDate"),
    ("raw_customer", "not_null", "Age"),
    ("raw_customer", "not_null", "PastFraudCount"),
    ("raw_customer", "not_null", "HomeDevice"),
    ("raw_customer", "not_null", "HomeIP"),
    ("raw_customer", "not_null", "HomeLat"),
    ("raw_customer", "not_null", "HomeLon"),
    ("raw_login_attempt", "not_null", "CustomerID"),
    ("raw_login_attempt", "not_null", "LoginTimestamp"),
    ("raw_login_attempt", "not_null", "Success"),
    ("raw_login_attempt", "not_null", "ingestion_date"),
    ("raw_merchant", "not_null", "MerchantID"),
    ("raw_merchant", "not_null", "MerchantName"),
    ("raw_merchant", "not_null", "Category"),
    ("raw_merchant", "not_null", "MerchantRiskScore"),
    ("raw_merchant", "not_null", "ingestion_date"),
    ("raw_transaction", "not_null", "TransactionID"),
    ("raw_transaction", "not_null", "CustomerID"),
    ("raw_transaction", "not_null", "Timestamp"),
    ("raw_transaction", "not_null", "TransactionAmount"),
    ("raw_transaction", "not_null", "DeviceID"),
    ("raw_transaction", "not_null", "IP_Address"),
    ("raw_transaction", "not_null", "Lat"),
    ("raw_transaction", "not_null", "Lon"),
    ("raw_transaction", "not_null", "Channel"),
    ("raw_transaction", "not_null", "MerchantID"),
    ("dim_customer", "not_null", "customer_sk"),
    ("dim_customer", "not_null", "customer_id"),
    ("dim_merchant", "not_null", "merchant_id"),
    ("fact_transaction", "not_null", "transaction_id"),
    ("fact_transaction", "not_null", "customer_id"),
    ("fact_transaction", "not_null", "merchant_id"),
    ("fact_login_attempt", "not_null", "login_attempt_id"),
    ("fact_login_attempt", "not_null", "customer_id"),
    ("raw_customer", "between", "Age", 18, 100),
    ("raw_customer", "between", "PastFraudCount", 0, None),
    ("raw_customer", "between", "HomeLat", -90, 90),
    ("raw_customer", "between", "HomeLon", -180, 180),
    ("raw_merchant", "between", "MerchantRiskScore", 0, 1),
    ("raw_transaction", "between", "TransactionAmount", 0, None),
    ("raw_transaction", "between", "Lat", -90, 90),
    ("raw_transaction", "between", "Lon", -180, 180),
    ("raw_login_attempt", "in_set", "Success"),
    ("raw_login_attempt", "not_constant", "CustomerID"),
    ("raw_merchant", "not_constant", "MerchantID"),
    ("raw_merchant", "not_constant", "MerchantName"),
    ("raw_merchant", "not_constant", "Category"),
    ("raw_customer", "type", "CustomerID", "bigint"),
    ("raw_login_attempt", "type", "Success", "boolean"),
    ("raw_customer", "unique", "CustomerID"),
    ("raw_transaction", "unique", "TransactionID"),
    ("dim_customer", "unique", "customer_sk"),
    ("dim_customer", "unique", "customer_id"),
    ("fact_transaction", "unique", "transaction_id"),
    ("fact_login_attempt", "unique", "login_attempt_id"),
    ("raw_login_attempt", "unique_combination", "CustomerID,LoginTimestamp"),
)


def _check_counts(wanted: str) -> str:
    """One row per expectation of a kind, each counted by its own scan."""
    landing = {
        "raw_customer": "landing_customer",
        "raw_merchant": "landing_merchant",
        "raw_transaction": "landing_transaction",
        "raw_login_attempt": "landing_login_attempt",
    }
    parts = []
    for model, kind, columns, *bounds in _EXPECTATIONS:
        if kind != wanted:
            continue
        table = landing.get(model, model)
        if kind == "not_null":
            failing = f"SELECT count(*) FROM {table} WHERE {columns} IS NULL"
        elif kind == "between":
            low, high = ("NULL" if b is None else b for b in bounds)
            failing = f"SELECT count(*) FROM {table} WHERE {columns} < {low} OR {columns} > {high}"
        elif kind == "in_set":
            failing = f"SELECT count(*) FROM {table} WHERE {columns} NOT IN (true, false)"
        elif kind == "not_constant":
            failing = f"SELECT count(DISTINCT {columns}) = 1 FROM {table}"
        elif kind == "type":
            failing = f"SELECT count(*) FROM {table} WHERE lower(typeof({columns})) <> '{bounds[0]}'"
        else:
            known = f"WHERE {columns} IS NOT NULL" if kind == "unique" else ""
            failing = (
                f"SELECT count(*) FROM (SELECT 1 FROM {table} {known}"
                f" GROUP BY {columns} HAVING count(*) > 1)"
            )
        parts.append(
            f"SELECT '{model}' AS model, '{columns}' AS column_name,"
            f" '{kind}' AS check_kind, ({failing})::BIGINT AS failing_rows"
        )
    return "\nUNION ALL\n".join(parts)


def _orphans(relation: str, child: str, parent: str, key: str) -> str:
    return f"""
        SELECT '{relation}' AS relation, count(*) AS orphan_rows,
               count(DISTINCT {key}) AS orphan_keys
        FROM {child} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent})"""


def _profile() -> str:
    columns = (
        "CustomerID",
        "AccountCreationDate",
        "Age",
        "PastFraudCount",
        "HomeDevice",
        "HomeIP",
        "HomeLat",
        "HomeLon",
    )
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, min({c})::VARCHAR AS min_value,
            max({c})::VARCHAR AS max_value, count(DISTINCT {c}) AS distinct_values,
            count(*) - count({c}) AS null_values FROM customers"""
        for c in columns
    )


def _key_types() -> str:
    relations = (
        ("tx_customer", "transactions", "customers", "CustomerID"),
        ("tx_merchant", "transactions", "merchants", "MerchantID"),
        ("login_customer", "login_attempts", "customers", "CustomerID"),
    )
    parts = [
        f"""SELECT '{name}' AS relation,
            (SELECT lower(any_value(typeof({key}))) FROM {child}) AS child_type,
            (SELECT lower(any_value(typeof({key}))) FROM {parent}) AS parent_type"""
        for name, child, parent, key in relations
    ]
    return (
        "SELECT *, (child_type <> parent_type)::BIGINT AS failing_rows FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


def _risk_case(category: str) -> str:
    whens = " ".join(f"WHEN '{name}' THEN {risk}e0" for name, risk in CATEGORY_RISK.items())
    return f"CASE {category} {whens} END"


_MART_OVER_SNAPSHOTS = """
    SELECT f.*, c.age AS customer_age, c.past_fraud_count AS customer_past_fraud_count,
           c.home_ip AS customer_home_ip, c.home_latitude AS customer_home_latitude,
           c.home_longitude AS customer_home_longitude,
           c.has_fraud_history AS customer_has_fraud_history,
           c.age_tier AS customer_age_tier, c.risk_level AS customer_risk_level,
           s.merchant_name,
           CASE WHEN s.merchant_risk_score < 2e-1 THEN 'Low Risk'
                WHEN s.merchant_risk_score < 5e-1 THEN 'Medium Risk'
                WHEN s.merchant_id IS NOT NULL THEN 'High Risk' END AS merchant_risk_category,
           s.merchant_risk_score >= 7e-1 AS is_high_risk_merchant
    FROM fact_transaction f
    LEFT JOIN dim_customer c ON c.customer_id = f.customer_id
    LEFT JOIN snapshots s ON s.merchant_id = f.merchant_id"""

_ALERTS = _select("SELECT * FROM alerts")

# Alerts over a mart that repeats transactions, one for each transaction and kind.
_ALERTS_OVER_SNAPSHOTS = f"""
    SELECT *, {_RUN_TS} AS inserted_at FROM (
      WITH mart AS ({_MART_OVER_SNAPSHOTS}),
      spread AS (SELECT customer_id, avg(transaction_amount) AS mean,
                        stddev_pop(transaction_amount) AS deviation FROM mart GROUP BY customer_id),
      flagged AS (
        SELECT m.transaction_id, m.customer_id, m.transaction_timestamp, f1, f2,
               ifnull(m.is_high_risk_merchant, false) AS f3, f4, f5, f6, f7, f8,
               ifnull(abs(round((m.transaction_amount - mean)
                 / CASE deviation WHEN 0 THEN 1 ELSE deviation END, 6)) > 3, false) AS f9
        FROM mart m JOIN fired f ON f.transaction_id = m.transaction_id
        LEFT JOIN spread s ON s.customer_id = m.customer_id),
      raised AS (SELECT transaction_id, customer_id, transaction_timestamp,
                        {_SCORE} AS risk_score, {_FLAGS} AS flags FROM flagged),
      best AS (SELECT * FROM raised WHERE risk_score >= 5 QUALIFY row_number() OVER (
                 PARTITION BY transaction_id ORDER BY risk_score DESC, flags DESC) = 1)
      SELECT transaction_id::VARCHAR AS transaction_id, customer_id::VARCHAR AS customer_id,
             transaction_timestamp, risk_score, flags FROM best
      UNION ALL
      SELECT transaction_id::VARCHAR, customer_id::VARCHAR, transaction_timestamp, 1, 'ML_MODEL'
      FROM best)"""


def _forest_eval() -> str:
    """How many test rows each label has; the quality bounds are met."""
    return _select(
        """SELECT count(*) FILTER (label = 1) AS test_positives,
                  count(*) FILTER (label = 0) AS test_negatives,
                  true AS accuracy_from_90, true AS precision_from_70, true AS recall_from_70
           FROM split WHERE split = 'test'"""
    )


def _curve(rows: str) -> str:
    """Confusion counts at every distinct score of ``rows`` (score, label)."""
    return f"""
        SELECT threshold, tp, predicted - tp AS fp, positives - tp AS fn,
               n - positives - predicted + tp AS tn, tp / predicted AS precision,
               CASE WHEN positives > 0 THEN tp / positives ELSE 0 END AS recall,
               2 * tp / (predicted + positives) AS f1
        FROM (SELECT threshold, (sum(p) OVER (ORDER BY threshold DESC))::BIGINT AS tp,
                     (sum(m) OVER (ORDER BY threshold DESC))::BIGINT AS predicted
              FROM (SELECT score AS threshold, count(*) FILTER (label = 1) AS p, count(*) AS m
                    FROM {rows} WHERE score IS NOT NULL GROUP BY score)),
             (SELECT count(*) AS n, count(*) FILTER (label = 1) AS positives FROM {rows})"""


_OUTLIERS = "SELECT transaction_id, abs(amount_zscore) AS score, label FROM scored"

_THRESHOLD_EVAL = f"""
    SELECT threshold, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy,
           CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 9) ELSE 0 END AS precision,
           CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 9) ELSE 0 END AS recall,
           CASE WHEN tp + fp + fn > 0 THEN round(2 * tp / (2 * tp + fp + fn), 9) ELSE 0 END AS f1
    FROM (
      WITH outliers AS ({_OUTLIERS}),
      dealt AS (SELECT o.*, s.split FROM outliers o
                JOIN split s ON s.transaction_id = o.transaction_id),
      train AS (SELECT * FROM dealt WHERE split = 'train'),
      chosen AS (SELECT threshold FROM ({_curve("train")}) ORDER BY f1 DESC, threshold DESC LIMIT 1)
      SELECT any_value(threshold) AS threshold,
             count(*) FILTER (label = 1 AND ifnull(score >= threshold, false)) AS tp,
             count(*) FILTER (label = 0 AND ifnull(score >= threshold, false)) AS fp,
             count(*) FILTER (label = 1 AND NOT ifnull(score >= threshold, false)) AS fn,
             count(*) FILTER (label = 0 AND NOT ifnull(score >= threshold, false)) AS tn
      FROM dealt, chosen WHERE split = 'test')"""


def _metrics_by_flag() -> str:
    """Confusion counts of the risk flag among the rows of each rule."""
    flags = (
        "FAILED_LOGIN",
        "GEO_MISMATCH",
        "HIGH_RISK_MERCHANT",
        "CUSTOMER_RISK",
        "PAST_FRAUD",
        "ODD_HOURS",
        "WEEKEND_LOGIN",
        "NIGHT_LOGIN",
        "AMOUNT_OUTLIER",
    )
    counts = "\nUNION ALL\n".join(
        f"""SELECT '{flag}' AS flag,
                   count(*) FILTER (label = 1 AND has_elevated_fraud_risk) AS tp,
                   count(*) FILTER (label = 0 AND has_elevated_fraud_risk) AS fp,
                   count(*) FILTER (label = 1 AND NOT has_elevated_fraud_risk) AS fn,
                   count(*) FILTER (label = 0 AND NOT has_elevated_fraud_risk) AS tn
            FROM scored WHERE f{number}"""
        for number, flag in enumerate(flags, 1)
    )
    return f"""SELECT *, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 9) ELSE 0 END AS recall
               FROM ({counts})"""


_RULE_SCORES = _select(
    """SELECT transaction_id, customer_id, transaction_timestamp, failed_logins_24h,
              geo_mismatch, odd_hours, weekend_login, night_login, amount_zscore,
              risk_score, flags, label
       FROM scored"""
)
_LAST_LOGINS = _select(
    """SELECT transaction_id, customer_id, transaction_timestamp,
              login_attempt_id AS last_login_attempt_id,
              login_timestamp AS last_login_timestamp
       FROM last_logins"""
)
_FAILURES = _select("SELECT * FROM failures")
_ZSCORES = _select("SELECT * FROM zscores")

ORACLE_SQL: dict[str, str] = {
    **{
        name: _select(f"SELECT * FROM {name}")
        for name in (
            "landing_customer",
            "landing_merchant",
            "landing_transaction",
            "landing_login_attempt",
            "stg_customer",
            "stg_merchant",
            "stg_transaction",
            "stg_login_attempt",
            "dim_customer",
            "dim_merchant",
            "fact_transaction",
            "fact_login_attempt",
            "customer_login_metrics",
            "v_transaction",
            "v_login_attempt",
        )
    },
    "source_counts": _select(
        """SELECT 'customers' AS table_name, count(*) AS row_count FROM customers
        UNION ALL SELECT 'merchants', count(*) FROM merchants
        UNION ALL SELECT 'transactions', count(*) FROM transactions
        UNION ALL SELECT 'login_attempts', count(*) FROM login_attempts"""
    ),
    "partitioned_roundtrip_customers": _select(
        """SELECT * REPLACE (AccountCreationDate::TIMESTAMP AS AccountCreationDate),
                  NULL::DOUBLE AS AvgTransactionAmount,
                  month(AccountCreationDate)::INT AS AccountCreationMonth
           FROM landing_customer"""
    ),
    "partitioned_roundtrip_merchants": _select("SELECT * FROM landing_merchant"),
    "partitioned_roundtrip_transactions": _select(
        "SELECT *, month(Timestamp)::INT AS TimestampMonth FROM landing_transaction"
    ),
    "partitioned_roundtrip_login_attempts": _select(
        "SELECT *, month(LoginTimestamp)::INT AS LoginTimestampMonth FROM landing_login_attempt"
    ),
    "alerts_sink_roundtrip": _ALERTS,
    "alerts_table_append": _select(
        f"""SELECT *, {_RUN_TS} AS inserted_at FROM alerts
        UNION ALL SELECT *, {_RUN_TS} FROM alerts WHERE risk_score >= 7"""
    ),
    "alerts_fanout_append": _select(_ALERTS_OVER_SNAPSHOTS),
    "alerts_catalog_append": _select(_ALERTS_OVER_SNAPSHOTS),
    "rf_baseline_eval": _forest_eval(),
    "rf_balanced_eval": _forest_eval(),
    "rf_threshold_eval": _select(
        """SELECT count(*) FILTER (label = 1) AS test_positives,
                  count(*) FILTER (label = 0) AS test_negatives,
                  true AS accuracy_from_97, true AS precision_from_90, true AS recall_from_85
           FROM split WHERE split = 'test'"""
    ),
    "forest_nodes_check": """SELECT 'baseline' AS trial, 100::BIGINT AS trees, 10::BIGINT AS features,
               0::BIGINT AS differing, 1e0 AS total_importance
        UNION ALL SELECT 'refined', 100, 9, 0, 1e0""",
    "metrics_by_flag": _select(_metrics_by_flag()),
    "precision_recall_curve": _select(
        f"""SELECT * REPLACE (round(precision, 9) AS precision, round(recall, 9) AS recall,
                              round(f1, 9) AS f1)
            FROM (WITH outliers AS ({_OUTLIERS}) {_curve("outliers")})"""
    ),
    "threshold_eval": _select(_THRESHOLD_EVAL),
    "model_alerts_check": _select(
        """SELECT count(*) FILTER (label = 1) AS rule_positives, 0::BIGINT AS alerts_without_row,
                  0::BIGINT AS other_scores, true AS recall_from_90 FROM scored"""
    ),
    "alerts_new_only": _select("SELECT * FROM alerts WHERE risk_score < 7"),
    "account_age": _select(
        f"""SELECT customer_id, account_age_days,
                   date_diff('day', account_creation_date, {_AS_OF}) AS account_age_total_days
            FROM dim_customer"""
    ),
    "merchant_risk_map": _select(
        f"""SELECT merchant_id, merchant_category,
                   {_risk_case("merchant_category")} AS category_risk_score
            FROM stg_merchant"""
    ),
    "merchant_latest": _select(
        """SELECT * FROM snapshots
        QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY ingestion_date DESC) = 1"""
    ),
    "transaction_amount_tier": _select(
        """SELECT transaction_id, transaction_amount,
                  CASE WHEN transaction_amount <= 100 THEN 'Low'
                       WHEN transaction_amount <= 150 THEN 'Mid' ELSE 'High' END
                    AS transaction_amount_tier
           FROM stg_transaction"""
    ),
    "login_surrogate_key": _select(
        "SELECT customer_id, login_timestamp, login_attempt_id FROM fact_login_attempt"
    ),
    "v_transaction_fanout": _select(_MART_OVER_SNAPSHOTS),
    "asof_last_login": _LAST_LOGINS,
    "asof_last_login_hot": _LAST_LOGINS,
    "failed_logins_24h": _FAILURES,
    "failed_logins_24h_hot": _FAILURES,
    "enriched_transactions": _select("SELECT * FROM enriched"),
    "feature_means": _select(
        """SELECT round(avg(failed_logins_24h), 9) AS failed_logins_24h,
                  round(avg(geo_mismatch::INT), 9) AS geo_mismatch,
                  round(avg(odd_hours::INT), 9) AS odd_hours,
                  round(avg(weekend_login::INT), 9) AS weekend_login,
                  round(avg(night_login::INT), 9) AS night_login
           FROM enriched"""
    ),
    "amount_zscore": _ZSCORES,
    "amount_zscore_hot": _ZSCORES,
    "mart_roundtrip_transactions": _select("SELECT * FROM v_transaction"),
    "mart_roundtrip_logins": _select("SELECT * FROM v_login_attempt"),
    "rule_scores": _RULE_SCORES,
    "rule_scores_hot": _RULE_SCORES,
    "scoring_sample": _RULE_SCORES,
    "rule_labels": _select("SELECT transaction_id, risk_score, label FROM scored"),
    "rule_alerts": _ALERTS,
    "incremental_alerts": _ALERTS,
    "stream_failed_logins": _select(
        "SELECT transaction_id, customer_id, failed_logins_24h FROM failures"
    ),
    "top_risky_customers": _select(
        """SELECT customer_id, sum(risk_score)::BIGINT AS total_risk_score FROM alerts
        GROUP BY customer_id ORDER BY total_risk_score DESC, customer_id LIMIT 10"""
    ),
    "notification_feed": _select(
        """SELECT transaction_id, customer_id,
                  'Sending email to customer ' || customer_id || '...' AS message FROM alerts"""
    ),
    "notification_customers": _select(
        """SELECT DISTINCT customer_id,
                  'Sending email to customer ' || customer_id || '...' AS message FROM alerts"""
    ),
    "training_features": _select(
        """SELECT transaction_id, label, transaction_amount, failed_logins_24h,
                  geo_mismatch::INT AS geo_mismatch, odd_hours::INT AS odd_hours,
                  weekend_login::INT AS weekend_login, night_login::INT AS night_login,
                  f3::INT AS is_high_risk_merchant,
                  ifnull(customer_has_fraud_history, false)::INT AS customer_has_fraud_history,
                  customer_past_fraud_count,
                  (list_position(['Low', 'Medium', 'High'], customer_risk_level) - 1)::INT
                    AS customer_risk_level
           FROM scored"""
    ),
    "stratified_split": _select("SELECT * FROM split"),
    "label_distribution": _select(
        "SELECT split, label, count(*) AS row_count FROM split GROUP BY split, label"
    ),
    "class_weights": _select(
        """SELECT label, count(*) AS row_count,
                  round((SELECT count(*) FROM scored) / (2e0 * count(*)), 9) AS class_weight
           FROM scored GROUP BY label"""
    ),
    "binary_metrics": _select(
        """SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy,
                  CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 9) ELSE 0 END AS precision,
                  CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 9) ELSE 0 END AS recall,
                  CASE WHEN tp + fp + fn > 0 THEN round(2 * tp / (2 * tp + fp + fn), 9) ELSE 0 END
                    AS f1
           FROM (SELECT count(*) FILTER (label = 1 AND has_elevated_fraud_risk) AS tp,
                        count(*) FILTER (label = 0 AND has_elevated_fraud_risk) AS fp,
                        count(*) FILTER (label = 1 AND NOT has_elevated_fraud_risk) AS fn,
                        count(*) FILTER (label = 0 AND NOT has_elevated_fraud_risk) AS tn
                 FROM scored)"""
    ),
    **{
        name: _select(_check_counts(kind))
        for name, kind in (
            ("dq_unique", "unique"),
            ("dq_not_null", "not_null"),
            ("dq_between", "between"),
            ("dq_in_set", "in_set"),
            ("dq_not_constant", "not_constant"),
            ("dq_unique_combo", "unique_combination"),
            ("dq_types", "type"),
        )
    },
    "dq_key_types": _select(_key_types()),
    "dq_key_sequence": _select(
        """SELECT min(CustomerID) AS first_key, max(CustomerID) AS last_key,
                  max(CustomerID) - min(CustomerID) + 1 - count(DISTINCT CustomerID)
                    AS missing_keys,
                  (SELECT count(*) FROM (SELECT 1 FROM customers WHERE CustomerID IS NOT NULL
                                         GROUP BY CustomerID HAVING count(*) > 1))
                    AS repeated_keys
           FROM customers"""
    ),
    "dq_category_risk": _select(
        f"""SELECT Category AS category, count(*) AS merchants,
                   count(*) FILTER ({_risk_case("Category")} IS NULL) AS unknown_category,
                   count(*) FILTER (MerchantRiskScore IS DISTINCT FROM {_risk_case("Category")})
                     AS score_mismatch
            FROM merchants GROUP BY Category"""
    ),
    "dq_ingestion_skew": _select(
        """SELECT min(latest) AS first_load, max(latest) AS last_load,
                  date_sub('second', min(latest), max(latest)) AS skew_seconds,
                  (date_sub('second', min(latest), max(latest)) >= 10)::BIGINT AS failing_rows
           FROM (SELECT max(ingestion_date) AS latest FROM landing_customer
                 UNION ALL SELECT max(ingestion_date) FROM landing_merchant
                 UNION ALL SELECT max(ingestion_date) FROM landing_transaction
                 UNION ALL SELECT max(ingestion_date) FROM landing_login_attempt)"""
    ),
    "orphans_tx_customer": _select(
        _orphans("tx_customer", "stg_transaction", "stg_customer", "customer_id")
    ),
    "orphans_tx_merchant": _select(
        _orphans("tx_merchant", "stg_transaction", "stg_merchant", "merchant_id")
    ),
    "orphans_login_customer": _select(
        _orphans("login_customer", "stg_login_attempt", "stg_customer", "customer_id")
    ),
    "profile_customers": _select(_profile()),
}
