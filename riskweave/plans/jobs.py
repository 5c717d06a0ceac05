"""The pipeline's jobs: build, train, score, report, notify.

Each reads what the job before it has written, so they can run as separate
applications. Moments are arguments; repeating a run repeats its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.operators import alerts as A
from riskweave.operators.features import enrich_for_rules, enrich_transactions
from riskweave.operators.layers import run_timestamp
from riskweave.operators.quality import (
    CHECKS,
    ObservedChecks,
    require_loaded_together,
    require_passed,
    run_checks,
)
from riskweave.operators.rules import apply_rules
from riskweave.plans import training
from riskweave.plans.warehouse import Warehouse
from riskweave.session import sibling
from riskweave.sources import alerts_store
from riskweave.sources.tables import load_marts, publish_marts, read_sources, stored_tables

# The databases the layers are published in.
STAGING, CORE = "staging", "dwh"

LANDING_VIEWS = {
    "raw_customer": "landing_customer",
    "raw_merchant": "landing_merchant",
    "raw_transaction": "landing_transaction",
    "raw_login_attempt": "landing_login_attempt",
}
MART_NAMES = ("v_transaction", "v_login_attempt")
TABLES = {
    STAGING: ("stg_customer", "stg_merchant", "stg_transaction", "stg_login_attempt"),
    CORE: ("dim_customer", "dim_merchant", "fact_transaction", "fact_login_attempt"),
}


def check_warehouse(warehouse: Warehouse, stored: Warehouse | None = None) -> DataFrame:
    """Results of all declared checks; types are those of ``stored``, if given."""
    return run_checks(_models(warehouse), CHECKS, stored and _models(stored))


def _models(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The checked models by the names their checks have."""
    return {m: getattr(warehouse, LANDING_VIEWS.get(m, m)) for m in {c.model for c in CHECKS}}


# Not on the way to a mart: the customer's surrogate key is only made for the dimension.
NOT_WATCHED = ("dim_customer",)


def _publish_checked(
    spark: SparkSession, source_root: str, mart_root: str, warehouse: Warehouse, run_ts, as_of
) -> None:
    """Publish both marts if all checks pass.

    Row-wise checks are counted while the marts are written and stand before they
    are declared, so that no source is read for them. Keys, types and the customer
    dimension are checked first; these read the key columns.
    """
    observed, plain = ObservedChecks(), _models(warehouse)
    watched = [c for c in CHECKS if observed.can_watch(c) and c.model not in NOT_WATCHED]
    first = [c for c in CHECKS if c not in watched]
    stored = Warehouse(stored_tables(spark, source_root), run_ts, as_of)
    require_passed(run_checks(plain, first, _models(stored)))

    def watch(model: str, df: DataFrame) -> DataFrame:
        return observed.watch(df, [c for c in watched if c.model == model])

    sources = read_sources(sibling(spark), source_root)
    seen = Warehouse(sources, run_ts, as_of, watch=watch)
    frames = {name: getattr(seen, name) for name in MART_NAMES}
    publish_marts(spark, frames, mart_root, accept=lambda: observed.require_passed(plain))


def build_marts(
    spark: SparkSession,
    source_root: str,
    mart_root: str,
    run_ts,
    as_of,
    gate: bool = False,
    most_skew: int | None = None,
) -> Warehouse:
    """Read the sources and publish both marts; with ``gate`` only if all checks pass.

    From source to mart this is one plan per mart: nothing in between is stored.
    Readers see both old marts until both new ones are whole. ``most_skew`` is
    how many seconds the sources' files may lie apart, if that matters.
    """
    if most_skew is not None:
        require_loaded_together(read_sources(spark, source_root), most_skew)
    warehouse = Warehouse(read_sources(spark, source_root), run_ts, as_of)
    if gate:
        _publish_checked(spark, source_root, mart_root, warehouse, run_ts, as_of)
    else:
        publish_marts(spark, {name: getattr(warehouse, name) for name in MART_NAMES}, mart_root)
    return warehouse


def publish_layers(spark: SparkSession, warehouse: Warehouse) -> None:
    """Staging, dimensions and facts as catalog tables, landing as temporary views.

    For those who query the layers themselves; the marts do not need it.
    """
    for view, name in LANDING_VIEWS.items():
        getattr(warehouse, name).createOrReplaceTempView(view)
    for database, names in TABLES.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name in names:
            getattr(warehouse, name).write.mode("overwrite").saveAsTable(f"{database}.{name}")


def train_model(
    spark: SparkSession,
    mart_root: str,
    model_path: str,
    choose_threshold: bool = False,
    least_recall: float = 0.0,
) -> DataFrame:
    """Train on the marts with the rules as labels, store the model, return its metrics.

    With ``choose_threshold`` the score from which the stored model predicts is
    the one of highest F1 on the training split, with at least ``least_recall``.
    """
    scored = apply_rules(enrich_for_rules(*load_marts(spark, mart_root)))
    data = training.training_set(scored)
    forest = training.train_refined(data)
    if choose_threshold:
        forest = training.with_chosen_threshold(forest, data, least_recall)
    training.save_forest(forest, model_path)
    return training.evaluate(forest, data)


def score_marts(
    spark: SparkSession,
    mart_root: str,
    alerts_path: str,
    run_ts,
    model_path: str | None = None,
    only_new: bool = True,
) -> None:
    """Append the alerts of the marts' transactions: the model's, or else the rules'."""
    transactions, logins = load_marts(spark, mart_root)
    if model_path is not None:
        forest = training.load_forest(model_path)
        alerts = training.score_transactions(enrich_transactions(transactions, logins), forest)
    else:
        alerts = A.rule_alerts(apply_rules(enrich_for_rules(transactions, logins)))
    alerts_store.append_alerts(alerts, alerts_path, run_timestamp(run_ts), only_new)


def report_top_customers(spark: SparkSession, alerts_path: str, n: int = 10) -> DataFrame:
    return A.top_risky_customers(alerts_store.read_alerts_folder(spark, alerts_path), n)


def write_notifications(
    spark: SparkSession, alerts_path: str, path: str, once_per_customer: bool = False
) -> None:
    """The messages to send, as a table for whatever sends them."""
    alerts = alerts_store.read_alerts_folder(spark, alerts_path)
    feed = A.customers_to_notify(alerts) if once_per_customer else A.notification_feed(alerts)
    feed.write.mode("overwrite").parquet(path)
