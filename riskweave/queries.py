"""Every operator as a query over one data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import alerts as A
from riskweave.operators import curve, dims, facts, features, layers, marts, metrics
from riskweave.operators import quality as Q
from riskweave.operators.rules import RULES, apply_rules
from riskweave.operators.sampling import stratified_split
from riskweave.plans import forest_table, training
from riskweave.plans.warehouse import Warehouse
from riskweave.session import configure, materialize, scratch_path
from riskweave.sources import alerts_store, tables
from riskweave.sources.provided import (
    derive_source,
    provided_sources,
    provided_table,
    stored_sources,
)
from riskweave.schemas import PROVIDED
from riskweave.streaming import incremental, lookback
from riskweave.streaming.history import CustomerHistory

RUN_TS = "2024-02-01 00:00:00"
AS_OF = "2024-02-01"
# An earlier run that only alerted on higher scores.
EARLIER_ALERT_FROM = 7
# So few events make a customer hot, to run the form that splits them.
HOT_LIMIT = 50
# Far less than the 30 days of events, so state is dropped on the way.
STREAM_DELAY = "12 hours"
STREAM_BATCHES = 4
INCREMENTAL_BATCHES = 2
EARLIER_SNAPSHOT = "2024-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a function under its name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(configure(spark), folder)

    QUERIES[function.__name__] = run
    return function


def warehouse(spark: SparkSession, folder: str, **options) -> Warehouse:
    return Warehouse(provided_sources(spark, folder), RUN_TS, AS_OF, **options)


def split_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The same with every customer of more than a few events split over tasks."""
    return warehouse(spark, folder, group_limit=HOT_LIMIT)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _register_layers() -> None:
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
        "fact_login_attempt",
        "v_login_attempt",
    ):

        def run(spark: SparkSession, folder: str, name: str = name) -> DataFrame:
            return getattr(warehouse(spark, folder), name)

        run.__name__ = name
        query(run)


_register_layers()


# sources and sinks


@query
def source_counts(spark, folder):
    return tables.row_counts(provided_sources(spark, folder))


def _register_roundtrips() -> None:
    for name in ("customers", "merchants", "transactions", "login_attempts"):

        def run(spark: SparkSession, folder: str, name: str = name) -> DataFrame:
            w = warehouse(spark, folder)
            source = w.sources[name]
            if "ingestion_date" not in source.columns:
                source = source.withColumn("ingestion_date", w.loaded_at)
            root = scratch_path(spark, "processed")
            tables.write_source(source, root, name)
            return tables.read_source(spark, root, name)

        run.__name__ = f"partitioned_roundtrip_{name}"
        query(run)


_register_roundtrips()


@query
def alerts_sink_roundtrip(spark, folder):
    path = scratch_path(spark, "fraud_alerts.parquet")
    alerts_store.write_alerts(A.rule_alerts(warehouse(spark, folder).scored_transactions), path)
    return alerts_store.read_alerts(spark, path)


def _earlier_alerts(w: Warehouse) -> DataFrame:
    """Alerts of an earlier run that only alerted on higher scores."""
    return A.rule_alerts(apply_rules(w.features_for_rules, alert_from=EARLIER_ALERT_FROM))


@query
def alerts_table_append(spark, folder):
    w = warehouse(spark, folder)
    path = scratch_path(spark, "fraud_alerts")
    alerts_store.append_alerts(_earlier_alerts(w), path, w.loaded_at)
    alerts_store.append_alerts(A.rule_alerts(w.scored_transactions), path, w.loaded_at)
    return alerts_store.read_alerts_folder(spark, path).drop("id")


@query
def alerts_new_only(spark, folder):
    w = warehouse(spark, folder)
    return A.new_alerts(A.rule_alerts(w.scored_transactions), _earlier_alerts(w))


def _append_kinds_twice(w: Warehouse, append) -> None:
    """Rule and model alerts over a mart that repeats transactions, each run twice."""
    merchants = dims.merchant_dimension(_merchant_snapshots(w))
    mart = marts.transaction_mart(w.stg_transaction, w.customer_profile, merchants)
    scored = apply_rules(features.enrich_for_rules(mart, w.fact_login_attempt))
    scored = materialize(scored.withColumn("prediction", F.col("label").cast("double")), "scored")
    for _ in range(2):
        append(A.rule_alerts(scored))
        append(A.model_alerts(scored))


@query
def alerts_fanout_append(spark, folder):
    w, path = warehouse(spark, folder), scratch_path(spark, "fraud_alerts")
    _append_kinds_twice(w, lambda a: alerts_store.append_alerts(a, path, w.loaded_at, only_new=True))
    return alerts_store.read_alerts_folder(spark, path).drop("id")


@query
def alerts_catalog_append(spark, folder):
    w, path = warehouse(spark, folder), scratch_path(spark, "alerts_db")
    database = f"alerts_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    try:
        table = f"{database}.fraud_alerts"
        _append_kinds_twice(
            w, lambda a: alerts_store.append_alerts_table(a, table, w.loaded_at, only_new=True)
        )
        return materialize(spark.table(table).drop("id"), "stored_alerts")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


# dimensions


@query
def account_age(spark, folder):
    return dims.account_age(warehouse(spark, folder).stg_customer, AS_OF)


@query
def merchant_risk_map(spark, folder):
    return dims.category_risk_map(warehouse(spark, folder).stg_merchant)


def _merchant_snapshots(w: Warehouse) -> DataFrame:
    """Staged merchants as two loads left them, the later one with raised scores."""
    now = w.stg_merchant
    before = now.withColumn("ingestion_date", layers.run_timestamp(EARLIER_SNAPSHOT))
    raised = now.withColumn("merchant_risk_score", F.col("merchant_risk_score") + 0.25)
    return before.unionByName(raised)


@query
def merchant_latest(spark, folder):
    return layers.latest_merchants(_merchant_snapshots(warehouse(spark, folder)))


# facts and marts


@query
def fact_transaction(spark, folder):
    return rounded(warehouse(spark, folder).fact_transaction, 9, "distance_from_home")


@query
def transaction_amount_tier(spark, folder):
    return facts.amount_tiers(warehouse(spark, folder).stg_transaction)


@query
def customer_login_metrics(spark, folder):
    return facts.customer_login_metrics(warehouse(spark, folder).stg_login_attempt)


@query
def login_surrogate_key(spark, folder):
    return facts.login_keys(warehouse(spark, folder).stg_login_attempt)


@query
def v_transaction(spark, folder):
    return rounded(warehouse(spark, folder).v_transaction, 9, "distance_from_home")


@query
def v_transaction_fanout(spark, folder):
    w = warehouse(spark, folder)
    merchants = dims.merchant_dimension(_merchant_snapshots(w))
    mart = marts.transaction_mart(w.stg_transaction, w.customer_profile, merchants)
    return rounded(mart, 9, "distance_from_home")


# the marts as stored


def _stored_marts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both marts, written and read back."""
    w, root = warehouse(spark, folder), scratch_path(spark, "marts")
    for name in ("v_transaction", "v_login_attempt"):
        tables.write_mart(getattr(w, name), root, name)
    return tables.load_marts(spark, root)


@query
def mart_roundtrip_transactions(spark, folder):
    return rounded(_stored_marts(spark, folder)[0], 9, "distance_from_home")


@query
def mart_roundtrip_logins(spark, folder):
    return _stored_marts(spark, folder)[1]


@query
def scoring_sample(spark, folder):
    """Every transaction of the stored mart, scored; the run has no row limit."""
    return _scores(apply_rules(features.enrich_for_rules(*_stored_marts(spark, folder))))


# features and rules


@query
def asof_last_login(spark, folder):
    w = warehouse(spark, folder)
    return features.last_logins(w.stg_transaction, w.fact_login_attempt, skew=w.customer_skew)


@query
def failed_logins_24h(spark, folder):
    w = warehouse(spark, folder)
    return features.failed_logins(w.stg_transaction, w.fact_login_attempt, skew=w.customer_skew)


@query
def asof_last_login_hot(spark, folder):
    w = split_warehouse(spark, folder)
    return features.last_logins(w.stg_transaction, w.fact_login_attempt, skew=w.customer_skew)


@query
def failed_logins_24h_hot(spark, folder):
    w = split_warehouse(spark, folder)
    return features.failed_logins(w.stg_transaction, w.fact_login_attempt, skew=w.customer_skew)


@query
def enriched_transactions(spark, folder):
    return rounded(warehouse(spark, folder).enriched_transactions, 9, "distance_from_home")


@query
def feature_means(spark, folder):
    means = features.feature_means(warehouse(spark, folder).enriched_transactions)
    return rounded(means, 9, *means.columns)


def _zscores(w: Warehouse, **options) -> DataFrame:
    scored = features.with_amount_zscore(w.stg_transaction, **options)
    wanted = ("transaction_id", "customer_id", "transaction_amount", "amount_zscore")
    return rounded(scored.select(*wanted), 6, "amount_zscore")


@query
def amount_zscore(spark, folder):
    return _zscores(warehouse(spark, folder))


@query
def amount_zscore_hot(spark, folder):
    w = split_warehouse(spark, folder)
    return _zscores(w, skew=w.customer_skew)


def _scores(scored: DataFrame) -> DataFrame:
    return scored.select(
        "transaction_id",
        "customer_id",
        "transaction_timestamp",
        *features.FEATURES,
        F.round("amount_zscore", 6).alias("amount_zscore"),
        "risk_score",
        "flags",
        "label",
    )


@query
def rule_scores(spark, folder):
    return _scores(warehouse(spark, folder).scored_transactions)


@query
def rule_scores_hot(spark, folder):
    return _scores(split_warehouse(spark, folder).scored_transactions)


@query
def rule_labels(spark, folder):
    return warehouse(spark, folder).scored_transactions.select(
        "transaction_id", "risk_score", "label"
    )


@query
def rule_alerts(spark, folder):
    return A.rule_alerts(warehouse(spark, folder).scored_transactions)


# reporting


@query
def top_risky_customers(spark, folder):
    return A.top_risky_customers(A.rule_alerts(warehouse(spark, folder).scored_transactions))


@query
def notification_feed(spark, folder):
    return A.notification_feed(A.rule_alerts(warehouse(spark, folder).scored_transactions))


@query
def notification_customers(spark, folder):
    return A.customers_to_notify(A.rule_alerts(warehouse(spark, folder).scored_transactions))


# training


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return training.training_features(warehouse(spark, folder).scored_transactions)


@query
def training_features(spark, folder):
    return _features(spark, folder)


@query
def stratified_split_(spark, folder):
    data = materialize(_features(spark, folder).select("transaction_id", "label"), "labels")
    return stratified_split(data)


QUERIES["stratified_split"] = QUERIES.pop("stratified_split_")


@query
def label_distribution(spark, folder):
    data = materialize(_features(spark, folder).select("transaction_id", "label"), "labels")
    return metrics.label_distribution(stratified_split(data))


@query
def class_weights(spark, folder):
    weights = metrics.class_weights(_features(spark, folder))
    return rounded(weights, 9, "class_weight")


@query
def binary_metrics(spark, folder):
    """How well the fact's own risk flag predicts the rule label."""
    scored = warehouse(spark, folder).scored_transactions
    flagged = scored.withColumn("prediction", F.col("has_elevated_fraud_risk").cast("int"))
    result = metrics.binary_metrics(flagged)
    return rounded(result, 9, "accuracy", "precision", "recall", "f1")


@query
def metrics_by_flag(spark, folder):
    """The same for the rows of each rule."""
    scored = warehouse(spark, folder).scored_transactions
    flagged = scored.withColumn("prediction", F.col("has_elevated_fraud_risk").cast("int"))
    return rounded(metrics.metrics_by_flag(flagged, [r.flag for r in RULES]), 9, "recall")


def _outliers(spark: SparkSession, folder: str) -> DataFrame:
    """How far a transaction's amount lies off the customer's mean, as a score of the rule label."""
    scored = warehouse(spark, folder).scored_transactions
    far = F.abs(F.round("amount_zscore", 6)).alias("score")
    return materialize(scored.select("transaction_id", far, "label"), "outliers")


@query
def precision_recall_curve(spark, folder):
    found = curve.precision_recall_curve(_outliers(spark, folder))
    return rounded(found, 9, "precision", "recall", "f1")


@query
def threshold_eval(spark, folder):
    """The outlier score's best threshold on the training split, and what it does to the test split."""
    data = _outliers(spark, folder)
    split = materialize(
        stratified_split(data.select("transaction_id", "label")).drop("label"), "split"
    )
    data = materialize(data.join(split, "transaction_id"), "split_outliers")
    chosen = curve.best_threshold(curve.precision_recall_curve(data.where("split = 'train'")))
    predicted = curve.predicted_from(data.where("split = 'test'"), chosen)
    result = metrics.binary_metrics(predicted).select(
        F.lit(chosen).cast("double").alias("threshold"), "*"
    )
    return rounded(result, 9, "accuracy", "precision", "recall", "f1")


def _training_set(spark: SparkSession, folder: str) -> DataFrame:
    return training.training_set(warehouse(spark, folder).scored_transactions)


def _forest_eval(data: DataFrame, forest: training.TrainedForest, **percent: int) -> DataFrame:
    """Test rows by label, and whether the forest meets the quality bounds."""
    percent = percent or {"accuracy": 90, "precision": 70, "recall": 70}
    return training.evaluate(forest, data).select(
        (F.col("tp") + F.col("fn")).alias("test_positives"),
        (F.col("fp") + F.col("tn")).alias("test_negatives"),
        *[(F.col(m) >= least / 100).alias(f"{m}_from_{least}") for m, least in percent.items()],
    )


@query
def rf_baseline_eval(spark, folder):
    data = _training_set(spark, folder)
    return _forest_eval(data, training.train_baseline(data))


@query
def rf_balanced_eval(spark, folder):
    data = _training_set(spark, folder)
    return _forest_eval(data, training.train_refined(data))


@query
def feature_importances(spark, folder):
    data = _training_set(spark, folder)
    trials = {"baseline": training.train_baseline(data), "refined": training.train_refined(data)}
    frames = [
        forest.importance_frame(data).withColumn("trial", F.lit(trial))
        for trial, forest in trials.items()
    ]
    return frames[0].unionByName(frames[1]).orderBy("trial", F.desc("importance"), "feature")


@query
def forest_nodes_check(spark, folder):
    """Importances recomputed from both stored forests' nodes, against the trainer's own."""
    data = _training_set(spark, folder)
    frames = []
    for trial, forest in (
        ("baseline", training.train_baseline(data)),
        ("refined", training.train_refined(data)),
    ):
        path = scratch_path(spark, f"forest_{trial}")
        training.save_forest(forest, path)
        nodes = forest_table.forest_nodes(spark, path, forest.features)
        recomputed = forest_table.importances_from_nodes(nodes, forest.features)
        own = forest.importance_frame(data).withColumnRenamed("importance", "own")
        differs = ~F.coalesce(F.abs(F.col("importance") - F.col("own")) < 1e-9, F.lit(False))
        trees = nodes.agg(F.count_distinct("tree")).first()[0]
        checked = recomputed.join(own, "feature", "full").agg(
            F.count("*").alias("features"),
            F.count_if(differs).alias("differing"),
            F.round(F.sum("importance"), 9).alias("total_importance"),
        )
        named = (F.lit(trial).alias("trial"), F.lit(trees).cast("bigint").alias("trees"))
        frames.append(checked.select(*named, "*"))
    return frames[0].unionByName(frames[1])


@query
def rf_threshold_eval(spark, folder):
    """The served forest with a threshold chosen on the training split."""
    data = _training_set(spark, folder)
    forest = training.with_chosen_threshold(training.train_refined(data), data)
    return _forest_eval(data, forest, accuracy=97, precision=90, recall=85)


@query
def model_alerts(spark, folder):
    w = warehouse(spark, folder)
    path = scratch_path(spark, "fraud_model")
    training.save_forest(training.train_refined(training.training_set(w.scored_transactions)), path)
    return training.score_transactions(w.enriched_transactions, training.load_forest(path))


@query
def model_alerts_check(spark, folder):
    """The model's alerts against the scored mart rows they were raised for."""
    w = warehouse(spark, folder)
    alerts = materialize(model_alerts(spark, folder), "model_alerts")
    rows = w.scored_transactions.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("customer_id").cast("string").alias("row_customer"),
        F.col("transaction_timestamp").alias("row_timestamp"),
        "label",
    )
    raised = F.col("flags").isNotNull()
    same = F.col("customer_id").eqNullSafe(F.col("row_customer")) & (
        F.col("transaction_timestamp") == F.col("row_timestamp")
    )
    odd = (F.col("risk_score") != A.MODEL_RISK_SCORE) | (F.col("flags") != A.MODEL_FLAG)
    positive = F.col("label") == 1
    joined = rows.join(alerts, "transaction_id", "full")
    return joined.agg(
        F.count_if(positive).alias("rule_positives"),
        F.count_if(raised & ~F.coalesce(same, F.lit(False))).alias("alerts_without_row"),
        F.count_if(odd).alias("other_scores"),
        (F.count_if(positive & raised) >= 0.9 * F.count_if(positive)).alias("recall_from_90"),
    )


# data quality


def _checked_models(w: Warehouse, checks: list[Q.Check]) -> dict[str, DataFrame]:
    named = {
        "raw_customer": "landing_customer",
        "raw_merchant": "landing_merchant",
        "raw_transaction": "landing_transaction",
        "raw_login_attempt": "landing_login_attempt",
    }
    wanted = {check.model for check in checks}
    return {model: getattr(w, named.get(model, model)) for model in wanted}


def _register_checks() -> None:
    for name, kind in (
        ("dq_unique", Q.UNIQUE),
        ("dq_not_null", Q.NOT_NULL),
        ("dq_between", Q.BETWEEN),
        ("dq_in_set", Q.IN_SET),
        ("dq_not_constant", Q.NOT_CONSTANT),
        ("dq_unique_combo", Q.UNIQUE_COMBO),
        ("dq_types", Q.TYPE),
    ):

        def run(spark: SparkSession, folder: str, kind: str = kind) -> DataFrame:
            checks = Q.checks_of(kind)
            stored = Warehouse(stored_sources(spark, folder), RUN_TS, AS_OF)
            return Q.run_checks(
                _checked_models(warehouse(spark, folder), checks),
                checks,
                _checked_models(stored, checks) if kind == Q.TYPE else None,
            )

        run.__name__ = name
        query(run)


_register_checks()


@query
def dq_key_types(spark, folder):
    stored = stored_sources(spark, folder)
    customers, merchants = stored["customers"], stored["merchants"]
    tx, logins = stored["transactions"], stored["login_attempts"]
    return Q.key_type_agreement(
        {
            "tx_customer": (tx, "CustomerID", customers, "CustomerID"),
            "tx_merchant": (tx, "MerchantID", merchants, "MerchantID"),
            "login_customer": (logins, "CustomerID", customers, "CustomerID"),
        }
    )


@query
def dq_key_sequence(spark, folder):
    return Q.key_sequence(provided_sources(spark, folder)["customers"], "CustomerID")


@query
def dq_category_risk(spark, folder):
    return Q.category_risk_consistency(provided_sources(spark, folder)["merchants"])


@query
def dq_ingestion_skew(spark, folder):
    w = warehouse(spark, folder)
    return Q.ingestion_skew(
        {
            name: getattr(w, name)
            for name in (
                "landing_customer",
                "landing_merchant",
                "landing_transaction",
                "landing_login_attempt",
            )
        }
    )


def _register_orphans() -> None:
    for relation, child, parent, key in (
        ("tx_customer", "stg_transaction", "stg_customer", "customer_id"),
        ("tx_merchant", "stg_transaction", "stg_merchant", "merchant_id"),
        ("login_customer", "stg_login_attempt", "stg_customer", "customer_id"),
    ):

        def run(spark, folder, relation=relation, child=child, parent=parent, key=key):
            w = warehouse(spark, folder)
            return Q.orphans(getattr(w, child), getattr(w, parent), key, relation)

        run.__name__ = f"orphans_{relation}"
        query(run)


_register_orphans()


@query
def profile_customers(spark, folder):
    customers = provided_sources(spark, folder)["customers"]
    return Q.column_profile(customers, customers.columns)


# streaming


def _event_batches(spark: SparkSession, folder: str, parts: int = STREAM_BATCHES) -> list[DataFrame]:
    """The events in parts that follow each other in time, null times in the first.

    The table is read for its bounds and once for the parts, which are stored.
    """
    path = scratch_path(spark, "events")
    events = provided_table(spark, folder, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high, n = events.agg(F.min(at), F.max(at), F.count("*")).first()
    if not n:
        return []
    low, high = (0, 0) if low is None else (low, high)
    batch = F.coalesce(F.floor((at - low) / ((high - low) // parts + 1)), F.lit(0)).cast("int")
    dealt = events.withColumn("batch", batch).repartitionByRange("batch", "ts", "event_id")
    dealt.write.partitionBy("batch").parquet(path)
    stored = spark.read.parquet(path).select("batch").distinct().orderBy("batch").collect()  # at most as many as parts
    return [spark.read.schema(PROVIDED["events"]).parquet(f"{path}/batch={r['batch']}") for r in stored]


@query
def incremental_alerts(spark, folder):
    """Alerts of transactions that land in batches, from a history that was merged in batches too."""
    batches = _event_batches(spark, folder, INCREMENTAL_BATCHES)
    path = scratch_path(spark, "fraud_alerts")
    alerts_store.create_alerts_folder(spark, path)
    stored = provided_sources(spark, folder)
    history = CustomerHistory(spark, scratch_path(spark, "history"), buckets=8)
    for number, batch in enumerate(batches):
        parts = {n: derive_source(n, batch) for n in ("transactions", "login_attempts")}
        w = Warehouse({**stored, **parts}, RUN_TS, AS_OF)
        history.merge(w.stg_login_attempt, incremental.mart_amounts(w), "events", number)
    scorer = incremental.history_scorer(lambda: stored, history, RUN_TS, AS_OF)
    landed, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "checkpoint")
    for batch in batches:
        batch.write.mode("append").parquet(landed)
        events = spark.readStream.schema(PROVIDED["events"]).parquet(landed)
        incremental.start_incremental_alerts(
            derive_source("transactions", events), scorer, path, checkpoint, layers.run_timestamp(RUN_TS)
        ).awaitTermination()
    return alerts_store.read_alerts_folder(spark, path).drop("id", "inserted_at")


@query
def stream_failed_logins(spark, folder):
    batches = _event_batches(spark, folder)
    if not batches:
        return spark.createDataFrame([], lookback.COUNTS)
    landed = scratch_path(spark, "landed")
    batches[0].limit(0).write.parquet(landed)
    events = spark.readStream.schema(PROVIDED["events"]).parquet(landed)
    w = Warehouse(
        {
            **provided_sources(spark, folder),
            "transactions": derive_source("transactions", events),
            "login_attempts": derive_source("login_attempts", events),
        },
        RUN_TS,
        AS_OF,
    )
    path, checkpoint = scratch_path(spark, "failed_logins"), scratch_path(spark, "checkpoint")
    for batch in batches:
        # All files of a batch are one micro-batch; the next ones land after it.
        batch.write.mode("append").parquet(landed)
        stream = lookback.start_failed_login_counts(w.stg_transaction, w.stg_login_attempt, path, checkpoint, STREAM_DELAY)
        stream.awaitTermination()
    return lookback.read_failed_login_counts(spark, path)
