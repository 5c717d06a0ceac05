"""Scoring of newly landed transactions, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators.alerts import rule_alerts
from riskweave.operators.features import (
    amount_statistics,
    features_from_flags,
    zscore_from_statistics,
)
from riskweave.operators.rules import apply_rules
from riskweave.operators.skew import GROUP_LIMIT, KeySkew
from riskweave.plans.training import TrainedForest, score_transactions
from riskweave.plans.warehouse import Warehouse
from riskweave.schemas import SOURCES
from riskweave.sources.alerts_store import append_alerts, create_alerts_folder
from riskweave.streaming.history import CustomerHistory

Scorer = Callable[[DataFrame], DataFrame]
# Reads the stored tables as they are now; a frame made earlier keeps the file
# list of that moment, so it is called for every batch.
Loader = Callable[[], Mapping[str, DataFrame]]


def transaction_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """New files of the transactions table, as they land below ``path``."""
    reader = spark.readStream.schema(SOURCES["transactions"])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def enrich_batch(batch: DataFrame, stored: Mapping[str, DataFrame], run_ts, as_of) -> DataFrame:
    """Features of one batch against the stored customers, merchants and logins.

    Logins are reduced to the batch's customers before anything is computed from
    them; the reduction scans the stored logins' four columns.
    """
    customers = batch.select("CustomerID").distinct()
    logins = stored["login_attempts"].join(customers, "CustomerID", "left_semi")
    tables = {**stored, "transactions": batch, "login_attempts": logins}
    return Warehouse(tables, run_ts, as_of).enriched_transactions


def mart_amounts(warehouse: Warehouse) -> DataFrame:
    """Customer and amount of every mart row, without the mart's other joins.

    A transaction counts once for each snapshot of its merchant, as it does in
    the mart that batch scoring judges amounts by.
    """
    merchants = warehouse.dim_merchant.select("merchant_id")
    joined = warehouse.stg_transaction.join(merchants, "merchant_id", "left")
    return joined.select("customer_id", "transaction_amount")


def rule_scorer(
    load: Loader, run_ts, as_of, statistics: Callable[[], DataFrame] | None = None
) -> Scorer:
    """Rule alerts of a batch; amounts are judged by each customer's stored history.

    ``statistics`` may read the customers' amount statistics from a table that is
    refreshed apart from the stream. Otherwise they are computed from the stored
    transactions of the batch's customers.
    """

    def score(batch: DataFrame) -> DataFrame:
        stored = load()
        enriched = enrich_batch(batch, stored, run_ts, as_of)
        if statistics is not None:
            known = statistics()
        else:
            customers = batch.select("CustomerID").distinct()
            history = stored["transactions"].join(customers, "CustomerID", "left_semi")
            past = Warehouse({**stored, "transactions": history}, run_ts, as_of)
            known = amount_statistics(mart_amounts(past))
        return rule_alerts(apply_rules(zscore_from_statistics(enriched, known)))

    return score


def history_features(
    batch: DataFrame, stored: Mapping[str, DataFrame], history: CustomerHistory, run_ts, as_of
) -> DataFrame:
    """Features and z-scores of one batch from its customers' history.

    Opens the history's folders of the batch's customers; stored transactions
    and logins are not read. ``stored`` gives customers and merchants.
    """
    customers = batch.select(F.col("CustomerID").cast("bigint").alias("customer_id"))
    buckets, rows = history.buckets_of(customers)
    # Where all rows together are few, no customer can be too large for a task.
    few = rows + history.rows("logins") <= GROUP_LIMIT
    skew = KeySkew("customer_id", None) if few else None
    logins = history.read("logins", buckets).join(customers.distinct(), "customer_id", "left_semi")
    totals = history.read("totals", buckets)
    nights = totals.select("customer_id", (F.col("night_logins") > 0).alias("night_login"))
    known = totals.where("amounts > 0").select(
        "customer_id", "amount_mean", F.sqrt(F.try_divide("spread", "amounts")).alias("amount_deviation")
    )
    mart = Warehouse({**stored, "transactions": batch}, run_ts, as_of).v_transaction
    enriched = features_from_flags(mart, logins.join(nights, "customer_id", "left"), skew=skew)
    return zscore_from_statistics(enriched, known)


def history_scorer(load: Loader, history: CustomerHistory, run_ts, as_of) -> Scorer:
    """Rule alerts of a batch, whose cost follows the batch and its customers."""

    def score(batch: DataFrame) -> DataFrame:
        return rule_alerts(apply_rules(history_features(batch, load(), history, run_ts, as_of)))

    return score


def model_scorer(load: Loader, forest: TrainedForest, run_ts, as_of) -> Scorer:
    """Model alerts of a batch."""

    def score(batch: DataFrame) -> DataFrame:
        return score_transactions(enrich_batch(batch, load(), run_ts, as_of), forest)

    return score


def start_incremental_alerts(
    transactions: DataFrame,
    scorer: Scorer,
    alerts_path: str,
    checkpoint: str,
    inserted_at: Column,
    continuous: bool = False,
) -> StreamingQuery:
    """Score each micro-batch and append the alerts that are new.

    Replaying a batch, or the whole stream from an empty checkpoint, adds nothing:
    transactions with a stored alert of the same kind are left out. By default the query handles
    what has landed and stops; ``continuous`` keeps it running.
    """

    create_alerts_folder(transactions.sparkSession, alerts_path)

    def handle(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            append_alerts(scorer(batch), alerts_path, inserted_at, only_new=True)
        finally:
            batch.unpersist()

    writer = transactions.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()
