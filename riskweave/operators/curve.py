"""How well a score ranks a label: the exact curve over all thresholds, and a threshold chosen from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.operators.ordered import POSITION, SEGMENT, carried_forward, ordered_segments


def _known(score: str) -> Column:
    """The score as a double; NaN is no score."""
    value = F.col(score).cast("double")
    return F.when(~F.isnan(value), value)


def precision_recall_curve(
    df: DataFrame, score: str = "score", label: str = "label", partitions: int | None = None
) -> DataFrame:
    """Confusion counts, precision, recall and F1 at every distinct score, taken as a threshold.

    A row counts as predicted if its score is at least the threshold. Rows without
    a score are never predicted, rows without a label take no part. Rows meet per
    score before anything is sorted, so ties, however many, are one row; the sums
    down the order are taken in all segments at once. Only the two totals reach
    the driver.
    """
    labelled = df.select(_known(score).alias("threshold"), F.col(label).alias("_label")).where(
        "_label IS NOT NULL"
    )
    per_score = labelled.groupBy("threshold").agg(
        F.count_if(F.col("_label") == 1).alias("_positives"), F.count("*").alias("_rows")
    )
    placed = ordered_segments(per_score, [F.col("threshold").desc_nulls_last()], partitions)
    positives, rows = placed.agg(
        F.coalesce(F.sum("_positives"), F.lit(0)), F.coalesce(F.sum("_rows"), F.lit(0))
    ).first()
    totals = {"_tp": ("_positives", F.sum), "_predicted": ("_rows", F.sum)}
    within = (
        Window.partitionBy(SEGMENT)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = {
        name: F.sum(source).over(within) + F.coalesce(name, F.lit(0))
        for name, (source, _) in totals.items()
    }
    summed = placed.join(carried_forward(placed, [], totals), SEGMENT, "left").withColumns(running)
    tp, predicted = F.col("_tp"), F.col("_predicted")
    return summed.where("threshold IS NOT NULL").select(
        "threshold",
        tp.alias("tp"),
        (predicted - tp).alias("fp"),
        (positives - tp).alias("fn"),
        (rows - positives - predicted + tp).alias("tn"),
        (tp / predicted).alias("precision"),
        (F.when(F.lit(positives) > 0, tp / F.lit(positives)).otherwise(0.0)).alias("recall"),
        (2 * tp / (predicted + positives)).alias("f1"),
    )


def best_threshold(curve: DataFrame, least_recall: float = 0.0) -> float | None:
    """The threshold of highest F1 among those with the recall asked for, of equals the highest.

    None if there is none, as over an empty table.
    """
    best = F.max(F.struct("f1", "threshold"))
    found = curve.where(F.col("recall") >= least_recall).agg(best.alias("best")).first().best
    return None if found is None else found.threshold


def predicted_from(df: DataFrame, threshold: float | None, score: str = "score") -> DataFrame:
    """Add ``prediction``: 1.0 where the score is at least the threshold, else 0.0."""
    reached = F.coalesce(_known(score) >= F.lit(threshold).cast("double"), F.lit(False))
    return df.withColumn("prediction", reached.cast("double"))
