"""Label counts, class weights and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("split", "label").agg(F.count("*").alias("row_count"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("row_count"))
    # One row per class from here on.
    classes = Window.partitionBy(F.lit(1))
    weight = F.sum("row_count").over(classes) / (
        F.count("*").over(classes) * F.col("row_count")
    )
    return counts.select(label, "row_count", weight.alias("class_weight"))


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``class_weight`` to every row; the broadcast side has a row per class."""
    weights = class_weights(df, label).select(label, "class_weight")
    return df.join(F.broadcast(weights), label)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def binary_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 of class 1, in one pass."""
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    counts = predictions.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *counts.columns,
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def metrics_by_flag(
    predictions: DataFrame,
    flags: Sequence[str],
    fired: str = "flags",
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Per flag, the confusion counts and recall of the rows that carry it.

    Shows which rule's positives a model misses. ``fired`` lists a row's flags,
    separated by commas; a row counts for each of them once. One pass, with a
    row per flag even where no row carries it.
    """
    listed = F.split(F.col(fired), ",")
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    cells = {
        "tp": actual & predicted,
        "fp": ~actual & predicted,
        "fn": actual & ~predicted,
        "tn": ~actual & ~predicted,
    }
    counts = predictions.agg(
        *[
            F.struct(
                *[
                    F.count_if(F.array_contains(listed, flag) & cell).alias(name)
                    for name, cell in cells.items()
                ]
            ).alias(f"_{i}")
            for i, flag in enumerate(flags)
        ]
    )
    entries = [F.struct(F.lit(flag).alias("flag"), f"_{i}.*") for i, flag in enumerate(flags)]
    rows = counts.select(F.inline(F.array(*entries)))
    return rows.select("*", _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))
