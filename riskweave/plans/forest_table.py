"""A stored forest as a table of its nodes, and what can be read off it.

The table has a row per node: its size is set by the number of trees and their
depth, not by the data the forest has seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def forest_nodes(spark: SparkSession, path: str, features: Sequence[str]) -> DataFrame:
    """The nodes of the forest that ``save_forest`` stored at ``path``.

    Leaves have no feature, threshold or children. ``weight`` is the weight of
    the training rows that reached the node, class weights included; a row goes
    left if its feature is at most the threshold.
    """
    stored = spark.read.parquet(f"{path}/stages/*/data")
    node = "nodeData"
    inner = F.col(f"{node}.leftChild") >= 0
    names = F.array(*[F.lit(name) for name in features])
    return stored.select(
        F.col("treeID").alias("tree"),
        F.col(f"{node}.id").alias("node"),
        F.when(inner, F.get(names, F.col(f"{node}.split.featureIndex"))).alias("feature"),
        F.when(inner, F.get(F.col(f"{node}.split.leftCategoriesOrThreshold"), F.lit(0))).alias(
            "threshold"
        ),
        F.when(inner, F.col(f"{node}.leftChild")).alias("left_child"),
        F.when(inner, F.col(f"{node}.rightChild")).alias("right_child"),
        F.when(inner, F.col(f"{node}.gain")).alias("gain"),
        F.col(f"{node}.impurity").alias("impurity"),
        F.aggregate(f"{node}.impurityStats", F.lit(0.0), lambda total, w: total + w).alias("weight"),
        F.col(f"{node}.rawCount").alias("training_rows"),
        F.col(f"{node}.prediction").alias("prediction"),
    )


def importances_from_nodes(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Importance of every feature, recomputed from the node table.

    A split counts with its gain times the weight of its rows; the splits of a
    tree sum to one, and so do the features over all trees. A tree without a
    split takes no part; features that no tree splits on have importance 0.
    """
    spark = nodes.sparkSession
    splits = nodes.where("feature IS NOT NULL").groupBy("tree", "feature")
    per_tree = splits.agg(F.sum(F.col("gain") * F.col("weight")).alias("_gain"))
    in_tree = Window.partitionBy("tree")
    shares = per_tree.select(
        "tree", "feature", F.try_divide("_gain", F.sum("_gain").over(in_tree)).alias("_share")
    )
    trees = shares.groupBy("feature").agg(F.sum("_share").alias("_share"))
    every = spark.createDataFrame([(name,) for name in features], "feature string")
    joined = every.join(trees, "feature", "left").withColumn(
        "_share", F.coalesce("_share", F.lit(0.0))
    )
    # One row per feature from here on.
    features_window = Window.partitionBy(F.lit(1))
    total = F.sum("_share").over(features_window)
    importance = F.coalesce(F.try_divide("_share", total), F.lit(0.0))
    return joined.select("feature", importance.alias("importance"))
