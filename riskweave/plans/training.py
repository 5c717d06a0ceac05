"""Training, evaluating, storing and applying the fraud model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import as_flag, risk_level_code
from riskweave.operators.alerts import model_alerts
from riskweave.operators.curve import best_threshold, precision_recall_curve, predicted_from
from riskweave.operators.metrics import binary_metrics, with_class_weight
from riskweave.operators.sampling import stratified_split
from riskweave.session import materialize

# The model's features in their order, and its shape.
SERVING_FEATURES = (
    "transaction_amount",
    "failed_logins_24h",
    "geo_mismatch",
    "odd_hours",
    "weekend_login",
    "night_login",
    "is_high_risk_merchant",
    "customer_has_fraud_history",
    "customer_past_fraud_count",
)
TRAINING_FEATURES = (*SERVING_FEATURES, "customer_risk_level")
BOOLEAN_FEATURES = (
    "geo_mismatch",
    "odd_hours",
    "weekend_login",
    "night_login",
    "is_high_risk_merchant",
    "customer_has_fraud_history",
)
TREES, DEPTH, SEED = 100, 5, 42


def encoded(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the features as numbers: booleans 0/1, risk levels 0/1/2."""
    columns = []
    for name in features:
        if name in BOOLEAN_FEATURES:
            column = as_flag(F.col(name))
        elif name == "customer_risk_level":
            column = risk_level_code(F.col(name))
        else:
            column = F.col(name)
        columns.append(column.alias(name))
    return df.select(*keep, *columns)


def training_features(scored: DataFrame) -> DataFrame:
    """Ten features and the rule label of every transaction."""
    return encoded(scored, TRAINING_FEATURES, keep=("transaction_id", "label"))


def training_set(scored: DataFrame) -> DataFrame:
    """Features, label and split, written once: training passes over them often."""
    return materialize(
        stratified_split(materialize(training_features(scored), "features")), "training_set"
    )


def _without_gaps(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """A missing amount stands for zero, and so does what an unknown customer lacks."""
    return df.fillna(0, subset=list(features))


@dataclass(frozen=True)
class TrainedForest:
    """``threshold`` is the score from which a row is predicted; without one the trees' vote decides."""

    model: PipelineModel
    features: tuple[str, ...]
    threshold: float | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """Add the trees' vote and ``score``, the probability of class 1."""
        voted = self.model.transform(_without_gaps(df, self.features))
        return voted.withColumn("score", vector_to_array("probability")[1])

    def predict(self, df: DataFrame) -> DataFrame:
        scored = self.score(df)
        return scored if self.threshold is None else predicted_from(scored, self.threshold)

    def importances(self) -> list[tuple[str, float]]:
        """Features by importance, highest first."""
        values = self.model.stages[-1].featureImportances.toArray().tolist()
        return sorted(zip(self.features, values), key=lambda pair: (-pair[1], pair[0]))

    def importance_frame(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame(
            self.importances(), "feature string, importance double"
        )


def train_forest(
    train: DataFrame, features: Sequence[str], balanced: bool, trees: int = TREES, seed: int = SEED
) -> TrainedForest:
    data = _without_gaps(train, features)
    if balanced:
        data = with_class_weight(data)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=DEPTH, seed=seed
    )
    if balanced:
        forest = forest.setWeightCol("class_weight")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return TrainedForest(Pipeline(stages=[assembler, forest]).fit(data), tuple(features))


def train_baseline(data: DataFrame, **options) -> TrainedForest:
    """All ten features, unweighted."""
    return train_forest(data.where("split = 'train'"), TRAINING_FEATURES, False, **options)


def train_refined(data: DataFrame, **options) -> TrainedForest:
    """Nine features, classes balanced by weight: the model that is served."""
    return train_forest(data.where("split = 'train'"), SERVING_FEATURES, True, **options)


def evaluate(forest: TrainedForest, data: DataFrame) -> DataFrame:
    """Metrics on the test split."""
    return binary_metrics(forest.predict(data.where("split = 'test'")))


def with_chosen_threshold(
    forest: TrainedForest, data: DataFrame, least_recall: float = 0.0
) -> TrainedForest:
    """The forest with the threshold of highest F1 on the training split.

    ``least_recall`` is what the threshold has to reach there. The test split is
    not looked at. Without a row to choose from the forest stays as it is.
    """
    scored = forest.score(data.where("split = 'train'"))
    chosen = best_threshold(precision_recall_curve(scored), least_recall)
    return replace(forest, threshold=chosen)


def save_forest(forest: TrainedForest, path: str) -> None:
    """Store the model, and its threshold beside it."""
    forest.model.write().overwrite().save(path)
    spark = SparkSession.active()
    threshold = spark.createDataFrame([(forest.threshold,)], "threshold double")
    threshold.coalesce(1).write.mode("overwrite").parquet(f"{path}/threshold")


def load_forest(path: str, features: Sequence[str] = SERVING_FEATURES) -> TrainedForest:
    """A stored model; one that was stored without a threshold has none."""
    model = PipelineModel.load(path)
    spark = SparkSession.active()
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/threshold")
    if not beside.getFileSystem(spark._jsc.hadoopConfiguration()).exists(beside):
        return TrainedForest(model, tuple(features))
    stored = spark.read.schema("threshold double").parquet(f"{path}/threshold").first()
    return TrainedForest(model, tuple(features), stored.threshold)


def score_transactions(enriched: DataFrame, forest: TrainedForest) -> DataFrame:
    """Alerts the model raises on enriched transactions."""
    keep = ("transaction_id", "customer_id", "transaction_timestamp")
    return model_alerts(forest.predict(encoded(enriched, forest.features, keep)))
