from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskweave.plans import training as T
from riskweave.plans.forest_table import forest_nodes, importances_from_nodes
from riskweave.plans.warehouse import Warehouse
from riskweave.queries import AS_OF, RUN_TS
from riskweave.sources.provided import provided_sources
from tests.conftest import DATA, rows


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse(provided_sources(spark, f"{DATA}/sf0.01"), RUN_TS, AS_OF)


@pytest.fixture(scope="module")
def data(warehouse):
    return T.training_set(warehouse.scored_transactions)


@pytest.fixture(scope="module")
def refined(data):
    return T.train_refined(data)


def test_features_are_numbers_in_the_declared_order(data):
    kinds = dict(data.dtypes)
    assert data.columns == ["transaction_id", "label", *T.TRAINING_FEATURES, "split"]
    assert all(kinds[c] in ("int", "bigint", "double") for c in T.TRAINING_FEATURES)
    assert set(T.SERVING_FEATURES) < set(T.TRAINING_FEATURES)


def test_refined_model_finds_the_fraud(data, refined):
    row = T.evaluate(refined, data).first()
    assert row.tp + row.fp + row.fn + row.tn == data.where("split = 'test'").count()
    assert row.recall > 0.9 and row.precision > 0.75 and row.accuracy > 0.93


def test_baseline_model(data):
    row = T.evaluate(T.train_baseline(data, trees=20), data).first()
    assert row.accuracy > 0.9 and row.precision > 0.9


def test_importances_cover_the_features(data, refined):
    pairs = refined.importances()
    assert {name for name, _ in pairs} == set(T.SERVING_FEATURES)
    assert sum(value for _, value in pairs) == pytest.approx(1.0)
    assert [v for _, v in pairs] == sorted((v for _, v in pairs), reverse=True)
    assert refined.importance_frame(data).count() == 9


def test_a_loaded_model_raises_the_same_alerts(warehouse, refined, tmp_path):
    path = str(tmp_path / "model")
    T.save_forest(refined, path)
    T.save_forest(refined, path)  # overwrites
    enriched = warehouse.enriched_transactions
    want = rows(T.score_transactions(enriched, refined))
    assert rows(T.score_transactions(enriched, T.load_forest(path))) == want
    assert {r[3:] for r in want} == {(1, "ML_MODEL")}
    assert 200 < len(want) < 450


def test_worked_example(spark, refined):
    """Three hand-made rows: the one with every signal is an alert."""
    columns = ["transaction_id", *T.SERVING_FEATURES]
    examples = [
        (1, 100.0, 0, 0, 0, 0, 0, 0, 0, 0),
        (2, 200.0, 3, 1, 1, 1, 1, 1, 1, 1),
        (3, 300.0, 1, 0, 0, 0, 0, 0, 0, 0),
    ]
    got = refined.predict(spark.createDataFrame(examples, columns))
    assert rows(got, "transaction_id", "prediction") == [(1, 0.0), (2, 1.0), (3, 0.0)]


def test_missing_values_are_scored(spark, refined):
    columns = "transaction_id bigint, " + ", ".join(f"{c} double" for c in T.SERVING_FEATURES)
    empty = spark.createDataFrame([(1, *[None] * 9)], columns)
    assert refined.predict(empty).count() == 1


def test_threshold_is_chosen_on_the_training_split(data, refined):
    chosen = T.with_chosen_threshold(refined, data)
    voted, better = T.evaluate(refined, data).first(), T.evaluate(chosen, data).first()
    assert 0 < chosen.threshold < 1
    assert better.accuracy >= 0.97 and better.precision >= 0.9 and better.f1 > voted.f1
    careful = T.with_chosen_threshold(refined, data, least_recall=0.97)
    assert careful.threshold <= chosen.threshold
    # Labels of the test split change nothing.
    hidden = data.withColumn("label", F.when(F.col("split") == "train", F.col("label")))
    assert T.with_chosen_threshold(refined, hidden).threshold == chosen.threshold


def test_a_stored_model_keeps_its_threshold(data, refined, tmp_path):
    test = data.where("split = 'test'")
    for number, threshold in enumerate((0.7, None)):
        path = str(tmp_path / str(number))
        T.save_forest(replace(refined, threshold=threshold), path)
        loaded = T.load_forest(path)
        assert loaded.threshold == threshold
        want = rows(replace(refined, threshold=threshold).predict(test), "transaction_id", "prediction")
        assert rows(loaded.predict(test), "transaction_id", "prediction") == want


def test_a_model_stored_without_a_threshold_is_read(refined, tmp_path):
    path = str(tmp_path / "model")
    refined.model.write().save(path)
    assert T.load_forest(path).threshold is None


def test_importances_follow_from_the_node_table(spark, refined, tmp_path):
    path = str(tmp_path / "model")
    T.save_forest(refined, path)
    nodes = forest_nodes(spark, path, refined.features)
    assert nodes.select("tree").distinct().count() == T.TREES
    assert nodes.where("(feature IS NULL) <> (left_child IS NULL)").count() == 0
    got = {r.feature: r.importance for r in importances_from_nodes(nodes, refined.features).collect()}
    assert got == pytest.approx(dict(refined.importances()), abs=1e-12)


def test_importances_of_trees_without_a_split(spark):
    columns = "tree int, node int, feature string, gain double, weight double"
    stumps = spark.createDataFrame([(0, 0, None, None, 9.0)], columns)
    assert rows(importances_from_nodes(stumps, ["a", "b"])) == [("a", 0.0), ("b", 0.0)]
    mixed = spark.createDataFrame(
        [(0, 0, None, None, 9.0), (1, 0, "a", 0.5, 10.0), (1, 1, "b", 0.5, 6.0), (1, 2, "b", 1.0, 2.0)],
        columns,
    )
    assert dict(rows(importances_from_nodes(mixed, ["a", "b", "c"]))) == {
        "a": 0.5,
        "b": 0.5,
        "c": 0.0,
    }
