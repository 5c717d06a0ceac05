from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskweave.operators import quality as Q
from tests.conftest import at, rows


def test_declared_checks():
    kinds = Counter(check.kind for check in Q.CHECKS)
    assert kinds == {
        Q.NOT_NULL: 35,
        Q.BETWEEN: 8,
        Q.UNIQUE: 6,
        Q.NOT_CONSTANT: 4,
        Q.TYPE: 2,
        Q.IN_SET: 1,
        Q.UNIQUE_COMBO: 1,
    }
    assert len(Q.CHECKS) == 57 == len(set(Q.CHECKS))


def failing(spark, data, schema, *checks):
    results = Q.run_checks({"m": spark.createDataFrame(data, schema)}, checks)
    return {(r.column_name, r.check_kind): r.failing_rows for r in results.collect()}


def test_row_checks_share_one_result(spark):
    checks = [
        Q.Check("m", Q.NOT_NULL, ("a",)),
        Q.Check("m", Q.BETWEEN, ("a",), 0, 10),
        Q.Check("m", Q.IN_SET, ("b",), values=(True,)),
        Q.Check("m", Q.TYPE, ("a",), type_name="bigint"),
        Q.Check("m", Q.TYPE, ("b",), type_name="bigint"),
    ]
    data = [(0, True), (10, False), (11, None), (-1, True), (None, False)]
    assert failing(spark, data, "a bigint, b boolean", *checks) == {
        ("a", "not_null"): 1,
        ("a", "between"): 2,
        ("b", "in_set"): 2,
        ("a", "type"): 0,
        ("b", "type"): 5,
    }


def test_open_range_has_no_upper_bound(spark):
    check = Q.Check("m", Q.BETWEEN, ("a",), 0)
    assert failing(spark, [(10**9,), (-1,)], "a bigint", check) == {("a", "between"): 1}


@pytest.mark.parametrize(
    "data, want", [([(1,), (1,)], 1), ([(1,), (2,)], 0), ([(None,), (1,)], 1), ([(None,)], 0)]
)
def test_not_constant(spark, data, want):
    check = Q.Check("m", Q.NOT_CONSTANT, ("a",))
    assert failing(spark, data, "a bigint", check) == {("a", "not_constant"): want}


def test_unique_ignores_nulls_and_counts_values(spark):
    data = [(1, 1), (1, 2), (1, 2), (2, 1), (None, 5), (None, 5)]
    checks = [Q.Check("m", Q.UNIQUE, ("a",)), Q.Check("m", Q.UNIQUE_COMBO, ("a", "b"))]
    assert failing(spark, data, "a bigint, b bigint", *checks) == {
        ("a", "unique"): 1,
        ("a,b", "unique_combination"): 2,
    }


def test_gate(spark):
    good = Q.run_checks(
        {"m": spark.createDataFrame([(1,)], "a bigint")}, [Q.Check("m", Q.NOT_NULL, ("a",))]
    )
    Q.require_passed(good)
    bad = Q.run_checks(
        {"m": spark.createDataFrame([(None,)], "a bigint")}, [Q.Check("m", Q.NOT_NULL, ("a",))]
    )
    with pytest.raises(Q.QualityError, match="m.a not_null"):
        Q.require_passed(bad)


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k bigint")
    parent = spark.createDataFrame([(2,), (2,)], "k bigint")
    assert rows(Q.orphans(child, parent, "k", "r")) == [("r", 3, 2)]
    assert rows(Q.orphans(parent, child, "k", "r")) == [("r", 0, 0)]


def test_key_types(spark):
    a = spark.createDataFrame([(1,)], "k bigint")
    b = spark.createDataFrame([(1,)], "k int")
    got = rows(Q.key_type_agreement({"same": (a, "k", a, "k"), "other": (a, "k", b, "k")}))
    assert got == [("other", "bigint", "int", 1), ("same", "bigint", "bigint", 0)]


def test_types_are_those_of_the_files(spark, tmp_path):
    """A key stored as INT fails, although every read declares BIGINT."""
    path = str(tmp_path / "customers")
    spark.createDataFrame([(1,), (2,)], "CustomerID int").write.parquet(path)
    declared = spark.read.schema("CustomerID bigint").parquet(path)
    stored = spark.read.parquet(path)
    check = Q.Check("m", Q.TYPE, ("CustomerID",), type_name="bigint")
    found = Q.run_checks({"m": declared}, [check], {"m": stored}).first()
    assert found.failing_rows == 2
    assert Q.run_checks({"m": declared}, [check], {"m": declared}).first().failing_rows == 0


def test_key_sequence(spark):
    df = spark.createDataFrame([(5,), (6,), (6,), (9,)], "k bigint")
    assert rows(Q.key_sequence(df, "k")) == [(5, 9, 2, 1)]


def test_category_risk(spark):
    merchants = [("Crypto", 0.7), ("Crypto", 0.8), ("Bakery", 0.1), (None, None)]
    df = spark.createDataFrame(merchants, "Category string, MerchantRiskScore double")
    assert rows(Q.category_risk_consistency(df)) == [
        ("Bakery", 1, 1, 1),
        ("Crypto", 2, 0, 1),
        (None, 1, 1, 0),
    ]


@pytest.mark.parametrize("second, want", [("01 00:00:09", (9, 0)), ("01 00:00:10", (10, 1))])
def test_ingestion_skew(spark, second, want):
    schema = "ingestion_date timestamp_ntz"
    models = {
        "a": spark.createDataFrame([(at("01 00:00"),)], schema),
        "b": spark.createDataFrame([(at(second),)], schema),
    }
    assert rows(Q.ingestion_skew(models), "skew_seconds", "failing_rows") == [want]


def test_profile(spark):
    df = spark.createDataFrame([(2, "b"), (10, None), (2, "a")], "n bigint, t string")
    assert rows(Q.column_profile(df, df.columns)) == [
        ("n", "2", "10", 2, 0),
        ("t", "a", "b", 2, 1),
    ]


def test_row_checks_take_one_pass(spark):
    df = spark.range(10).withColumn("x", F.col("id"))
    checks = [Q.Check("m", Q.NOT_NULL, (c,)) for c in ("id", "x")]
    checks += [Q.Check("m", Q.BETWEEN, ("x",), 0, 5), Q.Check("m", Q.NOT_CONSTANT, ("x",))]
    plan = Q.run_checks({"m": df}, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_key_checks_of_a_model_share_counts(spark):
    data = [(1, "x", 1), (1, "x", 2), (2, None, 2), (None, None, 3), (None, "y", 3)]
    checks = [
        Q.Check("m", Q.UNIQUE, ("a",)),
        Q.Check("m", Q.UNIQUE, ("b",)),
        Q.Check("m", Q.UNIQUE, ("c",)),
        Q.Check("m", Q.UNIQUE_COMBO, ("a", "b")),
        Q.Check("m", Q.UNIQUE_COMBO, ("b", "a")),
        Q.Check("m", Q.UNIQUE_COMBO, ("a",)),
    ]
    found = Q.run_checks({"m": spark.createDataFrame(data, "a bigint, b string, c int")}, checks)
    assert [r.failing_rows for r in found.collect()] == [1, 1, 2, 1, 1, 2]


def test_values_counted_per_key(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, "x")], "a bigint, b string")
    got = rows(Q.value_counts(df, [("b",), ("a",), ("a", "b")]))
    # Columns stand in the order in which the keys name them first.
    assert got == sorted(
        [
            (0, "x", None, 2),
            (0, None, None, 1),
            (1, None, 1, 2),
            (1, None, None, 1),
            (2, "x", 1, 1),
            (2, None, 1, 1),
            (2, "x", None, 1),
        ],
        key=repr,
    )


def test_profile_of_odd_names_and_types(spark):
    df = spark.createDataFrame(
        [(2, True, at("03 12:30")), (10, None, None), (None, None, None)],
        "`a b` int, `x.y` boolean, t timestamp_ntz",
    )
    assert rows(Q.column_profile(df, df.columns)) == [
        ("a b", "2", "10", 2, 1),
        ("t", "2024-01-03 12:30:00", "2024-01-03 12:30:00", 1, 2),
        ("x.y", "true", "true", 1, 2),
    ]
    assert rows(Q.column_profile(df.limit(0), ["a b"])) == [("a b", None, None, 0, 0)]
