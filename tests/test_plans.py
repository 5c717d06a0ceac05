"""What the physical plans must look like to hold up at scale."""

from __future__ import annotations

import contextlib
import io

import pytest

from riskweave.operators import quality as Q
from riskweave.operators.features import enrich_for_rules
from riskweave.operators.rules import apply_rules
from riskweave.operators.skew import KeySkew, measure_skew
from riskweave.plans.warehouse import Warehouse
from riskweave.queries import AS_OF, RUN_TS
from riskweave.sources.provided import provided_sources
from riskweave.sources.tables import load_marts, write_mart
from tests.conftest import DATA, rows

NO_SKEW = KeySkew("customer_id", None)


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse(provided_sources(spark, f"{DATA}/sf0.001"), RUN_TS, AS_OF)


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables far too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df):
    return plan(df).split("\n\n\n")[0]


def test_scoring_the_marts_takes_one_exchange(spark, warehouse, tmp_path):
    for name in ("v_transaction", "v_login_attempt"):
        write_mart(getattr(warehouse, name), str(tmp_path), name)
    transactions, logins = load_marts(spark, str(tmp_path))
    scored = apply_rules(enrich_for_rules(transactions, logins, skew=NO_SKEW))
    assert tree(scored).count("Exchange") == 1
    assert tree(scored).count("Sort") == 1
    assert "hashpartitioning(customer_id" in plan(scored)
    # Only what the features need is read of the logins.
    assert "login_month" not in plan(scored)


def test_whole_pipeline_does_not_shuffle_again_after_the_mart(warehouse, no_broadcast):
    enriched = enrich_for_rules(
        warehouse.v_transaction, warehouse.fact_login_attempt, skew=NO_SKEW
    )
    scored = tree(apply_rules(enriched))
    # Transactions by merchant and by customer, merchants, customers, logins, login counts.
    assert scored.count("Exchange") == 6
    above_union = scored.split("Union")[0]
    assert "Exchange" not in above_union


def test_hot_customers_leave_before_the_joins(warehouse, no_broadcast):
    """Checked hot keys are broadcast whatever the threshold; no nested loops appear."""
    skew = measure_skew(
        "customer_id", [warehouse.stg_transaction, warehouse.stg_login_attempt], limit=70
    )
    assert skew.hot is not None
    split = Warehouse(warehouse.sources, RUN_TS, AS_OF)
    split.customer_skew = skew
    text = tree(split.scored_transactions)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "BroadcastHashJoin LeftAnti" in text and "BroadcastHashJoin LeftSemi" in text
    ordinary = text[: text.index("LeftSemi")].splitlines()
    depth = {
        join: [line.index(join) for line in ordinary if join in line]
        for join in ("LeftAnti", "SortMergeJoin LeftOuter")
    }
    # Transactions, logins, and the logins the counts are taken of.
    assert len(depth["LeftAnti"]) == 3
    assert min(depth["LeftAnti"]) > min(depth["SortMergeJoin LeftOuter"])
    counts = dict(rows(split.scored_transactions.groupBy("label").count()))
    assert counts == {1: 42, 0: 160}


def test_login_counts_are_combined_before_their_shuffle(warehouse, no_broadcast):
    fact = tree(warehouse.fact_login_attempt)
    assert fact.count("HashAggregate") == 2 and "Window" not in fact


def test_filters_and_columns_reach_the_scan(warehouse):
    picked = plan(warehouse.fact_transaction.select("transaction_id", "is_high_value_transaction"))
    assert "EqualTo(event_type,purchase)" in picked
    assert "props" not in picked and "c_name" not in picked


@pytest.mark.parametrize("name", ["v_transaction", "v_login_attempt", "fact_login_attempt"])
def test_no_python_and_no_single_task_windows(warehouse, name):
    text = plan(getattr(warehouse, name))
    assert "Python" not in text and "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_customers_are_not_sorted_whole(warehouse):
    from riskweave.operators.alerts import rule_alerts, top_risky_customers

    top = tree(top_risky_customers(rule_alerts(warehouse.scored_transactions)))
    assert "TakeOrderedAndProject" in top


def test_profiles_and_key_checks_scan_once(spark):
    customers = provided_sources(spark, f"{DATA}/sf0.001")["customers"]
    for result in (
        Q.column_profile(customers, customers.columns),
        Q.run_checks(
            {"m": customers},
            [Q.Check("m", Q.UNIQUE, (c,)) for c in ("CustomerID", "HomeDevice", "HomeIP")],
        ),
    ):
        nodes = tree(result)
        assert nodes.count("Scan parquet") == 1
        # One for the values, one for the single row of results.
        assert nodes.count("Exchange") == 2
