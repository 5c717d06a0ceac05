from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from riskweave.operators.alerts import rule_alerts
from riskweave.operators.layers import run_timestamp
from riskweave.plans.warehouse import Warehouse
from riskweave.queries import AS_OF, RUN_TS
from riskweave.sources.alerts_store import read_alerts_folder
from riskweave.sources.provided import provided_sources
from riskweave.sources.tables import conform
from riskweave.streaming import history as H
from riskweave.streaming import incremental as I
from tests.conftest import DATA, rows


@pytest.fixture(scope="module")
def sources(spark):
    return provided_sources(spark, f"{DATA}/sf0.001")


@pytest.fixture(scope="module")
def warehouse(sources):
    return Warehouse(sources, RUN_TS, AS_OF)


@pytest.fixture(scope="module")
def merged(spark, sources, warehouse, tmp_path_factory):
    """A history of the provided events, merged in eleven batches."""
    root = str(tmp_path_factory.mktemp("history"))
    history = H.CustomerHistory(spark, root, buckets=16)
    amounts = I.mart_amounts(warehouse)
    part = F.pmod(F.xxhash64("customer_id", "transaction_amount"), F.lit(11))
    login_part = F.pmod(F.xxhash64("customer_id", "login_timestamp"), F.lit(11))
    for i in range(11):
        assert history.merge(warehouse.stg_login_attempt.where(login_part == i), amounts.where(part == i), "events", i)
        assert not history.merge(warehouse.stg_login_attempt, amounts, "events", i)
    return history


def test_totals_are_those_of_all_rows(merged, warehouse):
    amounts = I.mart_amounts(warehouse).where("customer_id IS NOT NULL AND transaction_amount IS NOT NULL")
    want = {
        r.customer_id: r
        for r in amounts.groupBy("customer_id")
        .agg(F.count("*").alias("n"), F.avg("transaction_amount").alias("m"), F.stddev_pop("transaction_amount").alias("d"))
        .collect()
    }
    nights = {
        r.customer_id: r.night_login_attempts
        for r in warehouse.fact_login_attempt.where("customer_id IS NOT NULL").collect()
    }
    got = {r.customer_id: r for r in merged.read("totals").collect()}
    assert {c for c, r in got.items() if r.amounts} == set(want)
    for customer, r in got.items():
        assert r.night_logins == nights.get(customer, 0)
        if customer in want:
            assert r.amounts == want[customer].n
            assert r.amount_mean == pytest.approx(want[customer].m, rel=1e-12)
            assert (r.spread / r.amounts) ** 0.5 == pytest.approx(want[customer].d, rel=1e-9, abs=1e-9)


def test_logins_are_all_there_once(merged, warehouse):
    want = warehouse.stg_login_attempt.where("customer_id IS NOT NULL").select("customer_id", "login_timestamp", "is_success")
    assert rows(merged.read("logins"), "customer_id", "login_timestamp", "is_success") == rows(want)
    assert merged.rows("logins") >= want.count()


def test_folders_have_few_pieces(merged):
    manifest = merged._manifest()
    for pieces in manifest["pieces"].values():
        assert pieces and all(1 <= len(v) <= H.MERGED for v in pieces.values())


def test_features_equal_those_of_the_batch(merged, sources, warehouse):
    found = I.history_features(sources["transactions"], sources, merged, RUN_TS, AS_OF)
    want = warehouse.features_for_rules
    names = [c for c in want.columns if c != "amount_zscore"]
    assert rows(found, *names) == rows(want, *names)
    scores = {r.transaction_id: r.amount_zscore for r in want.collect()}
    for r in found.select("transaction_id", "amount_zscore").collect():
        expected = scores[r.transaction_id]
        assert (r.amount_zscore is None) == (expected is None)
        assert expected is None or r.amount_zscore == pytest.approx(expected, rel=1e-7, abs=1e-9)


def test_a_batch_reads_only_its_buckets(spark, merged, sources):
    batch = sources["transactions"].where("CustomerID IN (3, 5)")
    buckets, n = merged.buckets_of(spark.createDataFrame([(3,), (5,), (None,)], "customer_id long"))
    assert 1 <= len(buckets) <= 2 and n == 3
    scored = I.history_features(batch, sources, merged, RUN_TS, AS_OF)
    opened = [re.search(r"/(logins|totals)/version=\d+/bucket=(\d+)/", f) for f in scored.inputFiles() if merged.root in f]
    assert opened and {int(m[2]) for m in opened} <= set(buckets)
    # Stored logins and transactions are not read; the batch itself comes from the events.
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LoginTimestamp") == 0


def test_an_interrupted_merge_changes_nothing(spark, merged, warehouse, monkeypatch):
    before = rows(merged.read("logins"))
    version = merged._versions.current()
    monkeypatch.setattr(merged._versions, "declare", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merged.merge(warehouse.stg_login_attempt)
    monkeypatch.undo()
    assert merged._versions.current() == version and rows(merged.read("logins")) == before


def test_alerts_over_several_batches_equal_the_batch(spark, merged, sources, warehouse, tmp_path):
    landed, alerts = f"{tmp_path}/tx", f"{tmp_path}/alerts"
    conform("transactions", sources["transactions"]).repartition(4, F.rand(3)).write.parquet(landed)
    scorer = I.history_scorer(lambda: sources, merged, RUN_TS, AS_OF)
    stream = I.transaction_stream(spark, landed, files_per_batch=1)
    query = I.start_incremental_alerts(stream, scorer, alerts, f"{tmp_path}/c", run_timestamp(RUN_TS))
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    want = rows(rule_alerts(warehouse.scored_transactions))
    assert rows(read_alerts_folder(spark, alerts).drop("id", "inserted_at")) == want and want


def test_empty_history_and_null_customers(spark, sources, tmp_path):
    history = H.CustomerHistory(spark, f"{tmp_path}/h")
    assert history.read("logins").count() == history.read("totals").count() == 0
    batch = sources["transactions"].limit(5).withColumn("CustomerID", F.lit(None).cast("bigint"))
    found = I.history_features(batch, sources, history, RUN_TS, AS_OF).collect()
    assert len(found) >= 5 and all(r.amount_zscore is None and r.failed_logins_24h == 0 for r in found)
    empty = sources["login_attempts"].where("false").selectExpr("CustomerID customer_id", "LoginTimestamp login_timestamp", "Success is_success")
    assert history.merge(empty, source="x", batch=0) and not history.merge(empty, source="x", batch=0)
    assert history.read("logins").count() == 0


def test_combining_pieces_is_the_variance_of_all(spark):
    rng = random.Random(1)
    values = [rng.lognormvariate(3, 1) for _ in range(300)]
    frame = lambda part: spark.createDataFrame([(1, v) for v in part], "customer_id long, transaction_amount double")
    pieces = [H._amount_rows(frame(values[i * 100 : i * 100 + 100])) for i in range(3)]
    got = H.combined(pieces[0].unionByName(pieces[1]).unionByName(pieces[2])).first()
    mean = sum(values) / 300
    assert got.amounts == 300 and got.amount_mean == pytest.approx(mean)
    assert got.spread == pytest.approx(sum((v - mean) ** 2 for v in values))
