"""The jobs one after the other, on the provided tables."""

from __future__ import annotations

import os
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskweave import __main__ as command
from riskweave.operators.quality import (
    CHECKS,
    UNIQUE,
    UNIQUE_COMBO,
    Check,
    ObservedChecks,
    QualityError,
    file_load_skew,
    run_checks,
)
from riskweave.plans import jobs
from riskweave.plans.warehouse import Warehouse
from riskweave.session import sibling
from riskweave.sources.alerts_store import read_alerts_folder
from riskweave.sources.provided import provided_sources
from riskweave.sources.tables import load_marts, read_sources, row_counts, write_source
from tests.conftest import DATA, rows
from tests.test_plans import plan

RUN_TS, AS_OF = "2024-02-01 00:00:00", "2024-02-01"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("pipeline"))
    for name, df in provided_sources(spark, f"{DATA}/sf0.01").items():
        # The gate accepts no missing values.
        write_source(df.na.drop(), f"{root}/sources", name)
    return root


@pytest.fixture(scope="module")
def warehouse(spark, root):
    return jobs.build_marts(spark, f"{root}/sources", f"{root}/marts", RUN_TS, AS_OF, gate=True)


def test_complete_rows_pass_all_checks(warehouse):
    results = jobs.check_warehouse(warehouse).collect()
    assert len(results) == 57
    assert [r for r in results if r.failing_rows] == []


def test_marts_hold_every_row(spark, root, warehouse):
    counts = dict(rows(row_counts(read_sources(spark, f"{root}/sources"))))
    transactions, logins = load_marts(spark, f"{root}/marts")
    assert transactions.count() == counts["transactions"]
    assert logins.count() == counts["login_attempts"]


def test_train_score_report_notify(spark, root, warehouse):
    metrics = jobs.train_model(spark, f"{root}/marts", f"{root}/model").first()
    assert metrics.accuracy > 0.9 and metrics.recall > 0.85
    alerts, feed = f"{root}/alerts", f"{root}/feed"
    for _ in range(2):
        jobs.score_marts(spark, f"{root}/marts", alerts, RUN_TS, f"{root}/model")
    stored = read_alerts_folder(spark, alerts)
    assert 0 < stored.count() == stored.select("transaction_id").distinct().count()
    top = jobs.report_top_customers(spark, alerts).collect()
    assert len(top) == 10
    totals = [r.total_risk_score for r in top]
    assert totals == sorted(totals, reverse=True)
    jobs.write_notifications(spark, alerts, feed)
    assert spark.read.parquet(feed).count() == stored.count()
    jobs.write_notifications(spark, alerts, feed, once_per_customer=True)
    assert spark.read.parquet(feed).count() == stored.select("customer_id").distinct().count()


def test_rule_alerts(spark, root, warehouse):
    every = f"{root}/rule_alerts"
    jobs.score_marts(spark, f"{root}/marts", every, RUN_TS)
    flags = {r[0] for r in rows(read_alerts_folder(spark, every), "flags")}
    assert "GEO_MISMATCH" in ",".join(flags)


def test_the_gate_looks_at_the_types_of_the_files(spark, root, tmp_path):
    for name, df in read_sources(spark, f"{root}/sources").items():
        df.write.parquet(f"{tmp_path}/sources/{name}")
    customers = read_sources(spark, f"{root}/sources")["customers"]
    narrow = customers.withColumn("CustomerID", customers.CustomerID.cast("int"))
    narrow.write.mode("overwrite").parquet(f"{tmp_path}/sources/customers")
    with pytest.raises(QualityError, match="CustomerID type"):
        jobs.build_marts(spark, f"{tmp_path}/sources", f"{tmp_path}/marts", RUN_TS, AS_OF, gate=True)


def test_gate_stops_a_bad_load(spark, root, tmp_path):
    sources = f"{root}/sources"
    bad = read_sources(spark, sources)["merchants"].selectExpr(
        "* EXCEPT (MerchantRiskScore)", "2D AS MerchantRiskScore"
    )
    bad.write.parquet(f"{tmp_path}/bad")
    from riskweave.operators.quality import require_passed
    from riskweave.plans.warehouse import Warehouse

    tables = read_sources(spark, sources, {"merchants": f"{tmp_path}/bad"})
    with pytest.raises(QualityError, match="MerchantRiskScore between"):
        require_passed(jobs.check_warehouse(Warehouse(tables, RUN_TS, AS_OF)))


def test_published_layers(spark, warehouse):
    try:
        jobs.publish_layers(spark, warehouse)
        n = warehouse.sources["customers"].count()
        assert spark.table("dwh.dim_customer").count() == n > 1000
        assert spark.table("staging.stg_customer").count() == n
        assert spark.table("raw_customer").count() == n
    finally:
        for database in jobs.TABLES:
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_command_line(spark, root, warehouse, capsys):
    command.main(["--run-ts", RUN_TS, "score", f"{root}/marts", f"{root}/cli_alerts"])
    command.main(["report", f"{root}/cli_alerts", "--top", "3"])
    assert "total_risk_score" in capsys.readouterr().out


def test_a_stale_source_stops_the_load(spark, tmp_path):
    sources = f"{tmp_path}/sources"
    for name, df in provided_sources(spark, f"{DATA}/sf0.001").items():
        write_source(df.na.drop(), sources, name)
    tables = read_sources(spark, sources)
    assert file_load_skew(tables, 3600).first().failing_rows == 0
    day_before = time.time() - 86_400
    for file in Path(sources, "merchants").rglob("*.parquet"):
        os.utime(file, (day_before, day_before))
    found = file_load_skew(read_sources(spark, sources), 3600).first()
    assert found.failing_rows == 1 and 86_000 < found.skew_seconds < 90_000
    with pytest.raises(QualityError, match="apart"):
        jobs.build_marts(spark, sources, f"{tmp_path}/marts", RUN_TS, AS_OF, most_skew=3600)
    jobs.build_marts(spark, sources, f"{tmp_path}/marts", RUN_TS, AS_OF, most_skew=100_000)
    assert load_marts(spark, f"{tmp_path}/marts")[0].count() > 0
    # Nothing but the file's time is read.
    plan = file_load_skew(tables)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def _copy_of(spark, root, to, **changed):
    for name, df in read_sources(spark, f"{root}/sources").items():
        write_source(changed.get(name, lambda d: d)(df), f"{to}/sources", name)


def test_readers_keep_the_old_marts_where_the_gate_stops_a_load(spark, root, tmp_path):
    marts = f"{tmp_path}/marts"
    jobs.build_marts(spark, f"{root}/sources", marts, RUN_TS, AS_OF, gate=True)
    before = [df.count() for df in load_marts(spark, marts)]

    def negative(df):
        return df.withColumn("TransactionAmount", F.expr("if(TransactionID % 5 = 0, -1, TransactionAmount)"))

    _copy_of(spark, root, tmp_path, transactions=negative)
    with pytest.raises(QualityError, match="raw_transaction.TransactionAmount between"):
        jobs.build_marts(spark, f"{tmp_path}/sources", marts, RUN_TS, AS_OF, gate=True)
    after = load_marts(spark, marts)
    assert [df.count() for df in after] == before
    assert after[0].where("transaction_amount < 0").count() == 0


@pytest.mark.parametrize(
    "table, change, message",
    [
        ("login_attempts", "if(CustomerID % 50 = 0, null, Success) AS Success", "raw_login_attempt.Success not_null"),
        ("merchants", "'one' AS Category", "raw_merchant.Category not_constant"),
        ("customers", "if(CustomerID % 50 = 0, 120, Age) AS Age", "raw_customer.Age between"),
        ("customers", "CustomerID div 2 AS CustomerID", "dim_customer.customer_id unique"),
    ],
)
def test_gate_finds_what_is_wrong_with_each_source(spark, root, tmp_path, table, change, message):
    name = change.split()[-1]

    def wrong(df):
        kind = df.schema[name].dataType
        return df.withColumn(name, F.expr(change.rsplit(" AS ", 1)[0]).cast(kind))

    _copy_of(spark, root, tmp_path, **{table: wrong})
    with pytest.raises(QualityError, match=message):
        jobs.build_marts(spark, f"{tmp_path}/sources", f"{tmp_path}/marts", RUN_TS, AS_OF, gate=True)


def test_gate_passes_empty_sources(spark, root, tmp_path):
    for name, df in read_sources(spark, f"{root}/sources").items():
        df.where("false").coalesce(1).write.parquet(f"{tmp_path}/sources/{name}")
    jobs.build_marts(spark, f"{tmp_path}/sources", f"{tmp_path}/marts", RUN_TS, AS_OF, gate=True)
    assert [df.count() for df in load_marts(spark, f"{tmp_path}/marts")] == [0, 0]


def test_checks_before_the_load_read_keys_only(spark, root):
    keys = [c for c in CHECKS if c.kind in (UNIQUE, UNIQUE_COMBO) and c.model.startswith("raw_")]
    w = Warehouse(read_sources(spark, f"{root}/sources"), RUN_TS, AS_OF)
    results = run_checks({m: getattr(w, v) for m, v in jobs.LANDING_VIEWS.items()}, keys)
    read = set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<(.*)>", plan(results)))))
    assert read == {"CustomerID", "TransactionID", "LoginTimestamp"}


def test_a_sibling_session_has_the_settings_as_they_are(spark):
    beside = sibling(spark)
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        assert beside.conf.get(key) == spark.conf.get(key)
    assert beside.sparkContext is spark.sparkContext


def test_watched_checks_count_rows_on_the_way(spark, tmp_path):
    spark = sibling(spark)
    checks = [Check("m", "not_null", ("a",)), Check("m", "between", ("a",), 0, 10)]
    df = spark.createDataFrame([(1,), (11,), (None,), (12,)], "a bigint").repartition(3)
    observed = ObservedChecks()
    observed.watch(df, checks).write.parquet(f"{tmp_path}/out")
    assert observed.found() == {checks[0]: 1, checks[1]: 2}
    with pytest.raises(QualityError, match="2 quality checks failed"):
        observed.require_passed({"m": df})
    # No metrics for what is proved empty: the checks are run instead.
    observed = ObservedChecks()
    observed.watch(df.limit(0), checks).join(df, "a").write.parquet(f"{tmp_path}/none")
    observed.require_passed({"m": df.limit(0)})
