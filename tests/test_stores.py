from __future__ import annotations

import os
from datetime import datetime

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from riskweave import session
from riskweave.operators import alerts as A
from riskweave.operators.layers import run_timestamp
from riskweave.schemas import ALERTS, ALERTS_TABLE, SOURCES
from riskweave.session import materialize, shared_root
from riskweave.sources import alerts_store as S
from riskweave.sources import tables
from riskweave.sources.objectstore import object_store_settings, with_object_store
from tests.conftest import at, rows

def now():
    return run_timestamp("2024-02-01 00:00:00")


@pytest.fixture
def alerts(spark):
    data = [
        ("1", "7", at("01 00:00"), 5, "A"),
        ("2", "7", at("02 00:00"), 6, "A,B"),
        ("3", "8", at("03 00:00"), 11, "C"),
    ]
    return spark.createDataFrame(data, ALERTS)


def test_written_alerts_come_back(spark, alerts, tmp_path):
    path = str(tmp_path / "alerts")
    S.write_alerts(alerts, path)
    assert rows(S.read_alerts(spark, path)) == rows(alerts)
    S.write_alerts(alerts.where("false"), path)
    assert S.read_alerts(spark, path).schema == ALERTS
    assert S.read_alerts(spark, path).count() == 0


def test_append_keeps_every_run(spark, alerts, tmp_path):
    path = str(tmp_path / "alerts")
    for _ in range(2):
        S.append_alerts(alerts, path, now())
    stored = S.read_alerts_folder(spark, path)
    assert stored.schema == ALERTS_TABLE
    assert stored.count() == 6
    assert stored.select("id").distinct().count() == 3  # a hash of key and moment
    assert {r[0] for r in stored.select("inserted_at").collect()} == {datetime(2024, 2, 1)}


def test_idempotent_append(spark, alerts, tmp_path):
    path = str(tmp_path / "alerts")
    S.append_alerts(alerts.where("transaction_id = '2'"), path, now(), only_new=True)
    for _ in range(2):
        S.append_alerts(alerts, path, now(), only_new=True)
    stored = S.read_alerts_folder(spark, path)
    assert rows(stored.drop("id", "inserted_at")) == rows(alerts)
    assert stored.select("id").distinct().count() == 3


def test_one_alert_for_each_transaction_and_kind(spark, alerts, tmp_path):
    """Repeats within a run go, and a model's alert is not a rule's."""
    path = str(tmp_path / "alerts")
    by_model = alerts.where("transaction_id < '3'").selectExpr(
        "* EXCEPT (risk_score, flags)", "1 AS risk_score", "'ML_MODEL' AS flags"
    )
    lower = alerts.selectExpr("* EXCEPT (risk_score)", "risk_score - 1 AS risk_score")
    for _ in range(2):
        S.append_alerts(alerts.unionByName(lower).unionByName(alerts), path, now(), only_new=True)
        S.append_alerts(by_model.unionByName(by_model), path, now(), only_new=True)
    stored = S.read_alerts_folder(spark, path)
    assert rows(stored.drop("id", "inserted_at")) == rows(alerts.unionByName(by_model))
    assert stored.select("id").distinct().count() == 5


def test_append_to_a_catalog_table(spark, alerts, tmp_path):
    spark.sql(f"CREATE DATABASE alerts_db LOCATION '{tmp_path}/db'")
    try:
        for _ in range(2):
            S.append_alerts_table(alerts, "alerts_db.fraud_alerts", now(), only_new=True)
        S.append_alerts_table(alerts.limit(1), "alerts_db.fraud_alerts", now())
        assert spark.table("alerts_db.fraud_alerts").count() == 4
    finally:
        spark.sql("DROP DATABASE alerts_db CASCADE")


def test_alert_builders(spark):
    scored = spark.createDataFrame(
        [(1, 7, at("01 00:00"), 6, "X", 1, 0.0), (2, 8, at("01 00:00"), 2, "", 0, 1.0)],
        "transaction_id bigint, customer_id bigint, transaction_timestamp timestamp_ntz,"
        " risk_score int, flags string, label int, prediction double",
    )
    by_rule, by_model = A.rule_alerts(scored), A.model_alerts(scored)
    assert rows(by_rule) == [("1", "7", at("01 00:00"), 6, "X")]
    assert rows(by_model) == [("2", "8", at("01 00:00"), 1, "ML_MODEL")]
    assert [f.dataType for f in by_model.schema] == [f.dataType for f in ALERTS]


def test_top_customers_break_ties_by_id(spark, alerts):
    assert [tuple(r) for r in A.top_risky_customers(alerts, 2).collect()] == [("7", 11), ("8", 11)]
    assert [tuple(r) for r in A.top_risky_customers(alerts, 1).collect()] == [("7", 11)]


def test_notifications(spark, alerts):
    assert A.notification_feed(alerts).count() == 3
    assert rows(A.customers_to_notify(alerts)) == [
        ("7", "Sending email to customer 7..."),
        ("8", "Sending email to customer 8..."),
    ]


def login_rows(spark, months=(1, 2, 3), per_month=10):
    data = [
        (c, datetime(2024, m, 1 + c), False, datetime(2024, m, 1))
        for m in months
        for c in range(per_month)
    ]
    return spark.createDataFrame(
        data,
        "CustomerID bigint, LoginTimestamp timestamp_ntz, Success boolean,"
        " ingestion_date timestamp_ntz",
    )


def test_only_written_partitions_are_replaced(spark, tmp_path):
    root = str(tmp_path)
    tables.write_source(login_rows(spark), root, "login_attempts")
    tables.write_source(login_rows(spark, (2,), 4), root, "login_attempts")
    back = tables.read_source(spark, root, "login_attempts")
    assert back.schema == SOURCES["login_attempts"]
    got = rows(back.groupBy("LoginTimestampMonth").count())
    assert got == [(1, 10), (2, 4), (3, 10)]


def test_partition_filter_prunes_directories(spark, tmp_path):
    root = str(tmp_path)
    tables.write_source(login_rows(spark), root, "login_attempts")
    back = tables.read_source(spark, root, "login_attempts").where("LoginTimestampMonth = 2")
    assert len(back.select(F.input_file_name().alias("f")).distinct().collect()) == 1


def test_a_large_partition_becomes_several_files(spark, tmp_path):
    """All logins fall into one month, yet no single task writes them."""
    month = spark.range(60_000).select(
        F.col("id").alias("CustomerID"),
        F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .alias("LoginTimestamp"),
        (F.col("id") % 3 == 0).alias("Success"),
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        tables.write_source(month, str(tmp_path), "login_attempts")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    back = tables.read_source(spark, str(tmp_path), "login_attempts")
    assert back.count() == 60_000
    assert back.select("LoginTimestampMonth").distinct().count() == 1
    assert back.select(F.input_file_name()).distinct().count() >= 3


def test_each_merchant_load_is_a_partition_of_its_own(spark, tmp_path):
    root = str(tmp_path)
    merchants = spark.createDataFrame(
        [(1, "a", "Retail", 0.2)], SOURCES["merchants"].names[:4]
    )
    for day in ("01", "02"):
        load = merchants.withColumn("ingestion_date", run_timestamp(f"2024-01-{day} 00:00:00"))
        tables.write_source(load, root, "merchants")
    got = rows(tables.read_source(spark, root, "merchants"), "MerchantID", "ingestion_date")
    assert got == [(1, datetime(2024, 1, 1)), (1, datetime(2024, 1, 2))]


def test_unknown_tables_are_written_unpartitioned(spark, tmp_path):
    path = tables.write_source(spark.range(3).toDF("x"), str(tmp_path), "extra")
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]


def test_nanosecond_files(spark, tmp_path):
    path = str(tmp_path / "logins.parquet")
    frame = pd.DataFrame(
        {
            "CustomerID": [1],
            "LoginTimestamp": pd.to_datetime(["2024-01-05 01:02:03.123456789"]),
            "Success": [False],
        }
    )
    schema = pa.schema(
        [("CustomerID", pa.int64()), ("LoginTimestamp", pa.timestamp("ns")), ("Success", pa.bool_())]
    )
    pq.write_table(pa.Table.from_pandas(frame, schema), path)
    got = rows(tables.read_nanosecond_source(spark, path, "login_attempts"))
    assert got == [(1, datetime(2024, 1, 5, 1, 2, 3, 123456), False)]


def test_paths_of_single_tables_can_be_given(spark, tmp_path):
    root = str(tmp_path / "root")
    elsewhere = str(tmp_path / "other")
    for name in SOURCES:
        tables.write_source(spark.createDataFrame([], SOURCES[name]), root, name)
    tables.write_source(login_rows(spark), elsewhere, "login_attempts")
    read = tables.read_sources(spark, root, {"login_attempts": f"{elsewhere}/login_attempts"})
    assert rows(tables.row_counts(read)) == [
        ("customers", 0),
        ("login_attempts", 30),
        ("merchants", 0),
        ("transactions", 0),
    ]


def test_object_store_settings():
    settings = object_store_settings("store:9000", "key", "secret")
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "store:9000"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    builder = with_object_store(
        SparkSession.Builder(), endpoint="e", access_key="a", secret_key="s"
    )
    assert isinstance(builder, SparkSession.Builder)


def test_scratch_is_deleted_on_request(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch_folders", [])
    once = materialize(spark.range(10), "numbers")
    assert once.count() == 10 and len(session._scratch_folders) == 1
    folder = session._scratch_folders[0]
    session.delete_scratch(spark)
    assert not os.path.exists(folder) and session._scratch_folders == []


def test_materialized_rows_do_not_change(spark):
    once = materialize(spark.range(100).select(F.rand().alias("r")), "random")
    assert rows(once) == rows(once)


class Session:
    """What shared_root asks a session for."""

    def __init__(self, named=None, on_context=None, master="spark://host:7077"):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master = master
        self.on_context = on_context

    def getCheckpointDir(self):
        return self.on_context


def test_shared_root_is_the_one_the_cluster_names():
    assert shared_root(Session("s3a://shared/ckpt/", "hdfs:///other")) == "s3a://shared/ckpt"
    assert shared_root(Session(None, "hdfs:///other")) == "hdfs:///other"
    with pytest.raises(RuntimeError):
        shared_root(Session())
    assert shared_root(Session(master="local[4]"))


def many(spark, first, n, month):
    data = [(str(i), "7", datetime(2024, month, 1 + i % 28), 5, "A") for i in range(first, first + n)]
    return spark.createDataFrame(data, ALERTS)


def test_appends_open_only_files_that_may_hold_a_key(spark, tmp_path):
    """A store of a hundred appends over four months; a replay opens its own."""
    path = str(tmp_path / "alerts")
    for i in range(100):
        S.append_alerts(many(spark, 10 * i, 10, 1 + i % 4), path, now())
    folders = [p for p in (tmp_path / "alerts").glob("month=*/append=*")]
    assert len(folders) == 100
    opened = S.stored_like(many(spark, 570, 10, 1 + 57 % 4), path).inputFiles()
    assert len({os.path.dirname(f) for f in opened}) <= 2
    assert S.stored_like(many(spark, 5000, 10, 2), path).count() <= 10  # false hits at most
    assert S.stored_like(many(spark, 5000, 10, 9), path).inputFiles() == []
    S.append_alerts(many(spark, 565, 10, 1 + 57 % 4).unionByName(many(spark, 570, 5, 1 + 57 % 4)), path, now(), only_new=True)
    assert S.read_alerts_folder(spark, path).count() == 1005  # five new: 565 to 569 lie in another month


def test_filters_hold_all_their_keys(spark, tmp_path):
    path = str(tmp_path / "alerts")
    alerts = many(spark, 0, 3000, 5)
    S.append_alerts(alerts, path, now())
    for part in (alerts.where("transaction_id < '2'"), alerts.where("transaction_id = '2999'")):
        assert S.stored_like(part, path).count() == 3000
    hits = sum(S.stored_like(many(spark, 10_000 + i, 1, 5), path).count() > 0 for i in range(20))
    assert hits <= 2


def test_an_append_without_a_filter_and_files_without_months_are_looked_into(spark, alerts, tmp_path):
    import shutil

    path = tmp_path / "alerts"
    S.append_alerts(alerts.where("transaction_id = '1'"), str(path), now())
    shutil.rmtree(path / S.FILTERS)
    flat = S.table_rows(alerts.where("transaction_id = '2'"), now())
    flat.write.mode("append").parquet(str(path))
    S.append_alerts(alerts, str(path), now(), only_new=True)
    assert rows(S.read_alerts_folder(spark, str(path)).drop("id", "inserted_at")) == rows(alerts)


def test_alerts_without_a_time_are_found_again(spark, tmp_path):
    path = str(tmp_path / "alerts")
    timeless = spark.createDataFrame([("1", "7", None, 5, "A"), (None, None, None, None, None)], ALERTS)
    for _ in range(2):
        S.append_alerts(timeless.where("transaction_id IS NOT NULL"), path, now(), only_new=True)
    assert S.read_alerts_folder(spark, path).count() == 1
    S.append_alerts(timeless.where("false"), path, now(), only_new=True)
    assert S.read_alerts_folder(spark, path).count() == 1


def mart_rows(spark, n):
    empty = spark.createDataFrame([], tables.MARTS["v_login_attempt"])
    filled = spark.createDataFrame([(i,) for i in range(n)], "customer_id bigint")
    return empty.unionByName(filled, allowMissingColumns=True)


def failing(df):
    """The same rows, but computing them fails after some were written."""
    return df.withColumn("customer_id", F.expr("if(customer_id = 3, cast(raise_error('lost') as bigint), customer_id)"))


def test_readers_keep_the_old_mart_during_and_after_a_failed_write(spark, tmp_path):
    root = str(tmp_path)
    marts = {"v_transaction": spark.createDataFrame([], tables.MARTS["v_transaction"]), "v_login_attempt": mart_rows(spark, 3)}
    assert tables.publish_marts(spark, marts, root) == 0
    before = tables.load_marts(spark, root)[1]
    assert before.count() == 3
    with pytest.raises(Exception, match="lost"):
        tables.publish_marts(spark, {**marts, "v_login_attempt": failing(mart_rows(spark, 5))}, root)
    assert tables.load_marts(spark, root)[1].count() == 3 and before.count() == 3
    assert tables.publish_marts(spark, {**marts, "v_login_attempt": mart_rows(spark, 5)}, root) == 1
    # A reader that had begun on the version before finishes; a new one sees the new version.
    assert before.count() == 3 and tables.load_marts(spark, root)[1].count() == 5
    tables.publish_marts(spark, {**marts, "v_login_attempt": mart_rows(spark, 6)}, root)
    assert sorted(p.name for p in (tmp_path / tables.TOGETHER).iterdir()) == ["_versions", "version=1", "version=2"]


def test_a_mart_published_alone_keeps_its_last_version_when_a_write_fails(spark, tmp_path):
    root = str(tmp_path)
    tables.write_mart(spark.createDataFrame([], tables.MARTS["v_transaction"]), root, "v_transaction")
    tables.write_mart(mart_rows(spark, 2), root, "v_login_attempt")
    with pytest.raises(Exception, match="lost"):
        tables.write_mart(failing(mart_rows(spark, 5)), root, "v_login_attempt")
    assert tables.load_marts(spark, root)[1].count() == 2
    tables.write_mart(mart_rows(spark, 4), root, "v_login_attempt")
    assert tables.load_marts(spark, root)[1].count() == 4
