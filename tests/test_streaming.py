from __future__ import annotations

import random
import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskweave.operators import login_context as C
from riskweave.operators.alerts import one_per_key, rule_alerts
from riskweave.operators.features import failed_logins
from riskweave.operators.layers import run_timestamp, stage_login_attempts, stage_transactions
from riskweave.operators.layers import land_login_attempts, land_transactions
from riskweave.plans.training import score_transactions, train_refined, training_set
from riskweave.plans.warehouse import Warehouse
from riskweave.queries import AS_OF, QUERIES, RUN_TS
from riskweave.schemas import SOURCES
from riskweave.sources.alerts_store import read_alerts_folder
from riskweave.sources.provided import provided_sources
from riskweave.sources.tables import conform, read_sources, write_source
from riskweave.streaming import incremental as I
from riskweave.streaming import lookback as L
from tests.conftest import DATA, rows


@pytest.fixture(scope="module")
def sources(spark):
    return provided_sources(spark, f"{DATA}/sf0.001")


@pytest.fixture(scope="module")
def warehouse(sources):
    return Warehouse(sources, RUN_TS, AS_OF)


def land(sources, name, path, files):
    """A source table as ``files`` files in random order."""
    df = conform(name, sources[name])
    df.repartition(files, F.rand(3)).write.parquet(path)
    return path


def run(spark, landed, scorer, alerts, checkpoint):
    stream = I.transaction_stream(spark, landed, files_per_batch=1)
    now = run_timestamp(RUN_TS)
    query = I.start_incremental_alerts(stream, scorer, alerts, checkpoint, now)
    query.awaitTermination()
    return len(query.recentProgress)


def test_batches_add_up_and_replays_add_nothing(spark, sources, warehouse, tmp_path):
    landed = land(sources, "transactions", f"{tmp_path}/tx", 3)
    scorer = I.rule_scorer(lambda: sources, RUN_TS, AS_OF)
    want = rows(rule_alerts(warehouse.scored_transactions))
    alerts = f"{tmp_path}/alerts"

    def stored():
        return rows(read_alerts_folder(spark, alerts).drop("id", "inserted_at"))

    assert run(spark, landed, scorer, alerts, f"{tmp_path}/c1") >= 3
    assert stored() == want and len(want) == 42
    run(spark, landed, scorer, alerts, f"{tmp_path}/c1")  # nothing new has landed
    assert stored() == want
    run(spark, landed, scorer, alerts, f"{tmp_path}/c2")  # everything again
    assert stored() == want


def test_later_files_are_picked_up(spark, sources, warehouse, tmp_path):
    landed, alerts, checkpoint = (f"{tmp_path}/{n}" for n in ("tx", "alerts", "c"))
    halves = conform("transactions", sources["transactions"])
    scorer = I.rule_scorer(lambda: sources, RUN_TS, AS_OF)
    halves.where("TransactionID < 500").coalesce(1).write.parquet(landed)
    run(spark, landed, scorer, alerts, checkpoint)
    first = read_alerts_folder(spark, alerts).count()
    halves.where("TransactionID >= 500").coalesce(1).write.mode("append").parquet(landed)
    run(spark, landed, scorer, alerts, checkpoint)
    want = rows(rule_alerts(warehouse.scored_transactions), "transaction_id")
    assert 0 < first < len(want)
    assert rows(read_alerts_folder(spark, alerts), "transaction_id") == want


def test_nothing_landed_yet(spark, sources, tmp_path):
    landed = f"{tmp_path}/tx"
    conform("transactions", sources["transactions"]).where("false").write.parquet(landed)
    run(spark, landed, I.rule_scorer(lambda: sources, RUN_TS, AS_OF), f"{tmp_path}/alerts", f"{tmp_path}/c")
    assert read_alerts_folder(spark, f"{tmp_path}/alerts").count() == 0


def test_model_scoring_of_batches(spark, sources, warehouse, tmp_path):
    forest = train_refined(training_set(warehouse.scored_transactions), trees=10)
    landed = land(sources, "transactions", f"{tmp_path}/tx", 2)
    alerts = f"{tmp_path}/alerts"
    run(spark, landed, I.model_scorer(lambda: sources, forest, RUN_TS, AS_OF), alerts, f"{tmp_path}/c")
    want = rows(score_transactions(warehouse.enriched_transactions, forest))
    assert rows(read_alerts_folder(spark, alerts).drop("id", "inserted_at")) == want


def streamed_counts(spark, sources, tmp_path, delay="40 days"):
    now = run_timestamp(RUN_TS)
    streams = {}
    for name in ("transactions", "login_attempts"):
        path = land(sources, name, f"{tmp_path}/{name}", 4)
        reader = spark.readStream.schema(SOURCES[name]).option("maxFilesPerTrigger", 1)
        streams[name] = reader.parquet(path)
    out = f"{tmp_path}/counts"
    query = L.start_failed_login_counts(
        stage_transactions(land_transactions(streams["transactions"], now)),
        stage_login_attempts(land_login_attempts(streams["login_attempts"])),
        out,
        f"{tmp_path}/c",
        delay,
    )
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    return rows(
        L.read_failed_login_counts(spark, out), "transaction_id", "customer_id", "failed_logins_24h"
    )


def test_streamed_counts_equal_the_batch(spark, sources, warehouse, tmp_path):
    """Files in random order: most logins arrive after transactions they count for."""
    batch = failed_logins(warehouse.stg_transaction, warehouse.fact_login_attempt)
    want = rows(batch, "transaction_id", "customer_id", "failed_logins_24h")
    assert streamed_counts(spark, sources, tmp_path) == want


HOUR = timedelta(hours=1)
START = datetime(2024, 1, 1)


def batches_of_events(seed, steps):
    """Event time moves two hours per batch; events lie up to fourteen hours back."""
    rng = random.Random(seed)
    out, n = [], 0
    for step in range(steps):
        now = START + 2 * step * HOUR
        batch = []
        for _ in range(rng.randrange(1, 9)):
            at = now - timedelta(seconds=rng.randrange(14 * 3600))
            is_tx = rng.random() < 0.4
            batch.append((rng.choice([7, 8]), at, n if is_tx else None, is_tx))
            n += is_tx
        out.append(batch)
    return out


@pytest.mark.parametrize("replay", [False, True])
def test_late_events_are_left_out_and_state_is_dropped(spark, tmp_path, replay):
    handle = L._batch_handler(str(tmp_path), "6 hours", 24)
    seen, transactions, logins, late = None, [], [], 0
    for i, batch in enumerate(batches_of_events(5, 12)):
        frame = spark.createDataFrame(batch, L._EVENT)
        handle(frame, i)
        if replay:
            handle(frame, i)
        for customer, at, tx, is_tx in batch:
            if seen is not None and at < seen - 6 * HOUR:
                late += 1
            elif is_tx:
                transactions.append((tx, customer, at))
            else:
                logins.append((customer, at))
        seen = max(e[1] for e in batch) if seen is None else max(seen, *(e[1] for e in batch))
        for row in L.read_state(spark, str(tmp_path), i).collect():
            assert row.at >= seen - 6 * HOUR - (0 if row.is_tx else 24) * HOUR
    want = [(tx, c, sum(c == d and at - 24 * HOUR <= x <= at for d, x in logins)) for tx, c, at in transactions]
    got = rows(L.read_failed_login_counts(spark, str(tmp_path)), "transaction_id", "customer_id", "failed_logins_24h")
    assert got == sorted(want, key=repr) and late > 0


@pytest.mark.parametrize("batches", [1, 7, 8, 9, 63, 64, 65, 100, 600])
def test_segments_cover_all_batches_once(batches):
    covered = [i for first, size in L.segments(batches) for i in range(first, first + size)]
    assert covered == list(range(batches)) and len(L.segments(batches)) <= 7 * 4


def test_folders_stay_few_over_many_batches(spark, tmp_path):
    """Every batch is repeated; counts are right all the while."""
    handle = L._batch_handler(str(tmp_path), "1 hour", 2)
    for i in range(20):
        at = START + i * HOUR
        rows_ = [(1, at, i, True), (1, at, None, False), (1, at, None, False), (2, at, 100 + i, True)]
        frame = spark.createDataFrame(rows_, L._EVENT)
        for _ in range(2):
            handle(frame, i)
        assert len(list(tmp_path.iterdir())) <= 2 * L.MERGED + 3
    got = {r.transaction_id: r.failed_logins_24h for r in L.read_failed_login_counts(spark, str(tmp_path)).collect()}
    assert got == {i: 2 * min(i + 1, 3) for i in range(20)} | {100 + i: 0 for i in range(20)}


@pytest.mark.parametrize("hot", [False, True])
def test_gains_of_new_and_earlier_transactions(spark, hot):
    rng = random.Random(11)
    events = []
    for i in range(300):
        at = None if i % 50 == 7 else START + timedelta(minutes=rng.randrange(6000))
        is_tx = rng.random() < 0.5
        events.append((rng.choice([1, 2, None]), at, i if is_tx else None, is_tx, rng.randrange(1, 4), rng.random() < 0.5))
    timeline = spark.createDataFrame(events, f"{L.STATE}, is_new boolean")
    counted = C._gained_by_segments(timeline, 24, 5) if hot else C._gained_by_window(timeline, 24)
    got = {r.transaction_id: r.n for r in counted.where("is_tx").collect()}
    for customer, at, tx, is_tx, n, is_new in events:
        if is_tx:
            logins = [
                e[4]
                for e in events
                if not e[3] and None not in (at, e[1], customer) and e[0] == customer and (is_new or e[5])
                and at - 24 * HOUR <= e[1] <= at
            ]
            assert got[tx] == n + sum(logins)


def test_history_that_lands_between_batches_counts(spark, sources, warehouse, tmp_path):
    """The loader reads the tables anew for every batch."""
    landed, alerts, checkpoint = (f"{tmp_path}/{n}" for n in ("tx", "alerts", "c"))
    root = f"{tmp_path}/sources"
    for name, df in sources.items():
        write_source(df.where("false") if name == "login_attempts" else df, root, name)
    stream = conform("transactions", sources["transactions"])
    scorer = I.rule_scorer(lambda: read_sources(spark, root), RUN_TS, AS_OF)
    stream.where("TransactionID < 500").coalesce(1).write.parquet(landed)
    run(spark, landed, scorer, alerts, checkpoint)
    write_source(sources["login_attempts"], root, "login_attempts")
    stream.where("TransactionID >= 500").coalesce(1).write.mode("append").parquet(landed)
    run(spark, landed, scorer, alerts, checkpoint)  # the same scorer
    want = rows(rule_alerts(warehouse.scored_transactions).where("transaction_id >= 500"))
    stored = read_alerts_folder(spark, alerts).drop("id", "inserted_at")
    assert rows(stored.where("transaction_id >= 500")) == want and want


def test_incremental_scores_equal_the_batch_under_fan_out(spark, sources, tmp_path):
    """Half of the merchants have several snapshots: their amounts count repeatedly in both."""
    merchants = sources["merchants"]
    extra = merchants.where("MerchantID % 2 = 0")
    sources = {**sources, "merchants": merchants.unionByName(extra).unionByName(extra)}
    landed = land(sources, "transactions", f"{tmp_path}/tx", 2)
    alerts = f"{tmp_path}/alerts"
    run(spark, landed, I.rule_scorer(lambda: sources, RUN_TS, AS_OF), alerts, f"{tmp_path}/c")
    batch = one_per_key(rule_alerts(Warehouse(sources, RUN_TS, AS_OF).scored_transactions))
    assert rows(read_alerts_folder(spark, alerts).drop("id", "inserted_at")) == rows(batch)


@pytest.mark.parametrize("kept", ["true", "false"])
def test_null_times_and_an_empty_table_reach_the_failed_login_stream(spark, tmp_path, kept):
    (tmp_path / "in").mkdir()
    for source in Path(DATA, "sf0.001").iterdir():
        if source.name != "events.parquet":
            shutil.copyfile(source, tmp_path / "in" / source.name)
    events = spark.read.parquet(f"{DATA}/sf0.001/events.parquet").where(kept)
    gone = F.when(F.col("event_id") % 10 != 3, F.col("ts"))
    events.withColumn("ts", gone).write.parquet(f"{tmp_path}/in/events.parquet")
    found = rows(QUERIES["stream_failed_logins"](spark, f"{tmp_path}/in"))
    purchases = spark.read.parquet(f"{tmp_path}/in/events.parquet").where("event_type = 'purchase'")
    assert sorted(r[0] for r in found) == sorted(r.event_id for r in purchases.collect())
