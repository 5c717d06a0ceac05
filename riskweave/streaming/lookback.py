"""Failed logins before each transaction, on two unbounded streams.

A stream-stream join would emit every pair of transaction and failed login, which
is quadratic for a busy customer. Here both streams are one, and each micro-batch
counts on one time line: its own transactions see all retained and new failed
logins, the retained transactions only the new ones. Both are running sums of
the same pass. Hot customers take the range-partitioned form.

Events may arrive in any order within ``delay`` of the latest event seen before
their batch; later ones are left out. A transaction is open for the delay, and
the count it has so far grows with logins that arrive meanwhile; after that it
is closed. What a batch writes is one folder: open transactions with their
counts and the failed logins that still matter, counted by instant, are the
state; the transactions it closes are a segment. Segments are merged eight at a
time, so their number is logarithmic in the number of batches, and only the
states of the last two batches are kept. A repeated batch finds what it read
the first time and writes equal folders.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators.login_context import LOOKBACK_HOURS, running_counts
from riskweave.operators.skew import GROUP_LIMIT
from riskweave.sources.versions import Versions, drop_folders

_EVENT = "customer_id bigint, at timestamp_ntz, transaction_id bigint, is_tx boolean"
# The state: open transactions with their count, failed logins with their number.
STATE = f"{_EVENT}, n bigint"
_SEGMENT = "transaction_id bigint, customer_id bigint, n bigint"
COUNTS = "transaction_id bigint, customer_id bigint, failed_logins_24h bigint"

# Segments that are merged into one.
MERGED = 8


def _events(transactions: DataFrame, logins: DataFrame) -> DataFrame:
    """Transactions and failed logins as one stream."""
    tx = transactions.select(
        "customer_id",
        F.col("transaction_timestamp").alias("at"),
        "transaction_id",
        F.lit(True).alias("is_tx"),
    )
    failed = logins.where("is_success = false AND customer_id IS NOT NULL").select(
        "customer_id",
        F.col("login_timestamp").alias("at"),
        F.lit(None).cast("bigint").alias("transaction_id"),
        F.lit(False).alias("is_tx"),
    )
    return tx.unionByName(failed)


def segments(batches: int) -> list[tuple[int, int]]:
    """(first batch, length) of the segments that hold what so many batches closed."""
    out, at, size = [], 0, 1
    while size * MERGED <= batches:
        size *= MERGED
    while size:
        while at + size <= batches:
            out.append((at, size))
            at += size
        size //= MERGED
    return out


def _segment(path: str, first: int, size: int) -> str:
    """Batches close their transactions in their own folder; merged ones lie apart."""
    return f"{path}/batch={first}/open=false" if size == 1 else f"{path}/segment={first}-{size}"


def read_state(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """What a batch retained; nothing before the first."""
    folder = f"{path}/batch={batch_id}/open=true"
    if batch_id < 0 or not Versions(spark, path).files.exists(folder):
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(folder)


def _read_segments(spark: SparkSession, path: str, parts: list[tuple[int, int]]) -> DataFrame:
    files = Versions(spark, path).files
    folders = [f for f in (_segment(path, *part) for part in parts) if files.exists(f)]
    return spark.read.schema(_SEGMENT).parquet(*folders) if folders else spark.createDataFrame([], _SEGMENT)


def _batch_handler(path: str, delay: str, hours: int) -> Callable[[DataFrame, int], None]:
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = Versions(spark, path)
        before = versions.manifest(batch_id - 1) if batch_id - 1 in versions.declared() else {"latest": None, "rows": 0}
        seen = before["latest"] and datetime.fromisoformat(before["latest"])
        state = read_state(spark, path, batch_id - 1)
        batch.persist()
        try:
            new = batch
            if seen is not None:
                new = batch.where(F.col("at").isNull() | (F.col("at") >= F.lit(seen) - F.expr(f"INTERVAL {delay}")))
            rows, latest = new.agg(F.count("*"), F.max("at")).first()
            latest = max((x for x in (seen, latest) if x is not None), default=None)

            # Failed logins of one instant are one row; a transaction is one as it is.
            instants = new.where("NOT is_tx AND at IS NOT NULL").groupBy("customer_id", "at").agg(F.count("*").alias("n"))
            arrived = instants.select("customer_id", "at", F.lit(None).cast("bigint").alias("transaction_id"), F.lit(False).alias("is_tx"), "n")
            arrived = arrived.unionByName(new.where("is_tx").withColumn("n", F.lit(0).cast("bigint")))
            timeline = state.withColumn("is_new", F.lit(False)).unionByName(arrived.withColumn("is_new", F.lit(True)))

            # No customer can be hot where all rows together are few.
            few = before["rows"] + rows <= GROUP_LIMIT
            counted = running_counts(timeline, hours, measure=not few)
            is_tx, at = F.col("is_tx"), F.col("at")
            open_ = at.isNotNull() & (F.lit(None).cast("boolean") if latest is None else _matters(is_tx, at, latest, delay, hours))
            counted = counted.withColumn("open", F.coalesce(open_, F.lit(False))).where("is_tx OR open")
            target = f"{path}/batch={batch_id}"
            counted.select(*spark.createDataFrame([], STATE).columns, "open").write.mode("overwrite").partitionBy("open").parquet(target)
        finally:
            batch.unpersist()
        size = MERGED
        while (batch_id + 1) % size == 0:
            first, part = batch_id + 1 - size, size // MERGED
            whole = _read_segments(spark, path, [(first + i * part, part) for i in range(MERGED)])
            whole.write.mode("overwrite").parquet(_segment(path, first, size))
            size *= MERGED
        kept = read_state(spark, path, batch_id).count()
        versions.declare(batch_id, {"latest": latest and latest.isoformat(), "rows": kept})
        _clean(versions, path, batch_id)

    return handle


def _matters(is_tx, at, latest: datetime, delay: str, hours: int):
    """Whether a later event can still change or need this one."""
    watermark = F.lit(latest) - F.expr(f"INTERVAL {delay}")
    return at >= F.when(is_tx, watermark).otherwise(watermark - F.expr(f"INTERVAL {hours} HOURS"))


def _clean(versions: Versions, path: str, batch_id: int) -> None:
    """Drop what neither this batch, if it is repeated, nor the next one nor a reader can need."""
    needed = {first for n in (batch_id, batch_id + 1) for first, size in segments(n) if size == 1} | {batch_id, batch_id - 1}
    # A merge reads what the batch before left.
    needed |= {batch_id - i for i in range(MERGED)} if (batch_id + 1) % MERGED == 0 else set()
    merged = {f"segment={a}-{b}" for n in (batch_id, batch_id + 1) for a, b in segments(n)}
    keep = merged | {f"batch={n}" for n in needed}
    names = [n for n in versions.files.names(path) if n.startswith(("batch=", "segment="))]
    drop_folders(versions.files, path, (n for n in names if n not in keep))
    versions.forget(batch_id - 1)


def start_failed_login_counts(
    transactions: DataFrame,
    logins: DataFrame,
    path: str,
    checkpoint: str,
    delay: str,
    hours: int = LOOKBACK_HOURS,
    continuous: bool = False,
) -> StreamingQuery:
    """Count below ``path``. ``delay`` (as "12 hours") is how late events may arrive."""
    writer = _events(transactions, logins).writeStream.foreachBatch(_batch_handler(path, delay, hours))
    writer = writer.option("checkpointLocation", checkpoint)
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_failed_login_counts(spark: SparkSession, path: str) -> DataFrame:
    """Current count per transaction: a row of a segment, or of the state while it is open."""
    latest = Versions(spark, path).current()
    if latest is None:
        return spark.createDataFrame([], COUNTS)
    closed = _read_segments(spark, path, segments(latest + 1))
    still_open = read_state(spark, path, latest).where("is_tx").select(closed.columns)
    return closed.unionByName(still_open).withColumnRenamed("n", "failed_logins_24h")
