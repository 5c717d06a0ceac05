"""What scoring needs to know of each customer, kept up to date batch by batch.

The history is two tables in folders by hash of the customer: the logins, as
narrow as the features need them, and totals that add up (amounts, night
logins). A merge only writes its own rows, as one more piece of each folder it
touches; pieces of a folder are put together when there are many. A manifest
names the pieces that hold, so a batch opens the folders of its customers and
nothing else, a reader never sees half a merge, and a merge that is repeated
adds nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import columns as C
from riskweave.operators.facts import login_keys
from riskweave.sources.versions import KEPT, Versions, drop_folders

LOGINS = (
    "customer_id bigint, login_timestamp timestamp_ntz, login_attempt_id string, is_success boolean, "
    "odd_hours boolean, weekend_login boolean"
)
# ``spread`` is the sum of squared differences from ``amount_mean``.
TOTALS = "customer_id bigint, amounts bigint, amount_mean double, spread double, night_logins bigint"
SCHEMAS = {"logins": LOGINS, "totals": TOTALS}

# Folders; more of them make a batch read less and a merge write smaller files.
BUCKETS = 64
# Pieces of a folder that are put together by the next merge.
MERGED = 8


def bucket_of(customer: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(customer), F.lit(buckets)).cast("int")


def login_rows(staged: DataFrame) -> DataFrame:
    """What the history keeps of staged logins; those without a customer or time tell nothing."""
    at = F.col("login_timestamp")
    keyed = staged.where("customer_id IS NOT NULL AND login_timestamp IS NOT NULL")
    key = login_keys(staged).schema["login_attempt_id"].dataType
    return keyed.select(
        "customer_id",
        "login_timestamp",
        C.surrogate_key(F.col("customer_id"), at).cast(key).alias("login_attempt_id"),
        "is_success",
        (C.login_time_of_day(at) == C.LOGIN_NIGHT).alias("odd_hours"),
        C.is_weekend(at).alias("weekend_login"),
    )


def _amount_rows(amounts: DataFrame) -> DataFrame:
    amount = F.col("transaction_amount")
    per_customer = amounts.where("customer_id IS NOT NULL AND transaction_amount IS NOT NULL").groupBy("customer_id")
    return per_customer.agg(
        F.count("*").alias("amounts"),
        F.avg(amount).alias("amount_mean"),
        (F.var_pop(amount) * F.count("*")).alias("spread"),
        F.lit(0).cast("bigint").alias("night_logins"),
    )


def _night_rows(logins: DataFrame) -> DataFrame:
    nights = logins.where("odd_hours").groupBy("customer_id").agg(F.count("*").alias("night_logins"))
    zero = F.lit(0.0)
    return nights.select("customer_id", F.lit(0).cast("bigint").alias("amounts"), zero.alias("amount_mean"), zero.alias("spread"), "night_logins")


def combined(totals: DataFrame) -> DataFrame:
    """One row per customer: counts add up, spreads with the distances of their means."""
    n, mean = F.col("amounts"), F.col("amount_mean")
    pieces = totals.groupBy("customer_id").agg(
        F.sum(n).alias("_n"),
        F.try_divide(F.sum(n * mean), F.sum(n)).alias("_mean"),
        F.sum("night_logins").alias("_nights"),
        # A row per piece of the folder and kind: 2 * (MERGED + 1) at most.
        F.collect_list(F.struct("amounts", "amount_mean", "spread")).alias("_pieces"),
    )

    def add(total: Column, piece: Column) -> Column:
        apart = piece["amount_mean"] - F.col("_mean")
        return total + F.when(piece["amounts"] > 0, piece["spread"] + piece["amounts"] * apart * apart).otherwise(0.0)

    return pieces.select(
        "customer_id",
        F.col("_n").alias("amounts"),
        F.coalesce("_mean", F.lit(0.0)).alias("amount_mean"),
        F.aggregate("_pieces", F.lit(0.0), add).alias("spread"),
        F.col("_nights").alias("night_logins"),
    )


class CustomerHistory:
    """The history below ``root``; ``buckets`` counts when the first merge makes it."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._versions = Versions(spark, self.root)
        self._buckets = buckets

    def _manifest(self) -> dict[str, Any]:
        """Folders' pieces by table and bucket, rows written, and the last batch merged from each source."""
        now = self._versions.current()
        if now is None:
            return {
                "buckets": self._buckets,
                "pieces": {t: {} for t in SCHEMAS},
                "rows": dict.fromkeys(SCHEMAS, 0),
                "merged": {},
            }
        return self._versions.manifest(now)

    def _paths(self, table: str, pieces: dict[str, list[int]]) -> list[str]:
        return [f"{self.root}/{table}/version={v}/bucket={b}" for b, versions in pieces.items() for v in versions]

    def _read(self, table: str, pieces: dict[str, list[int]]) -> DataFrame:
        paths = self._paths(table, pieces)
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(*paths)

    def merge(
        self,
        logins: DataFrame | None = None,
        amounts: DataFrame | None = None,
        source: str = "load",
        batch: int | None = None,
    ) -> bool:
        """Add staged logins and mart amounts (``customer_id``, ``transaction_amount``).

        A source's batches come in rising order; one that was merged before is
        left out, which is told by the result. Without a number the rows are
        always added. Only one merge may run at a time.
        """
        manifest = self._manifest()
        if batch is not None and batch <= manifest["merged"].get(source, -1):
            return False
        now = self._versions.current()
        version = 0 if now is None else now + 1
        new: dict[str, DataFrame] = {}
        totals = []
        if logins is not None:
            new["logins"] = login_rows(logins)
            totals.append(_night_rows(new["logins"]))
        if amounts is not None:
            totals.append(_amount_rows(amounts))
        if totals:
            new["totals"] = totals[0] if len(totals) == 1 else totals[0].unionByName(totals[1])
        for table, rows in new.items():
            self._add(table, rows, manifest, version)
        if batch is not None:
            manifest["merged"][source] = batch
        self._versions.declare(version, manifest)
        self._clean(version)
        return True

    def _add(self, table: str, rows: DataFrame, manifest: dict[str, Any], version: int) -> None:
        pieces = manifest["pieces"][table]
        full = {b: versions for b, versions in pieces.items() if len(versions) >= MERGED}
        rows = rows.unionByName(self._read(table, full)) if full else rows
        if table == "totals":
            rows = combined(rows)
        target = f"{self.root}/{table}/version={version}"
        # Sorted by customer, so that files and row groups tell whom they hold; a
        # bucket that holds much becomes several files.
        placed = rows.withColumn("bucket", bucket_of(F.col("customer_id"), manifest["buckets"])).hint("rebalance", "bucket")
        placed = placed.sortWithinPartitions("bucket", "customer_id")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(target)
        written = {n.removeprefix("bucket=") for n in self._versions.files.names(target) if n.startswith("bucket=")}
        # The files' own counts; no column is read.
        manifest["rows"][table] += self._read(table, {b: [version] for b in written}).count()
        for b in written | full.keys():
            kept = [] if b in full else pieces.get(b, [])
            pieces[b] = [*kept, version] if b in written else kept

    def _clean(self, version: int) -> None:
        """Drop pieces that neither of the last manifests names."""
        self._versions.forget(version - KEPT + 1)
        named: dict[str, set[int]] = {t: set() for t in SCHEMAS}
        for v in self._versions.declared():
            for table, pieces in self._versions.manifest(v)["pieces"].items():
                named[table] |= {x for versions in pieces.values() for x in versions}
        for table, versions in named.items():
            folders = self._versions.files.names(f"{self.root}/{table}")
            drop_folders(self._versions.files, f"{self.root}/{table}", (f for f in folders if int(f.removeprefix("version=")) not in versions))

    def rows(self, table: str) -> int:
        """At least as many rows as the table has."""
        return self._manifest()["rows"][table]

    def buckets_of(self, customers: DataFrame) -> tuple[list[int], int]:
        """The buckets of a batch's customers, ``buckets`` numbers at most, and the batch's rows."""
        bucket = bucket_of(F.col("customer_id"), self._manifest()["buckets"])
        found, rows = customers.agg(
            F.collect_set(F.when(F.col("customer_id").isNotNull(), bucket)), F.count("*")
        ).first()
        return sorted(found), rows

    def read(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table's rows, of the given buckets only; totals are one row per customer."""
        pieces = self._manifest()["pieces"][table]
        if buckets is not None:
            pieces = {str(b): pieces[str(b)] for b in buckets if str(b) in pieces}
        rows = self._read(table, pieces)
        return combined(rows) if table == "totals" else rows
