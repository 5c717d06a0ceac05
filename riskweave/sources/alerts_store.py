"""Where alerts are kept: Parquet folders, catalog tables, databases over JDBC.

A folder store has a folder per month of the transactions and in it one per
append, and beside each append a Bloom filter of its alerts' keys. Whether an
alert is stored already is looked up in the appends of its month whose filter
may hold one of the new keys; no other file is opened.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.alerts import alert_kind, new_alerts, one_per_key
from riskweave.schemas import ALERTS, ALERTS_TABLE
from riskweave.session import materialize
from riskweave.sources.versions import Files

# Spark's readers skip names that begin with an underscore.
FILTERS = "_filters"
_FILTER = "chunk bigint, bits binary"
# A filter has this many bits, in chunks of 32,768, and sets so many for a key:
# two in a hundred appends of 100,000 alerts are opened for nothing. Larger
# appends are opened more often, never left out.
FILTER_BITS = 1 << 20
FILTER_HASHES = 3


def write_alerts(alerts: DataFrame, path: str) -> None:
    """Replace the alerts at ``path``."""
    alerts.write.mode("overwrite").parquet(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts at ``path``; the schema is declared, so none at all is fine too."""
    return spark.read.schema(ALERTS).parquet(path)


def table_rows(alerts: DataFrame, inserted_at: Column) -> DataFrame:
    """Alerts as rows of the alerts table.

    The id is a hash of the alert's key and of the moment it was stored: writers
    need neither a counter nor a look at what is stored, and a repeated task
    gives its rows the same ids. Alerts of one key stored at one moment share
    their id; ``only_new`` appends store one of them.
    """
    moment = inserted_at.cast("timestamp_ntz")
    values = {
        "id": F.xxhash64("transaction_id", alert_kind(), moment),
        "inserted_at": moment,
    }
    return alerts.select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in ALERTS_TABLE]
    )


def create_alerts_folder(spark: SparkSession, path: str) -> None:
    """An empty alerts table at ``path``, unless something is there already."""
    Files(spark, path).make_folder(path)


def _read(spark: SparkSession, *paths: str) -> DataFrame:
    # Month and append are in no row: folders of any depth are read alike.
    return spark.read.schema(ALERTS_TABLE).option("recursiveFileLookup", True).parquet(*paths)


def read_alerts_folder(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path)


def _month() -> Column:
    """The folder of an alert; a replay of the same transaction has the same one."""
    return F.coalesce(F.date_format("transaction_timestamp", "yyyy-MM"), F.lit("none"))


def _filter_bits() -> Column:
    """The bits of an alert's key: transaction and kind."""
    hashes = [F.xxhash64("transaction_id", alert_kind(), F.lit(i)) for i in range(FILTER_HASHES)]
    return F.array(*[F.pmod(h, F.lit(FILTER_BITS)) for h in hashes])


def key_filter(alerts: DataFrame) -> DataFrame:
    """A Bloom filter of the alerts' keys: a row for each chunk that has a bit set."""
    bits = alerts.select(F.explode(_filter_bits()).alias("bit"))
    chunk = F.bitmap_bucket_number("bit").alias("chunk")
    return bits.groupBy(chunk).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))


def _appends(files: Files, path: str, months: list[str]) -> list[str]:
    return [f"month={m}/{a}" for m in months for a in files.names(f"{path}/month={m}")]


def _may_hold(alerts: DataFrame, path: str, appends: list[str]) -> list[str]:
    """The appends whose filter may hold a key of ``alerts``, and those without a filter.

    Bits of the new keys meet the chunks of the filters; one name of each append
    that has all bits of some key comes back.
    """
    spark = alerts.sparkSession
    files = Files(spark, path)
    written = set(files.names(f"{path}/{FILTERS}"))
    known = {a: a.rpartition("/")[2] for a in appends if a.rpartition("/")[2] in written}
    if not known:
        return appends
    names = sorted(set(known.values()))
    filters = spark.read.schema(f"{_FILTER}, append string").option("basePath", f"{path}/{FILTERS}")
    filters = filters.parquet(*[f"{path}/{FILTERS}/{n}" for n in names])
    keys = alerts.select(F.monotonically_increasing_id().alias("key"), _filter_bits().alias("all"))
    each = F.array_distinct("all")
    bits = keys.select("key", F.explode(each).alias("bit"), F.size(each).alias("n"))
    bits = bits.select("key", "n", F.bitmap_bucket_number("bit").alias("chunk"), F.bitmap_bit_position("bit").alias("at"))
    byte = F.conv(F.hex(F.substring("bits", (F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = bits.join(filters, "chunk").withColumn("byte", byte).where("getbit(byte, cast(at % 8 as int)) = 1")
    found = held.groupBy("append", "key", "n").agg(F.count("*").alias("found")).where("found = n")
    hit = {f"append={r['append']}" for r in found.select("append").distinct().collect()}
    return [a for a in appends if a not in known or known[a] in hit]


def stored_like(alerts: DataFrame, path: str) -> DataFrame:
    """Stored alerts that may share a key with ``alerts``: of their months, by the filters."""
    spark, path = alerts.sparkSession, path.rstrip("/")
    files = Files(spark, path)
    months = [r[0] for r in alerts.select(_month()).distinct().collect()]
    folders = _may_hold(alerts, path, appends) if (appends := _appends(files, path, sorted(months))) else []
    paths = [f"{path}/{f}" for f in folders]
    # Alerts written before there were months lie in the folder itself.
    paths += [f"{path}/{n}" for n in files.names(path) if n.endswith(".parquet")]
    return _read(spark, *paths) if paths else spark.createDataFrame([], ALERTS_TABLE)


def append_alerts(
    alerts: DataFrame, path: str, inserted_at: Column, only_new: bool = False
) -> None:
    """Append to the alerts table at ``path``, creating it if needed.

    With ``only_new`` one alert is kept for each transaction and kind (rules or
    model), and none where the table has one already, so a repeated run adds
    nothing. Otherwise every run adds all its alerts and reads nothing. An
    append whose filter was not written is still looked into.
    """
    spark, path = alerts.sparkSession, path.rstrip("/")
    create_alerts_folder(spark, path)
    rows = alerts
    if only_new:
        rows = materialize(one_per_key(alerts), "alerts")
        if rows.isEmpty():
            return
        rows = new_alerts(rows, stored_like(rows, path))
    rows = materialize(table_rows(rows, inserted_at).withColumn("month", _month()), "append")
    if rows.isEmpty():
        return
    append = uuid.uuid4().hex
    placed = rows.withColumn("append", F.lit(append)).hint("rebalance", "month")
    placed.write.mode("append").partitionBy("month", "append").parquet(path)
    key_filter(rows).coalesce(1).write.parquet(f"{path}/{FILTERS}/append={append}")


def append_alerts_table(
    alerts: DataFrame, table: str, inserted_at: Column, only_new: bool = False
) -> None:
    """The same for a table of the catalog."""
    spark = alerts.sparkSession
    stored = spark.table(table) if spark.catalog.tableExists(table) else None
    if stored is None:
        stored = spark.createDataFrame([], ALERTS_TABLE)
    rows = new_alerts(alerts, stored) if only_new else alerts
    table_rows(rows, inserted_at).write.mode("append").saveAsTable(table)


def append_alerts_jdbc(
    alerts: DataFrame,
    url: str,
    inserted_at: Column,
    table: str = "fraud_alerts",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Append to a database table that numbers its rows itself."""
    rows = table_rows(alerts, inserted_at).drop("id")
    rows.write.jdbc(url, table, mode="append", properties=dict(properties or {}))
