"""Reading and writing the source tables and the marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.schemas import MARTS, PARTITION_COLUMN, SOURCES
from riskweave.sources.versions import Versions, publish, published

# The folder of marts that are published together.
TOGETHER = "marts"


def read_source(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every Parquet file of one source table, partition directories included."""
    return spark.read.schema(SOURCES[name]).parquet(f"{root.rstrip('/')}/{name}")


def read_sources(
    spark: SparkSession, root: str, paths: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """All four source tables; ``paths`` overrides where single tables lie."""
    paths = paths or {}
    return {
        name: spark.read.schema(SOURCES[name]).parquet(paths[name])
        if name in paths
        else read_source(spark, root, name)
        for name in SOURCES
    }


def stored_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The source tables with the types that their files have."""
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{name}") for name in SOURCES}


def read_nanosecond_source(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A source file whose timestamps are nanoseconds, as pandas writes them.

    Spark refuses that Parquet type unless told to read it as a plain long; the
    longs become microsecond timestamps here.
    """
    setting = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        raw = spark.read.parquet(path)
        stored = {field.name: field.dataType for field in raw.schema}
    finally:
        spark.conf.set(setting, before)
    columns = []
    for field in SOURCES[name]:
        if field.name not in stored:
            continue
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampNTZType) and stored[field.name] == T.LongType():
            epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            micros = F.floor(column / F.lit(1000).cast("decimal(4,0)")).cast("bigint")
            column = F.timestamp_add("MICROSECOND", micros, epoch)
        columns.append(column.cast(field.dataType).alias(field.name))
    return raw.select(*columns)


def partition_month(name: str, df: DataFrame) -> DataFrame:
    """Add the month column a source table is partitioned by, if it lacks it."""
    origin = {
        "AccountCreationMonth": "AccountCreationDate",
        "TimestampMonth": "Timestamp",
        "LoginTimestampMonth": "LoginTimestamp",
    }
    key = PARTITION_COLUMN.get(name)
    if key in origin and key not in df.columns:
        return df.withColumn(key, F.month(origin[key]))
    return df


def conform(name: str, df: DataFrame) -> DataFrame:
    """``df`` with exactly the declared columns and types; absent columns are null."""
    if name not in SOURCES:
        return df
    df = partition_month(name, df)
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SOURCES[name]
        ]
    )


def write_source(df: DataFrame, root: str, name: str) -> str:
    """Write one source table partitioned by its key; returns its path.

    ``rebalance`` gathers each partition value in few tasks, yet lets adaptive
    execution cut a value that holds much of the table into several files. Only
    the partitions present in ``df`` are replaced. A table without a declared
    key is written unpartitioned.
    """
    path = f"{root.rstrip('/')}/{name}"
    key = PARTITION_COLUMN.get(name)
    if key is None:
        df.write.mode("overwrite").parquet(path)
        return path
    (
        conform(name, df)
        .hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )
    return path


def write_mart(df: DataFrame, root: str, name: str) -> str:
    """Publish a mart as its next version; returns the folder of all versions.

    Readers see the version before until this one is whole, also if the write
    fails; the version before stays for those that have begun to read it.
    """
    path = f"{root.rstrip('/')}/{name}.parquet"
    publish(df.sparkSession, path, df.write.parquet)
    return path


def publish_marts(
    spark: SparkSession,
    marts: Mapping[str, DataFrame],
    root: str,
    accept: Callable[[], None] = lambda: None,
) -> int:
    """Publish several marts together: all of them are whole before any of them is seen.

    ``accept`` is called once all are written; if it raises, none is ever seen.
    """

    def write(folder: str) -> None:
        for name, df in marts.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        accept()

    return publish(spark, f"{root.rstrip('/')}/{TOGETHER}", write)


def _mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    together = f"{root}/{TOGETHER}"
    if Versions(spark, together).current() is not None:
        return spark.read.schema(MARTS[name]).parquet(f"{published(spark, together)}/{name}.parquet")
    return spark.read.schema(MARTS[name]).parquet(published(spark, f"{root}/{name}.parquet"))


def load_marts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Both marts as last published, together or one by one: transactions, then logins."""
    root = root.rstrip("/")
    return tuple(_mart(spark, root, name) for name in ("v_transaction", "v_login_attempt"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result
