"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results rely on (time zone) or the plans rely on (adaptive
# re-planning, skewed joins split even where a later operator would have liked
# to keep the join's partitioning).
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_scratch: str | None = None
_scratch_folders: list[str] = []


def get_spark(app_name: str = "riskweave", cores: int | None = None) -> SparkSession:
    """A session for this library; ``cores`` asks for a local one.

    On a cluster leave ``cores`` out: master, memory and partition counts then
    come from spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    # Column expressions need no record of the Python line that built them.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if cores is not None:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
            .config("spark.ui.enabled", "false")
            # Small local data still deserves all cores.
            .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        )
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def sibling(spark: SparkSession) -> SparkSession:
    """Another session of the same application, with the same settings.

    For observed metrics: a session that has observed any cannot be serialised
    afterwards, and models hold on to the session that trained them.
    """
    beside = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            beside.conf.set(key, value)
    return beside


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` comes first, then a directory set on the context.
    Only a local session may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="riskweave-")
        atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    folder = f"{shared_root(spark)}/riskweave/{uuid.uuid4().hex}"
    _scratch_folders.append(folder)
    return f"{folder}/{name}"


def delete_scratch(spark: SparkSession) -> None:
    """Delete what this process has written below the shared folder.

    For the end of a job: results that are still lazy may read these files.
    """
    while _scratch_folders:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch_folders.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a value must not change between two uses (a position taken from
    a sample-based range partitioning) or where many passes follow (training).
    The files survive the loss of any executor, and the lineage ends here.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
