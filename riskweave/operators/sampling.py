"""Exact, repeatable stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def stratified_split(
    df: DataFrame,
    label: str = "label",
    key: str = "transaction_id",
    one_in: int = 5,
    rows_per_bucket: int = 100_000,
) -> DataFrame:
    """Add ``split``: in each label, ``count div one_in`` rows are 'test'.

    Rows are taken in the order of the MD5 of their key. Ranking whole labels
    would put each into one task, so the last test row of a label is looked up
    instead: the number of rows per leading hash digits tells which bucket it
    lies in, and only that bucket is ranked. As many digits are used as leave
    about ``rows_per_bucket`` rows in a bucket. What every row is then compared
    to is one row per label. The frame is read four times; have it materialised.
    """
    rows, hash_digits = df.count(), 1
    while rows >> (4 * hash_digits) > rows_per_bucket:
        hash_digits += 1
    digest = F.md5(F.col(key).cast("string"))
    hashed = df.withColumns({"_hash": digest, "_bucket": F.substring(digest, 1, hash_digits)})
    sizes = hashed.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))
    in_label = Window.partitionBy(label)
    up_to = in_label.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quota = F.floor(F.sum("_n").over(in_label) / one_in)
    border = (
        sizes.select(
            label,
            "_bucket",
            quota.alias("_quota"),
            F.sum("_n").over(up_to).alias("_through"),
            "_n",
        )
        .where("_through >= _quota AND _through - _n < _quota")
        .select(label, "_bucket", (F.col("_quota") - F.col("_through") + F.col("_n")).alias("_nth"))
    )
    ranked = Window.partitionBy(label).orderBy("_hash", key)
    # Borders and last rows: one row per label each.
    last = (
        hashed.select(label, "_bucket", "_hash", key)
        .join(border, [label, "_bucket"])
        .withColumn("_rank", F.row_number().over(ranked))
        .where("_rank = _nth")
        .select(label, F.struct("_hash", key).alias("_last"))
    )
    is_test = F.struct("_hash", key) <= F.col("_last")
    return hashed.join(last, label, "left").select(
        *df.columns, F.when(is_test, "test").otherwise("train").alias("split")
    )
