"""Order-dependent operators that never put a whole order into one task.

Rows are range-partitioned by the full sort order, so a key that holds much of
the table is spread over as many partitions as its share asks for. The position
of every row is written down once; what a partition needs to know about the ones
before it is a table of at most one row per partition and key crossing it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.session import materialize

POSITION = "_position"
SEGMENT = "_segment"
# What one task sorts (range partitioning balances by a sample). Beyond
# MOST_SEGMENTS segments these grow instead: the driver samples every range.
ROWS_PER_SEGMENT = 2_000_000
MOST_SEGMENTS = 50_000
# Fewer rows are not worth a task of their own.
SMALL_SEGMENT = 2_000
# monotonically_increasing_id() keeps the partition above bit 33.
_ROW_BITS = 33


def order_columns(order: Sequence[str | Column]) -> list[Column]:
    """Ascending, nulls last, for names; columns are taken as they are."""
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def partitions_for(df: DataFrame, rows: int) -> int:
    """As many as ``rows`` need; the session's shuffle partitions where that is fewer."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = min(-(-rows // ROWS_PER_SEGMENT), MOST_SEGMENTS)
    worthwhile = min(configured, -(-rows // SMALL_SEGMENT))
    return max(needed, worthwhile, 1)


def ordered_segments(
    df: DataFrame, order: Sequence[str | Column], partitions: int | None = None
) -> DataFrame:
    """``df`` in global order, cut into segments of about equal size.

    Adds ``_position``, rising in the given order, and ``_segment``. Both are
    frozen in the shared folder: range boundaries come from a sample and could
    differ between two evaluations. Unless ``partitions`` is given, rows are
    counted, so that no segment outgrows a task however large the frame.
    """
    keys = order_columns(order)
    n = partitions or partitions_for(df, df.count())
    placed = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(POSITION, F.monotonically_increasing_id())
    )
    frozen = materialize(placed, "ordered")
    return frozen.withColumn(SEGMENT, F.shiftright(POSITION, _ROW_BITS))


def dense_key(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str,
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows 1..n in a global order, without gaps.

    Equal to ``row_number() over (order by ...)``, which would send every row to
    one task. The row's place in its segment is already in its position; only
    the segments' sizes are summed up, a table of one row per partition.
    """
    placed = ordered_segments(df, order, partitions)
    sizes = placed.groupBy(SEGMENT).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        SEGMENT, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    in_segment = F.col(POSITION) - F.shiftleft(F.col(SEGMENT), _ROW_BITS)
    numbered = placed.join(offsets, SEGMENT)
    return numbered.select((F.col("_offset") + in_segment + 1).alias(name), *df.columns)


def dense_key_by(
    df: DataFrame, column: str, name: str, partitions: int | None = None
) -> DataFrame:
    """Number wide rows 1..n in the order of one column, without gaps.

    Only the column's values and their counts are sorted and stored; rows get
    their number by a join, and rows of equal value are told apart by a hash.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("_rows"))
    through = running_sum(counts, [], [column], "_rows", "_through", partitions)
    before = through.select(
        F.col(column).alias("_value"), (F.col("_through") - F.col("_rows")).alias("_before")
    )
    alike = Window.partitionBy(column).orderBy(F.xxhash64(*df.columns))
    numbered = df.join(before, df[column].eqNullSafe(before["_value"]))
    place = F.col("_before") + F.row_number().over(alike)
    return numbered.select(place.cast("bigint").alias(name), *df.columns)


def carried_forward(
    placed: DataFrame,
    keys: Sequence[str],
    totals: Mapping[str, tuple[str, Callable[[Column], Column]]],
) -> DataFrame:
    """Per key and segment, aggregates over the key's earlier segments.

    ``totals`` maps a name to a source column and an aggregate that also combines
    its own results (sum, max). Only segments a key continues into are kept. The
    rows lie in key order, so at most one key crosses the border between two
    segments: the result has fewer rows than there are segments.
    """
    per_segment = placed.groupBy(*keys, SEGMENT).agg(
        *[aggregate(F.col(source)).alias(name) for name, (source, aggregate) in totals.items()]
    )
    in_order = Window.partitionBy(*keys).orderBy(SEGMENT)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    carried = per_segment.select(
        *keys,
        SEGMENT,
        F.row_number().over(in_order).alias("_nth"),
        *[
            aggregate(F.col(name)).over(earlier).alias(name)
            for name, (_, aggregate) in totals.items()
        ],
    )
    return carried.where(F.col("_nth") > 1).drop("_nth")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    partitions: int | None = None,
) -> DataFrame:
    """Sum of ``value`` up to and including each row, per key (keys not null).

    Without keys this is one running total over the whole table, still computed
    in all partitions at once.
    """
    placed = ordered_segments(df, [*keys, *order], partitions)
    within = (
        Window.partitionBy(SEGMENT, *keys)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = carried_forward(placed, keys, {"_carried": (value, F.sum)})
    total = F.coalesce(F.sum(value).over(within), F.lit(0)) + F.coalesce("_carried", F.lit(0))
    return placed.join(carried, [*keys, SEGMENT], "left").select(
        *df.columns, total.alias(name)
    )
