from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.operators.ordered import (
    ROWS_PER_SEGMENT,
    SEGMENT,
    carried_forward,
    dense_key,
    ordered_segments,
    partitions_for,
    running_sum,
)
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows, half of them of key 1, in random order."""
    rng = random.Random(5)
    data = [(1 if i % 2 else rng.randrange(2, 40), i, rng.randrange(-9, 9)) for i in range(2000)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k bigint, i bigint, v bigint").repartition(5)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_dense_key_equals_row_number(skewed, partitions):
    numbered = dense_key(skewed, ["k", "i"], "n", partitions)
    want = skewed.withColumn("n", F.row_number().over(Window.orderBy("k", "i")))
    assert rows(numbered, "n", "k", "i") == rows(want, "n", "k", "i")


def test_dense_key_puts_nulls_last(spark):
    df = spark.createDataFrame([(None,), (3,), (1,)], "k bigint")
    assert rows(dense_key(df, ["k"], "n")) == [(1, 1), (2, 3), (3, None)]


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.createDataFrame([], "k bigint"), ["k"], "n").count() == 0


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sum_equals_the_window(skewed, keys):
    order = ["i"] if keys else ["k", "i"]
    got = running_sum(skewed, keys, order, "v", "s", partitions=9)
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    want = skewed.withColumn("s", F.sum("v").over(window))
    assert rows(got) == rows(want)


def test_a_hot_key_spans_segments_and_little_is_carried(skewed):
    placed = ordered_segments(skewed, ["k", "i"], partitions=16)
    sizes = {r[0]: r[1] for r in placed.groupBy(SEGMENT).count().collect()}
    assert len(sizes) > 8 and max(sizes.values()) < 400
    assert placed.where("k = 1").select(SEGMENT).distinct().count() > 4
    carried = carried_forward(placed, ["k"], {"s": ("v", F.sum)})
    assert 4 <= carried.count() < len(sizes)


def test_partitions_grow_with_the_rows(skewed):
    assert partitions_for(skewed, 0) == partitions_for(skewed, 10) == 1
    assert partitions_for(skewed, 5000) == 3
    assert partitions_for(skewed, 10**6) == 4
    assert partitions_for(skewed, 100 * ROWS_PER_SEGMENT + 1) == 101
