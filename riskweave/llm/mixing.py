"""Mixing sources to target weights by hash thresholds, without sorting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.text import word_count
from riskweave.session import materialize

# Weights by a source's place in code point order, null last, repeating.
WEIGHTS = (5.0, 2.0, 1.0)

MOST_REPEATS = 3

# The 62 bits of a row's hash are read in parts of so many bits.
LEVEL_BITS = (12, 10, 10, 10, 10, 10)
HASH_BITS = sum(LEVEL_BITS)


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``source``, ``source_size``, ``target`` from the sizes of all sources.

    Sources share all sizes by weight; a target stops at ``most`` times its
    source's size and the excess is shared again by weight among the others,
    until none is above. Each round is one aggregate over the table of sources.
    """
    spark = sources.sparkSession
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    # One row per source: ranks come from counting smaller names range by range.
    ranked = materialize(_ranked(sources), "source_ranks")
    weight = F.element_at(F.lit(list(weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight)
    cap = F.col("source_size") * float(most)

    level = 0.0
    while True:
        capped = cap <= F.col("weight") * F.lit(level)
        sums = ranked.agg(
            F.sum(F.when(capped, cap).otherwise(0.0)).alias("capped"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not sums.weight:
            break
        higher = (whole - sums.capped) / sums.weight
        if higher <= level:
            break
        level = higher
    target = F.least(cap, F.col("weight") * F.lit(level))
    return materialize(ranked.select("source", "source_size", target.alias("target")), "source_targets")


def _ranked(sources: DataFrame, parts: int = 16) -> DataFrame:
    """``rank`` from 0 by code point order of ``source``, null last."""
    ranges = sources.repartitionByRange(parts, F.col("source").asc_nulls_last()).sortWithinPartitions(
        F.col("source").asc_nulls_last()
    )
    numbered = materialize(
        ranges.withColumn("id", F.monotonically_increasing_id()), "sources"
    ).withColumn("part", F.shiftright("id", 33)).withColumn("inside", F.col("id").bitwiseAND((1 << 33) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = numbered.groupBy("part").agg(F.count("*").alias("n"))  # a row per range, ``parts`` at most
    base = base.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return numbered.join(F.broadcast(base), "part").select("source", "source_size", (F.col("base") + F.col("inside")).alias("rank"))


def hash_thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source_key``, ``threshold``: rows whose hash is below make up the budget.

    ``rows`` has ``source_key``, ``size``, ``h`` (62 bits); ``budgets`` has
    ``source_key``, ``budget``. Sizes are summed by source and leading hash bits
    (combined before the shuffle, so a source with most rows costs no more than
    any other). The bucket in which the running sum passes the budget is the
    boundary; only its rows are looked at again, by the next bits. This ends
    when every boundary bucket holds one row or one hash; it is taken if that
    comes nearer to the budget.
    """
    state = budgets.select("source_key", F.col("budget").cast("double").alias("left"), F.lit(0).cast("long").alias("prefix"))
    used = 0
    for level, bits in enumerate(LEVEL_BITS):
        used += bits
        shift = HASH_BITS - used
        inside = rows if not level else rows.join(
            state.select("source_key", "prefix"), "source_key"
        ).where(F.shiftright("h", shift + bits) == F.col("prefix")).drop("prefix")
        sums = inside.groupBy("source_key", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n")
        )
        ordered = Window.partitionBy("source_key").orderBy("bucket")
        running = sums.withColumn("upto", F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        crossing = running.join(state.select("source_key", "left"), "source_key").where(F.col("upto") > F.col("left"))
        boundary = crossing.groupBy("source_key").agg(
            F.min_by(F.struct("bucket", (F.col("upto") - F.col("size")).alias("below"), "size", "n", "left"), "bucket").alias("b")
        )
        # Sources whose rows do not reach the budget are taken whole.
        state = materialize(
            state.alias("s").join(boundary.alias("b"), "source_key", "left").select(
                "source_key",
                F.coalesce(F.col("b.left") - F.col("b.below"), F.col("s.left")).alias("left"),
                F.coalesce(F.col("b.bucket"), F.lit(1 << used)).alias("prefix"),
                F.col("b.size").alias("size"),
                F.coalesce(F.col("b.n"), F.lit(0)).alias("n"),
            ),
            "thresholds",
        )
        if not shift or (state.agg(F.max("n")).first()[0] or 0) <= 1:
            break
    nearer = F.coalesce(F.col("size") <= 2 * F.col("left"), F.lit(False))
    limit = F.col("prefix") + nearer.cast("long")
    return state.select("source_key", (limit * (1 << shift)).alias("threshold"))


def mix_plan(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The rows with their sizes, and what each source takes.

    A row of the plan has ``source_key``, ``source_size``, ``target``, ``whole``
    (how often every document is taken) and ``threshold`` (hashes below are
    taken once more).
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(text).alias("size"),
        row_hash(id_col, text_col).alias("h"),
        source_key(source_col).alias("source_key"),
    )
    rows = materialize(rows, "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, most).withColumn("source_key", source_key("source"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long"))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    thresholds = hash_thresholds(rows, targets.select("source_key", rest.alias("budget")))
    return rows, materialize(targets.join(thresholds, "source_key").drop("source"), "mix")


def copies(h: Column, most: int) -> Column:
    """How often a row with hash ``h`` is taken, given its source's row of the plan."""
    times = F.least(F.lit(most), F.col("whole") + (h < F.col("threshold")).cast("long"))
    return F.when(F.col("source_size") == 0, 0).otherwise(times).cast("int")


def mix_sources(docs: DataFrame, most: int = MOST_REPEATS, **parameters) -> DataFrame:
    """How often each document is taken so that sources meet their targets.

    A source takes every document floor(target / size) times, and once more the
    documents whose hash lies below the threshold that makes up the rest.
    Thresholds are nested: a larger budget keeps all that a smaller one takes.
    The hash is a function of id and text, so reruns agree; rows equal in both
    are taken or left together.

    Returns ``doc_id``, ``source``, ``size`` (words), ``source_size``,
    ``target``, ``copies`` and ``taken`` (size times copies). A null text has
    size 0; a null source is a source of its own. Sources without a word have
    target 0 and give no copies. An empty table gives no rows. Other columns are
    not looked at. ``parameters`` are those of ``mix_plan``.
    """
    rows, plan = mix_plan(docs, most=most, **parameters)
    mixed = rows.join(plan, "source_key").withColumn("copies", copies(F.col("h"), most))
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """The documents (columns ``doc_id``, ``text``, ``source`` and any others), each as often as the mix takes it."""
    _, plan = mix_plan(docs, most=most)
    rows = docs.select(F.struct("*").alias("row"), source_key("source").alias("source_key"), row_hash("doc_id", "text").alias("h"))
    joined = rows.join(plan, "source_key")
    repeated = joined.select("row", F.explode(F.array_repeat(F.lit(0), copies(F.col("h"), most))))
    return repeated.select("row.*")


def row_hash(id_col: str, text_col: str) -> Column:
    value = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return F.shiftrightunsigned(value, 64 - HASH_BITS)


def source_key(source_col: str) -> Column:
    """The source as a value that joins: null and text apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("-"))
