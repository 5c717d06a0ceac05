"""Sharding by vector bin packing: bytes, tokens and rows balanced together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.text import byte_length, digest, word_count
from riskweave.session import materialize

DIMENSIONS = ("bytes", "tokens", "rows")

ROW_BYTES = 8

# Copies of a row that one task numbers.
BLOCK_ROWS = 100_000

# How far a shard's bytes may be off their fair share for the sake of whole groups.
SPREAD = 0.01


def place(items: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each item (a row of sizes), largest items first.

    Sizes are fractions of one shard's fair share. An item goes where its dot
    product with the residual capacity is highest; of several such shards to
    the first. Residuals may turn negative: nothing is left out.
    """
    total = items.sum(axis=0)
    share = items * (n_shards / np.where(total > 0, total, 1))
    residual = np.ones((n_shards, items.shape[1]))
    shard = np.zeros(len(items), dtype=np.int64)
    for item in np.argsort(-share.max(axis=1), kind="stable"):
        best = int(np.argmax(residual @ share[item]))
        shard[item] = best
        residual[best] -= share[item]
    return shard


def pieces_of(heavy: np.ndarray, bundles: np.ndarray, n_shards: int, split_share: int) -> np.ndarray:
    """Into how many pieces each heavy group goes, given the sizes of all items.

    Only groups above a shard's fair share in some dimension are split, unless
    the shards' bytes are then off their share by more than ``SPREAD`` and
    splitting all groups above 1/``split_share`` of a shard brings them nearer.
    """
    total = heavy.sum(axis=0) + bundles.sum(axis=0)
    most = (heavy * (n_shards / np.where(total > 0, total, 1))).max(axis=1)
    small = np.maximum(1, np.ceil(most * split_share)).astype(np.int64)
    whole = np.where(most > 1, small, 1)

    def spread(pieces: np.ndarray) -> float:
        items = np.concatenate([np.repeat(heavy / pieces[:, None], pieces, axis=0), bundles])
        loads = np.bincount(place(items, n_shards), items[:, 0], n_shards)
        return float(abs(loads * n_shards / max(1, total[0]) - 1).max())

    if (whole == small).all():
        return whole
    off = spread(whole)
    return whole if off <= SPREAD or off <= spread(small) else small


def pack_shards(
    docs: DataFrame,
    n_shards: int = 24,
    bundles_per_shard: int = 256,
    split_share: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Put every row into a shard, equal texts together, all sizes balanced.

    A group is the rows of one text. Groups that hold 1/``bundles_per_shard``
    of a shard or more in some dimension are items of their own; all others are
    bundled by their text's hash into ``n_shards * bundles_per_shard`` items.
    Both kinds are bounded in number by these two parameters, whatever the
    input, and so are the sums that the driver packs. A group above a whole
    shard is split by row into pieces of about 1/``split_share`` of a shard, one
    above such a piece only if the shards' bytes would differ otherwise
    (``pieces_of``). Rows equal in id and text are dealt to pieces one by one.

    Returns ``doc_id``, ``size`` (UTF-8 bytes plus 8), ``tokens`` (words),
    ``text_crc32``, ``shard`` and ``slot``, which counts a shard's rows from 0
    by hash lot and then by id. A null text has no bytes and forms a group of
    its own, apart from the empty text. An empty table gives no rows.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (byte_length(text) + ROW_BYTES).alias("size"),
        word_count(text).alias("tokens"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        *digest(text, "t"),
    )
    rows = rows.withColumn("row_hash", F.xxhash64("doc_id", "td2", "text_crc32"))
    rows = materialize(rows, "sizes")

    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    groups = rows.groupBy("td1", "td2").agg(*sums)
    whole = groups.agg(*[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMENSIONS]).first()
    n_bundles = n_shards * bundles_per_shard

    def exceeds(parts: int):
        """Whether a group has over a part of one shard in any dimension."""
        return F.greatest(*[F.col(d) * (n_shards * parts / max(1, whole[d])) for d in DIMENSIONS])

    # A dimension has n_bundles groups at least as large as its n_bundles-th
    # part at most, so there are three times as many heavy groups at most.
    groups = groups.withColumn("heavy", exceeds(bundles_per_shard) >= 1)
    bundle = F.when(~F.col("heavy"), F.pmod("td1", F.lit(n_bundles)))
    large = groups.where("heavy").select("td1", "td2", *DIMENSIONS).orderBy("td1", "td2").collect()
    light = groups.where("not heavy").groupBy(bundle.alias("item")).agg(*[F.sum(d).alias(d) for d in DIMENSIONS]).orderBy("item").collect()
    pieces = pieces_of(_sizes(large), _sizes(light), n_shards, split_share)
    heavy = rows.sparkSession.createDataFrame(
        [(r["td1"], r["td2"], int(n)) for r, n in zip(large, pieces, strict=True)], "td1 long, td2 long, pieces int"
    )
    found = rows.join(F.broadcast(heavy), ["td1", "td2"], "left")
    split = _copies(found.where("pieces > 1"))
    items = found.where("pieces is null or pieces = 1").unionByName(split).select(
        "doc_id", "size", "tokens", "text_crc32", "row_hash",
        F.when(F.col("pieces").isNull(), F.pmod("td1", F.lit(n_bundles))).otherwise(F.col("td1")).alias("item"),
        F.when(F.col("pieces").isNull(), F.lit(None)).otherwise(F.col("td2")).alias("heavy"),
        F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(F.pmod("row_hash", F.col("pieces"))).alias("piece"),
    )
    key = ["item", "heavy", "piece"]
    # As many rows as the two parameters allow, so they may go to the driver.
    sizes = items.groupBy(*key).agg(*sums).orderBy(*key).collect()
    plan = rows.sparkSession.createDataFrame(
        [(*(r[c] for c in key), int(s)) for r, s in zip(sizes, place(_sizes(sizes), n_shards), strict=True)],
        "item long, heavy long, piece long, shard int",
    )
    placed = items.alias("i").join(
        F.broadcast(plan).alias("p"),
        (F.col("i.item") == F.col("p.item"))
        & F.col("i.heavy").eqNullSafe(F.col("p.heavy"))
        & (F.col("i.piece") == F.col("p.piece")),
    )
    placed = placed.select("i.doc_id", "i.size", "i.tokens", "i.text_crc32", "i.row_hash", "p.shard")
    return number_slots(placed, n_shards, int(whole["rows"]))


def _copies(rows: DataFrame) -> DataFrame:
    """The rows, those that are equal told apart by a number in ``row_hash``.

    Equal rows are counted, combined before the shuffle, and made again from
    their count, blocks of them in tasks of their own. So the numbers do not
    depend on how the input is dealt, and no task holds all copies of a row.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    blocks = counted.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BLOCK_ROWS).cast("long"))).alias("from")
    )
    numbers = F.sequence(F.col("from"), F.least("n", F.col("from") + BLOCK_ROWS) - 1)
    each = blocks.repartition("row_hash", "from").withColumn("copy", F.explode(numbers))
    return each.withColumn("row_hash", F.xxhash64("row_hash", "copy")).select(*rows.columns)


def _sizes(rows: list) -> np.ndarray:
    return np.array([[r[d] for d in DIMENSIONS] for r in rows], dtype=np.float64).reshape(len(rows), len(DIMENSIONS))


def number_slots(placed: DataFrame, n_shards: int, n_rows: int, lot_rows: int = 100_000) -> DataFrame:
    """Number each shard's rows from 0 without a task that sees a whole shard.

    Rows are dealt to lots by hash; a lot's first slot is the sum of the lots
    before it, its rows are numbered inside it.
    """
    lots = 1 + n_rows // (n_shards * lot_rows)
    placed = placed.withColumn("lot", F.pmod("row_hash", F.lit(lots)).cast("long"))
    before = Window.partitionBy("shard").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    base = placed.groupBy("shard", "lot").agg(F.count("*").alias("n"))
    base = base.select("shard", "lot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "lot").orderBy("doc_id", "row_hash")
    numbered = placed.withColumn("inside", F.row_number().over(inside))
    numbered = numbered.join(base, ["shard", "lot"])
    return numbered.select(
        "doc_id", "size", "tokens", "text_crc32", "shard", (F.col("base") + F.col("inside") - 1).cast("long").alias("slot")
    )
