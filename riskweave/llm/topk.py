"""Exact top-k search by inner product, block at a time with pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.session import materialize

# Float products and sums are exact below this.
EXACT = 1 << 53
# Scores are longs.
HELD = 1 << 63

# Chunks whose extents a chunk of queries meets at once.
MEETING = 256

FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, each component x as floor(scale * x), longs.

    Vectors that are null, have no id, or hold a component that is null or not
    finite take no part. Components that no long holds become the nearest one,
    which ``top_k`` refuses.
    """
    x = F.col(vector_col).cast("array<double>")
    fits = F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(fits, x).alias("x"))
    usable = usable.where("vec_id is not null and x is not null")
    return usable.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _matrix(column: pa.ListArray, width: int, kind: str) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), kind)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _centres(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """Directions that the sample's vectors lie along, by spherical k-means."""
    unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-9)
    centres = unit[: max(1, n)]
    for _ in range(rounds):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-9), centres)
    return centres


def _packed(rows: DataFrame, centres: np.ndarray, width: int, kind: str, size: int, parts: int) -> DataFrame:
    """Chunks of ``size`` vectors, alike ones together: ids, a matrix in bytes, its highest and lowest values."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centre = (_matrix(batch["v"], width, kind) @ centres.T).argmax(axis=1).astype(np.int64) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(centre, pa.int64())], names=["vec_id", "v", "centre"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = np.zeros(0, np.int64), np.zeros((0, width), kind)

        def emit(n: int) -> pa.RecordBatch:
            extent = np.concatenate([matrix[:n].max(axis=0), matrix[:n].min(axis=0)])
            data = {"ids": [ids[:n].tobytes()], "matrix": [matrix[:n].tobytes()], "extent": [extent.tobytes()], "n": [n]}
            return pa.RecordBatch.from_pydict(data)

        for batch in batches:
            ids = np.concatenate([ids, batch["vec_id"].to_numpy()])
            matrix = np.concatenate([matrix, _matrix(batch["v"], width, kind)])
            while len(ids) >= size:
                yield emit(size)
                ids, matrix = ids[size:], matrix[size:]
        if len(ids):
            yield emit(len(ids))

    placed = rows.mapInArrow(nearest, "vec_id long, v array<long>, centre long")
    ordered = placed.repartitionByRange(parts, "centre", "vec_id").sortWithinPartitions("centre", "vec_id")
    return ordered.mapInArrow(pack, "ids binary, matrix binary, extent binary, n long")


def _rounded(least: np.ndarray, kind: type) -> np.ndarray:
    """Lower bounds in the type of the scores, so that comparing them is exact."""
    if kind is np.float64:
        return least
    return np.array([-HELD if x < -HELD else min(int(np.floor(x)), HELD - 1) for x in least.tolist()], np.int64)


def _bounds(queries: np.ndarray, highest: np.ndarray, lowest: np.ndarray) -> np.ndarray:
    """For each query and block, the sum over terms of weight times the block's maximum."""
    return np.maximum(queries, 0) @ highest.T + np.minimum(queries, 0) @ lowest.T


def _numbered(chunks: DataFrame) -> DataFrame:
    """Chunks with their number from 0; the frame is stored, so the numbers stay."""
    stored = materialize(chunks.withColumn("id", F.monotonically_increasing_id()), "chunks")
    numbers = stored.select("id", (F.row_number().over(Window.orderBy("id")) - 1).cast("long").alias("chunk"))
    return stored.join(numbers, "id").drop("id")


def search_chunk(
    queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, block: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each query's best ``k`` of a chunk, as arrays of query ids, ids and scores.

    Terms are the dimensions by sign. A block's bound for a query is the sum over
    terms of the query's weight times the block's maximum; blocks are taken in
    order of their bounds, and scored from their vectors, until a bound is below
    the ``k``-th score so far (at first ``least``). Equal bounds are still taken,
    for ties go to the smaller id.
    """
    wide = int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * queries.shape[1]
    kind = np.float64 if wide < EXACT else np.int64
    queries, vectors, least = queries.astype(kind), vectors.astype(kind), _rounded(least, kind)
    starts = np.arange(0, len(vectors), block)
    highest, lowest = np.maximum.reduceat(vectors, starts), np.minimum.reduceat(vectors, starts)
    bounds = _bounds(queries, highest, lowest)
    for q, query_id, kth, bound in zip(queries, query_ids, least, bounds, strict=True):
        order = np.argsort(-bound, kind="stable")
        scores, found = np.zeros(0, kind), np.zeros(0, np.int64)
        at, step = 0, 4
        while at < len(order) and bound[order[at]] >= kth:
            blocks = order[at : at + step]
            rows = (starts[blocks[bound[blocks] >= kth], None] + np.arange(block)).ravel()
            rows = rows[rows < len(vectors)]
            rows = rows[ids[rows] != query_id]
            new = vectors[rows] @ q
            better = new >= kth
            scores, found = np.concatenate([scores, new[better]]), np.concatenate([found, ids[rows[better]]])
            if len(scores) > k:
                best = np.lexsort((found, -scores))[:k]
                scores, found = scores[best], found[best]
                kth = max(kth, scores[-1])
            at, step = at + step, 2 * step
        if len(scores):
            yield np.full(len(scores), query_id), found, scores.astype(np.int64)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    block: int = 64,
    chunk: int = 4096,
    query_chunk: int = 1024,
    sample_rows: int = 4096,
    centres: int = 256,
) -> DataFrame:
    """The ``k`` best other vectors of every query, by exact integer inner product.

    ``vectors`` has ``vec_id`` and ``v`` (integers; missing ones at the end count
    as zero); ``is_query`` selects the queries by ``vec_id``. Returns
    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; ties go to the
    smaller id. Every row is a candidate, those of the query's own id excepted;
    rows that repeat id and vector are one query, but a candidate each. With
    fewer than ``k`` candidates all are returned; empty tables give no rows.

    Vectors are sorted along centres fitted to a sample (``sample_rows`` at
    most) and cut into blocks of ``block``; the sample's scores also give each
    query a first lower bound of its ``k``-th score. Which chunks of blocks a
    chunk of queries needs is found from their highest and lowest values alone;
    only those pairs are made, by equality joins on the chunks' numbers. A pair
    is one row of work of bounded size and returns only scores that can still
    be among the best.

    Every finite vector takes part. If the largest component leads to scores
    that no long holds (its square times the width is 2**63 or more), a
    ``ValueError`` is raised.
    """
    spark = vectors.sparkSession
    stored = materialize(vectors.select("vec_id", "v"), "vectors")
    sizes = stored.agg(
        F.count("*").alias("n"), F.max(F.size("v")).alias("width"),
        F.max(F.array_max("v")).alias("high"), F.min(F.array_min("v")).alias("low"),
    ).first()
    n, width = sizes["n"], max(1, sizes["width"] or 0)
    largest = max(sizes["high"] or 0, -(sizes["low"] or 0))
    if largest * largest * width >= HELD:
        raise ValueError(f"components of {largest} in {width} dimensions make scores that no long holds")
    kind = "<i4" if largest < 1 << 31 else "<i8"
    # How far the float product of two vectors can be from their score.
    error = 0.0 if largest * largest * width < EXACT else float(largest) ** 2 * width * width * 2.0**-52
    drawn = stored.where(F.shiftrightunsigned(F.xxhash64("vec_id"), 11) < min(1.0, 2.0 * sample_rows / max(1, n)) * float(1 << 53))
    picked = drawn.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample_rows).collect()
    sample_ids = np.array([r["vec_id"] for r in picked], np.int64)
    sample = np.array([list(r["v"]) + [0] * (width - len(r["v"])) for r in picked], np.int64).reshape(len(picked), width)
    directions = _centres(sample.astype(np.float64), min(centres, max(1, len(sample)))) if len(sample) else np.zeros((1, width))

    parts = 1 + n // (8 * chunk)
    groups = materialize(_numbered(_packed(stored, directions, width, kind, chunk, parts)), "block_chunks")
    asked = _packed(stored.where(is_query).distinct(), directions, width, kind, query_chunk, parts)

    def threshold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds each query's k-th best score in the sample, a lower bound."""
        for batch in batches:
            least = []
            for ids, matrix in zip(batch["ids"].to_pylist(), batch["matrix"].to_pylist(), strict=True):
                q = np.frombuffer(matrix, kind).reshape(-1, width).astype(np.float64)
                scores = q @ sample.T.astype(np.float64) if len(sample) else np.zeros((len(q), 0))
                scores[np.frombuffer(ids, np.int64)[:, None] == sample_ids] = -np.inf
                kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if len(sample) >= k else np.full(len(q), -np.inf)
                least.append((kth - error).tobytes())
            yield pa.RecordBatch.from_arrays([batch["ids"], batch["matrix"], pa.array(least, pa.binary())], names=["q_ids", "q", "least"])

    asked = _numbered(asked.mapInArrow(threshold, "q_ids binary, q binary, least binary"))
    asked = materialize(asked.withColumnRenamed("chunk", "q_chunk"), "query_chunks")

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs of chunks in which some query's bound reaches its lower bound."""
        for batch in batches:
            for q_chunk, q, least, chunks in zip(*(batch[c].to_pylist() for c in ("q_chunk", "q", "least", "chunks")), strict=True):
                q = np.frombuffer(q, kind).reshape(-1, width).astype(np.float64)
                extents = np.frombuffer(b"".join(c["extent"] for c in chunks), kind).reshape(-1, 2, width).astype(np.float64)
                reached = _bounds(q, extents[:, 0], extents[:, 1]) + error >= np.frombuffer(least)[:, None]
                kept = [c["chunk"] for c, r in zip(chunks, reached.any(axis=0), strict=True) if r]
                yield pa.RecordBatch.from_pydict({"q_chunk": pa.array([q_chunk] * len(kept), pa.int64()), "chunk": pa.array(kept, pa.int64())})

    # Chunks of queries meet the extents of MEETING chunks at once: two vectors of each, not its matrix.
    block_of = F.floor(F.col("chunk") / MEETING)
    extents = groups.groupBy(block_of.alias("meeting")).agg(F.collect_list(F.struct("chunk", "extent")).alias("chunks"))
    meetings = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups.count() // MEETING).cast("long")))
    meeting = asked.select("q_chunk", "q", "least", meetings.alias("meeting")).join(extents, "meeting")
    pairs = materialize(meeting.select("q_chunk", "q", "least", "chunks").mapInArrow(needed, "q_chunk long, chunk long"), "chunk_pairs")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q, least, ids, matrix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = search_chunk(
                    np.frombuffer(q, kind).reshape(-1, width), np.frombuffer(q_ids, np.int64), np.frombuffer(least),
                    np.frombuffer(matrix, kind).reshape(-1, width), np.frombuffer(ids, np.int64), k, block,
                )
                found = list(found)
                if found:
                    columns = [pa.array(np.concatenate(x)) for x in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    cells = pairs.join(asked, "q_chunk").join(groups, "chunk").select("q_ids", "q", "least", "ids", "matrix")
    best = cells.mapInArrow(score, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
