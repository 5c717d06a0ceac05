"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.components import components
from riskweave.llm.text import digest, slices, text_bytes
from riskweave.session import materialize

SEED = 42

BITS = 64

SHINGLES_AT_ONCE = 1 << 17


def simhash(text: bytes, shingle: int) -> int:
    """The 64-bit fingerprint: a bit is set if over half of the shingles' hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        stop = min(n, at + SHINGLES_AT_ONCE)
        first, last = starts[at:stop].tolist(), ends[at + shingle - 1 : stop + shingle - 1].tolist()
        hashes = map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in zip(first, last, strict=True)], repeat(SEED))
        packed = np.fromiter(hashes, "<u8", stop - at).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(packed, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the text's digest ``td1``, ``td2`` and its SimHash as the long ``fp``."""
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *digest(F.col(text_col).cast("string"), "t"),
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = np.fromiter((simhash(x, shingle) for x in text_bytes(batch["text"])), np.uint64, batch.num_rows)
            columns = [batch["doc_id"], batch["td1"], batch["td2"], pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "td1", "td2", "fp"])

    return source.mapInArrow(hashed, "doc_id long, td1 long, td2 long, fp long")


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """2**(radius+1) - 1 masks over bit positions; any ``radius`` of these escape one of them.

    Each position gets a non-zero vector of radius + 1 bits; the mask of v keeps
    the positions whose vector has an odd product with v. Vectors of at most
    ``radius`` differing positions leave a dimension free, so some v is
    orthogonal to all of them: its mask drops them all, and the pair collides.
    Dealing the vectors in turn gives masks of nearly equal weight.
    """
    n = (1 << (radius + 1)) - 1
    vector = {p: 1 + i % n for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (vector[p] & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _tables(masks: Column) -> Column:
    """An array of (table, key): the fingerprint under each mask."""
    return F.transform(masks, lambda m, t: F.struct(t.alias("t"), F.col("fp").bitwiseAND(m).alias("key")))


def _spanning_links(bucket: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what pairs within the radius connect, fewer than members."""
    rest = bucket
    while len(rest):
        heads, rest = [rest[0]], rest[1:]
        while heads and len(rest):
            head = heads.pop()
            near = np.bitwise_count(rest ^ head) <= radius
            if near.any():
                found, rest = rest[near], rest[~near]
                yield np.full(len(found), head), found
                heads.extend(found)


def _links_within(rows: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Links among the fingerprints of each bucket; a task sees its buckets one after the other."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def emit(table: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            prints = table[-1].view(np.uint64)
            changed = np.zeros(len(prints), bool)
            for key in table[:-1]:
                changed[1:] |= key[1:] != key[:-1]
            cuts = [0, *np.flatnonzero(changed).tolist(), len(prints)]
            out = [x for a, b in zip(cuts, cuts[1:], strict=False) if b - a > 1 for x in _spanning_links(prints[a:b], radius)]
            if out:
                left, right = (np.concatenate(x).view(np.int64) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if kept:
                table = [np.concatenate(x) for x in zip(kept, table, strict=True)]
            # The last bucket may go on in the next batch.
            same = np.ones(len(table[0]), bool)
            for key in table[:-1]:
                same &= key == key[-1]
            open_from = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            kept = [c[open_from:] for c in table]
            if open_from:
                yield from emit([c[:open_from] for c in table])
        if kept:
            yield from emit(kept)

    dealt = rows.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, "fp")
    return dealt.mapInArrow(link, "a long, b long")


def near_links(prints: DataFrame, radius: int, most_in_bucket: int = 4096) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints that connect all pairs within the radius.

    Every pair within the radius agrees under one of the covering masks. Buckets
    above ``most_in_bucket`` are split by a second covering family over the bits
    that the first mask dropped: their pairs can differ only there, so none is
    lost, and so few bits stay free that a bucket is bounded.
    """
    masks = covering_masks(list(range(BITS)), radius)
    inner = [covering_masks([p for p in range(BITS) if not m >> p & 1], radius) for m in masks]
    first = F.lit([_signed(m) for m in masks]).cast("array<long>")
    second = F.lit([[_signed(m) for m in family] for family in inner]).cast("array<array<long>>")

    rows = prints.select("fp", F.explode(_tables(first)).alias("x")).select("x.t", "x.key", "fp")
    rows = rows.withColumn("n", F.count("*").over(Window.partitionBy("t", "key"))).where("n > 1")
    rows = materialize(rows, "buckets")
    small = _links_within(rows.where(F.col("n") <= most_in_bucket), ["t", "key"], radius)
    large = rows.where(F.col("n") > most_in_bucket)
    split = large.select("t", "key", "fp", F.explode(_tables(F.element_at(second, F.col("t") + 1))).alias("y"))
    split = split.select("t", "key", F.col("y.t").alias("t2"), F.col("y.key").alias("key2"), "fp")
    return small.unionByName(_links_within(split, ["t", "key", "t2", "key2"], radius))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    radius: int = 4,
    most_in_bucket: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each document's fingerprint and the smallest id of its near-duplicate class.

    ASCII capitals are lowered, words of ASCII non-space joined to shingles of
    ``shingle`` words (a shorter text is one shingle). Fingerprints that differ
    in ``radius`` bits or less are linked; classes are the connected components.
    A text that is null or has no word has fingerprint zero, linked like any
    other. Rows without an id get their class but never name it; a class without
    any id is null. Other columns are not looked at.

    Returns ``doc_id``, ``td1``, ``td2``, ``fp`` (a signed long), ``class_fp``
    (one of the class's fingerprints, its key) and ``component_id``. Documents meet by distinct fingerprint only, so copies
    cost one row each, and no group of them is ever paired out.
    """
    hashed = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = materialize(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = components(near_links(distinct, radius, most_in_bucket))
    members = distinct.join(labels, distinct.fp == labels.node, "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    named = members.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = materialize(members.join(named, "label").select("fp", F.col("label").alias("class_fp"), "component_id"), "classes")
    return hashed.join(classes, "fp").select("doc_id", "td1", "td2", "fp", "class_fp", "component_id")
