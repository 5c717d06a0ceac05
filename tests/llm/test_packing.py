from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from riskweave.llm.packing import pack_shards, place
from tests.llm.conftest import documents


def brute_place(items, n_shards):
    total = [max(1, sum(i[d] for i in items)) for d in range(3)]
    share = [[i[d] * n_shards / total[d] for d in range(3)] for i in items]
    residual = [[1.0] * 3 for _ in range(n_shards)]
    shard = {}
    for i in sorted(range(len(items)), key=lambda i: -max(share[i])):
        dots = [sum(a * b for a, b in zip(r, share[i], strict=True)) for r in residual]
        shard[i] = max(range(n_shards), key=lambda s: (round(dots[s], 12), -s))
        residual[shard[i]] = [a - b for a, b in zip(residual[shard[i]], share[i], strict=True)]
    return [shard[i] for i in range(len(items))]


def test_placing_follows_the_largest_dot_product():
    items = np.random.default_rng(4).integers(1, 1000, (200, 3)).astype(float)
    assert place(items, 7).tolist() == brute_place(items.tolist(), 7)


def test_shards_are_balanced_and_groups_stay_together(spark, odd_texts):
    texts = [*odd_texts[:12], *(f"text {i} " * (1 + i % 17) for i in range(900)), *(["copied text here"] * 20)]
    rows = pack_shards(documents(spark, texts), n_shards=6, bundles_per_shard=32).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    sizes, slots, of_text = defaultdict(lambda: np.zeros(3)), defaultdict(list), defaultdict(set)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.tokens) == (len(data) + 8, zlib.crc32(data), len(data.split()))
        sizes[r.shard] += (r.size, r.tokens, 1)
        slots[r.shard].append(r.slot)
        of_text[texts[r.doc_id]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for t, s in of_text.items() if t != "word " * 3000)
    table = np.array([sizes[s] for s in range(6)])
    mean = table.mean(axis=0)
    assert (abs(table - mean) < 0.2 * mean).all()


def test_a_group_of_a_third_of_all_rows_is_split(spark):
    texts = ["the hot text"] * 300 + [f"other text {i}" for i in range(600)]
    rows = pack_shards(documents(spark, texts), n_shards=6).collect()
    count = np.bincount([r.shard for r in rows], minlength=6)
    assert count.sum() == 900 and count.max() - count.min() < 30


def test_reruns_agree(spark, odd_texts):
    docs = documents(spark, odd_texts)
    first, second = (sorted((r.doc_id, r.shard, r.slot) for r in pack_shards(docs).collect()) for _ in range(2))
    assert first == second


def test_empty_table_and_null_ids(spark):
    assert pack_shards(documents(spark, [])).count() == 0
    rows = pack_shards(documents(spark, ["a", "a", None], ids=[None, None, 1]), n_shards=2).collect()
    assert len({(r.shard, r.slot) for r in rows}) == 3


def test_groups_up_to_a_shard_stay_whole(spark):
    texts = ["word " * 20] * 60 + [f"other {i:04} " + "word " * 19 for i in range(540)]  # 0.6 of a shard
    rows = pack_shards(documents(spark, texts), n_shards=6).collect()
    assert len({r.shard for r in rows if r.doc_id < 60}) == 1
    size = np.bincount([r.shard for r in rows], [r.size for r in rows], 6)
    assert (abs(size - size.mean()) < 0.05 * size.mean()).all()


def test_copies_under_null_and_equal_ids_are_split(spark):
    for hot in (None, 7):
        texts = ["the hot text"] * 300 + [f"other text {i}" for i in range(600)]
        ids = [hot] * 300 + list(range(1000, 1600))
        rows = pack_shards(documents(spark, texts, ids=ids), n_shards=6).collect()
        count = np.bincount([r.shard for r in rows], minlength=6)
        assert count.sum() == 900 and count.max() - count.min() < 30
        assert len({(r.shard, r.slot) for r in rows}) == 900


def test_the_input_s_partitions_do_not_matter(spark):
    """A group above a shard, its copies under own, equal and null ids; the same rows dealt anew."""
    texts = ["the hot text"] * 500 + [f"other text {i} " * (1 + i % 9) for i in range(700)]
    ids = [*range(200), *[7] * 150, *[None] * 150, *range(1000, 1700)]
    docs = documents(spark, texts, ids=ids)
    results = []
    for dealt in (docs.coalesce(1), docs.repartition(7), docs.orderBy("text", "k")):
        results.append(sorted(tuple(r) for r in pack_shards(dealt, n_shards=6).select("size", "text_crc32", "shard", "slot", F.coalesce("doc_id", F.lit(-1))).collect()))
    assert results[0] == results[1] == results[2] and len(results[0]) == 1200


def test_blocks_of_copies(spark, monkeypatch):
    import riskweave.llm.packing as packing

    monkeypatch.setattr(packing, "BLOCK_ROWS", 7)
    rows = spark.createDataFrame([(1, 5)] * 20 + [(2, 6)] * 7 + [(3, 8)], "doc_id long, row_hash long")
    made = packing._copies(rows).collect()
    assert sorted(r.doc_id for r in made) == [1] * 20 + [2] * 7 + [3] and len({r.row_hash for r in made}) == 28
