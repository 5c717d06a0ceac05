from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from riskweave.llm.components import components
from riskweave.llm.simhash import covering_masks, near_duplicates, near_links, simhash
from tests.llm.conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text, shingle=4):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    strings = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in strings]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, radius):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(len(prints))]


def test_prints_are_the_majority_of_all_shingles(odd_texts):
    for text in odd_texts:
        assert simhash((text or "").encode(), 4) == brute_print(text)


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = covering_masks(list(range(64)), radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    for _ in range(20_000):
        differing = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not differing & m for m in masks)
    assert max(m.bit_count() for m in masks) - min(m.bit_count() for m in masks) <= 4


@pytest.mark.parametrize("most_in_bucket", [4096, 3])
def test_links_connect_what_all_pairs_connect(spark, most_in_bucket):
    rng = random.Random(11)
    prints = [0]
    for _ in range(60):
        seed = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 9)):
            prints.append(seed)
            seed ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6)))
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4, most_in_bucket)
    labels = {r.node: r.label for r in components(links).collect()}
    mine = [labels.get(p, p) for p in signed]
    wanted = brute_classes(prints, 4)
    assert len(set(zip(mine, wanted, strict=True))) == len(set(mine)) == len(set(wanted))


def test_components_of_a_long_chain_a_star_and_a_cycle(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    cycle = [(-5, -4), (-4, -3), (-3, -5), (7, 7)]
    rows = components(spark.createDataFrame([*chain, *star, *cycle], "a long, b long")).collect()
    labels = {r.node: r.label for r in rows}
    assert len(labels) == len(rows)
    assert {labels[i] for i in range(100, 161)} == {100}
    assert {labels[1000 + i] for i in range(200)} == {1000} and {labels[i] for i in (-5, -4, -3)} == {-5}


def test_documents(spark, odd_texts):
    rng = random.Random(3)
    base = [rng.choice(["the", "of", "und", "la", f"w{rng.randrange(500)}"]) for _ in range(400)]
    texts = [*odd_texts]
    for i in range(25):
        copy = list(base)
        copy[i * 7 % 400] = "changed"
        texts.append(" ".join(copy))
    rows = near_duplicates(documents(spark, texts)).orderBy("doc_id").collect()
    prints = [brute_print(t) for t in texts]
    assert [r.fp % (1 << 64) for r in rows] == prints
    assert [r.component_id for r in rows] == brute_classes(prints, 4)


def test_null_ids_and_repeats(spark):
    docs = documents(spark, ["a b c d e", "a b c d e", None, "x y z q r s"], ids=[None, 8, 9, None])
    found = {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
    assert found == {(None, 8), (8, 8), (9, 9), (None, None)}


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
