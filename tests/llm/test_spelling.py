from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from riskweave.llm.queries import QUERIES
from riskweave.llm.spelling import count_words, roots, trie_nodes, variant_groups
from tests.conftest import DATA
from tests.llm.conftest import documents


def near(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def expected(counts):
    """Rows of all words by comparing each word with every word of about its length."""
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    form, rows = {}, []
    for w, n in counts.items():
        found = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, ()) if near(w, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
        rows.append([w, n, len(found), form[w], counts.get(form[w])])
    for row in rows:
        end = row[0]
        while form[end] is not None:
            end = form[end]
        row.append(end)
    return sorted((tuple(r) for r in rows), key=lambda r: r[0])


def groups(df):
    columns = ("word", "n", "n_near", "form", "form_n", "root")
    return sorted((tuple(r) for r in variant_groups(df).select(*columns).collect()), key=lambda r: r[0])


def frame(spark, counts):
    return spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, id string")


@pytest.mark.parametrize("letters", ["ab", "abcé", "a😀"])
def test_against_all_pairs(spark, letters):
    rng = random.Random(len(letters))
    counts = {}
    for _ in range(300):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))
        counts[word] = rng.choice([3, 3, 4, 6, 7, 12, 13, 30, 100])
    assert groups(frame(spark, counts)) == expected(counts)


def test_ties_long_words_and_chains(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaaba": 6, "aabab": 12, "babab": 24, "babaa": 11, "z" * 3000: 3, "z" * 2999: 6, "z" * 1500 + "y" + "z" * 1499: 6}
    assert groups(frame(spark, counts)) == expected(counts)


def test_one_position_takes_many_letters(spark):
    counts = {f"hou{chr(c)}es": 3 + c % 5 for c in range(0x61, 0x161)} | {"houes": 40}
    assert groups(frame(spark, counts)) == expected(counts)


@pytest.mark.parametrize("reverse", [False, True])
def test_nodes_are_prefixes_also_across_ranges(spark, reverse):
    rng = random.Random(9)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(900)} | {"a" * 40 + "b" * i for i in range(60)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    import riskweave.operators.ordered as ordered

    small, ordered.SMALL_SEGMENT = ordered.SMALL_SEGMENT, 20
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        found = trie_nodes(spark.createDataFrame([(w,) for w in words], "word string"), reverse).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        ordered.SMALL_SEGMENT = small
    numbers = {}
    for r in found:
        key = r.word[::-1] if reverse else r.word
        assert len(r.nodes) == len(key) + 1 and r.nodes[0] == 0
        for i, node in enumerate(r.nodes):
            assert numbers.setdefault(key[:i], node) == node
    assert len(set(numbers.values())) == len(numbers) and len(found) == len(words)
    if not reverse:
        assert [r.word for r in sorted(found, key=lambda r: r.id)] == sorted(words)


def test_roots_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)], "id long, to long")
    assert {r.root for r in roots(links).collect()} == {50}


def test_counts(spark, odd_texts):
    found = {r.word: r.n for r in count_words(documents(spark, odd_texts), shortest=1, least=2).collect()}
    runs = Counter()
    for text in odd_texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            runs["".join(c.lower() if c.isascii() else c for c in run)] += 1
    assert found == {w: n for w, n in runs.items() if n >= 2}


def test_empty_tables_and_words(spark):
    assert groups(count_words(documents(spark, []))) == []
    assert groups(frame(spark, {"": 3})) == [] and groups(spark.createDataFrame([(None, 3)], "word string, n long")) == []
    with pytest.raises(ValueError):
        variant_groups(frame(spark, {"a": 3}), ratio=1)


def test_query_against_all_pairs(spark):
    folder = f"{DATA}/sf0.001"
    counts = Counter()
    for doc_id, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            at = h % len(run)
            counts[run if h % 97 else run[:at] + run[at + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    found = QUERIES["op11_spelling_variants"](spark, folder).select("word", "n", "n_near", "form", "form_n", "root")
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[0]) == expected(counts)
