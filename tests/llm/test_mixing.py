from __future__ import annotations

import re
from collections import defaultdict

import pytest

from riskweave.llm.mixing import mix_plan, mix_sources, mixed_documents
from tests.llm.conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Water filling by redistribution, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    whole, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = whole - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


def check(texts, sources, rows):
    sizes, taken = defaultdict(int), defaultdict(int)
    for t, s in zip(texts, sources, strict=True):
        sizes[s] += len(WORD.findall(t or ""))
    wanted = targets(sizes)
    for r in rows:
        size = len(WORD.findall(texts[r.doc_id] or ""))
        assert (r.source, r.size, r.source_size) == (sources[r.doc_id], size, sizes[r.source])
        assert r.target == pytest.approx(wanted[r.source])
        assert r.taken == size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    most = {s: max(len(WORD.findall(t or "")) for t, x in zip(texts, sources, strict=True) if x == s) for s in sizes}
    assert all(abs(taken[s] - wanted[s]) <= most[s] for s in sizes), (dict(taken), wanted)


def test_targets_are_met_to_within_a_document(spark):
    texts = ["w " * (1 + i * 7 % 40) for i in range(3000)]
    sources = [("hot" if i % 3 else ["a", "b", "é", "z", "", None][i // 3 % 6]) for i in range(3000)]
    check(texts, sources, mix_sources(documents(spark, texts, source=sources)).collect())


def test_small_sources_stop_at_three_times_their_size(spark):
    texts = ["one two"] * 3 + ["w " * 50] * 200
    sources = ["a"] * 3 + ["b" if i % 2 else "c" for i in range(200)]
    rows = mix_sources(documents(spark, texts, source=sources)).collect()
    check(texts, sources, rows)
    assert all(r.copies == 3 for r in rows if r.source == "a")


def test_odd_texts_and_sources_without_a_word(spark, odd_texts):
    sources = [None if i % 4 == 0 else "empty" if not (t or "").strip() else f"s{i % 3}" for i, t in enumerate(odd_texts)]
    rows = mix_sources(documents(spark, odd_texts, source=sources)).collect()
    check(odd_texts, sources, rows)


def test_reruns_agree_and_equal_rows_go_together(spark):
    texts = [f"some text {i % 50}" for i in range(300)]
    ids, sources = [i % 50 for i in range(300)], ["x" if i % 50 < 40 else "y" for i in range(300)]
    docs = documents(spark, texts, source=sources, ids=ids)
    first, second = (sorted((r.doc_id, r.copies) for r in mix_sources(docs).collect()) for _ in range(2))
    assert first == second and len(set(first)) == 50


def test_documents_are_repeated_as_planned(spark):
    texts, sources = [f"text of row {i}" for i in range(60)], ["abc"[i % 3] for i in range(60)]
    docs = documents(spark, texts, source=sources)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    count = defaultdict(int)
    for r in mixed.collect():
        assert r.td1 == f"x{r.doc_id}"
        count[r.doc_id] += 1
    assert {r.doc_id: r.copies for r in mix_sources(docs).collect() if r.copies} == count


def test_a_larger_budget_keeps_what_a_smaller_one_takes(spark):
    docs = documents(spark, [f"t {i}" for i in range(400)], source=["ab"[i % 2] for i in range(400)])
    taken = []
    for weights in ((1.0, 4.0), (2.0, 3.0), (3.0, 2.0)):
        rows, plan = mix_plan(docs, weights)
        limit = plan.where("source_key = '=a'").first()
        taken.append((limit.whole, limit.threshold))
    assert taken == sorted(taken)


def test_empty_table(spark):
    assert mix_sources(documents(spark, [])).count() == 0
    assert mixed_documents(documents(spark, [])).count() == 0
