from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave.llm.suffixes import Suffix, common_prefix, decode_run, dedup_substrings, front_code, merge_runs
from tests.llm.conftest import documents


def expected(rows, length):
    """Per row: bytes, removed, spans, digest, by a set of all strings seen."""
    seen, out = set(), []
    for text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for p in range(len(data) - length + 1):
            string = data[p : p + length]
            if string in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(string)
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        spans = sum(1 for run in bytes(covered).split(b"\0") if run)
        out.append((len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(spark, docs, **kw):
    rows = dedup_substrings(docs, whole=False, **kw).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, len(r.starts), r.kept_sha256) for r in rows]


def corpus(n, seed):
    rng = random.Random(seed)
    words = [bytes(rng.randrange(97, 123) for _ in range(rng.randrange(2, 9))).decode() for _ in range(300)]
    passages = [" ".join(rng.choices(words, k=rng.randrange(5, 40))) for _ in range(20)]
    texts = []
    for _ in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(rng.randrange(1, 5))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        texts.append(rng.choice([" ", "\n", "é"]).join(parts))
    return texts + [t[:-5] + "!" + t for t in texts[::9]] + ["ab" * 400, "z" * 700, "ba" * 300]


SIZES = [{}, {"part_bytes": 5_000, "run_suffixes": 60}, {"part_bytes": 20_000, "run_suffixes": 200, "most_in_group": 4}]


@pytest.mark.parametrize("sizes", SIZES)
@pytest.mark.parametrize("length", [24, 100])
def test_against_all_strings(spark, length, sizes):
    texts = corpus(150, length)
    assert found(spark, documents(spark, texts), length=length, **sizes) == expected(texts, length)


def test_odd_texts(spark, odd_texts):
    texts = [t for i, t in enumerate(odd_texts) if t is None or t not in odd_texts[:i]]
    assert found(spark, documents(spark, texts), length=30, run_suffixes=500) == expected(texts, 30)


def test_equal_rows_are_one_document_and_null_ids_come_last(spark):
    text = "a passage that is longer than thirty bytes, surely"
    docs = documents(spark, [text, text, text, text], ids=[3, 3, None, 5])
    rows = sorted((r.doc_id if r.doc_id is not None else 99, bytes(r.kept).decode()) for r in dedup_substrings(docs, 30).collect())
    assert rows == [(3, text), (3, text), (5, ""), (99, "")]


def test_empty_table(spark):
    assert dedup_substrings(documents(spark, [])).count() == 0


def suffixes(keys):
    return [Suffix(k, len(k) // 2, False, i, 7, i, i) for i, k in enumerate(keys)]


def order(s):
    return s.key, s.right, s.rank


short = st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=40)


@settings(max_examples=200, deadline=None)
@given(runs=st.lists(short, max_size=6))
def test_merged_runs_are_in_order_with_their_common_prefixes(runs):
    tables = [sorted(suffixes(keys), key=order) for keys in runs]
    for table in tables:
        assert [s for _, s in decode_run(front_code(table))] == table
    merged = list(merge_runs([front_code(t) for t in tables if t]))
    assert [s for _, s in merged] == sorted((s for t in tables for s in t), key=order)
    before = b""
    for lcp, s in merged:
        assert lcp == common_prefix(before, s.key) == next(
            (i for i, (a, b) in enumerate(zip(before, s.key, strict=False)) if a != b), min(len(before), len(s.key))
        )
        before = s.key
