from __future__ import annotations

import re

import pytest

from riskweave.llm.lines import dedup_units
from tests.llm.conftest import documents


def expected(rows, separator, min_words):
    """(id, text) in rank order to kept text, by walking over all units."""
    seen, out = set(), []
    for _, text in rows:
        if text is None:
            out.append(None)
            continue
        kept = []
        for unit in text.split(separator):
            norm = " ".join(re.findall(r"[^\x20\x09-\x0D]+", unit.lower()))
            if len(norm.split(" ")) >= min_words and norm and norm in seen:
                continue
            seen.add(norm)
            kept.append(unit)
        out.append(separator.join(kept))
    return out


@pytest.mark.parametrize(("unit", "separator"), [("line", "\n"), ("paragraph", "\n\n")])
@pytest.mark.parametrize("min_words", [1, 5])
def test_against_a_walk_over_all_units(spark, odd_texts, unit, separator, min_words):
    texts = [t for i, t in enumerate(odd_texts) if t is None or t not in odd_texts[:i]] + ["p q r s t\n\nu v w x y\n\np q R s  t"]
    found = dedup_units(documents(spark, texts), unit, min_words).orderBy("doc_id").collect()
    assert [r.kept_text for r in found] == expected(list(enumerate(texts)), separator, min_words)
    for r in found:
        assert r.n_removed == len(r.removed_starts) == len(r.removed_ends)
        if r.text is None:
            assert r.n_units == 0
            continue
        spans = [r.text[a:b] for a, b in zip(r.removed_starts, r.removed_ends, strict=True)]
        assert r.n_units == len(r.text.split(separator))
        assert all(separator not in s for s in spans)
        assert len(r.text) - len(r.kept_text) in (
            sum(len(s) + len(separator) for s in spans),
            sum(len(s) + len(separator) for s in spans) - len(separator),
        )


def test_rows_equal_in_id_and_text_are_one_document(spark):
    line = "one line of five words"
    docs = documents(spark, [line, line, line, None], ids=[4, 4, 5, None])
    found = sorted((r.doc_id or -1, r.kept_text or "") for r in dedup_units(docs).collect())
    assert found == [(-1, ""), (4, line), (4, line), (5, "")]


def test_null_ids_rank_last_and_carried_columns_keep_their_names(spark):
    line = "one line of five words"
    docs = documents(spark, [line, line], ids=[None, 9])
    found = {r.doc_id: r for r in dedup_units(docs, carry=tuple(docs.columns)).collect()}
    assert (found[None].kept_text, found[9].kept_text) == ("", line)
    assert found[9].carried.td1 == "x1" and found[9].carried.n_chars == len(line)


def test_a_unit_in_a_third_of_all_rows(spark):
    texts = [f"the common line of all texts\nown line number {i} of this text" for i in range(400)]
    found = dedup_units(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r.n_removed for r in found] == [0] + [1] * 399


def test_empty_table(spark):
    assert dedup_units(documents(spark, [])).count() == 0
