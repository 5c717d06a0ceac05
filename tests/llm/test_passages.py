from __future__ import annotations

import hashlib
import random
import re

from riskweave.llm.passages import dedup_passages
from tests.llm.conftest import documents

TOKEN = re.compile(r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*")


def broken(text):
    """Lists of (word, start, end with white space behind it), one for each line."""
    lines, line, before = [], [], ""
    for m in TOKEN.finditer(text):
        word = m[1].lower()
        line.append((word, m.start(), m.end()))
        first, second = (int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in (before, word))
        if (3 * first + second) % 8 == 0:
            lines.append(line)
            line = []
        before = word
    return lines + [line] * bool(line)


def expected(texts, min_words):
    """Texts in rank order to (kept text, spans, lines, lines cut) by walking over all lines."""
    seen, out = set(), []
    for text in texts:
        lines = broken(text or "")
        again = []
        for line in lines:
            words = tuple(w for w, _, _ in line)
            again.append(words in seen)
            seen.add(words)
        spans, n, i = [], 0, 0
        while i < len(lines):
            j = i
            while j < len(lines) and again[j]:
                j += 1
            if j > i and sum(map(len, lines[i:j])) >= min_words:
                spans.append((lines[i][0][1], lines[j - 1][-1][2]))
                n += j - i
            i = max(j, i + 1)
        kept, at = "", 0
        for a, b in spans:
            kept, at = kept + text[at:a], b
        out.append((None if text is None else kept + text[at:], spans, len(lines), n))
    return out


def found(spark, texts, **options):
    docs = documents(spark, texts, ids=options.pop("ids", None))
    rows = dedup_passages(docs, **options).orderBy("doc_id").collect()
    return [(r.kept_text, list(zip(r.removed_starts, r.removed_ends, strict=True)), r.n_units, r.n_removed) for r in rows]


def prose(rng, n):
    return [rng.choice("the of and to in Über a that was it for on are as with his they at".split()) + str(rng.randrange(200)) for _ in range(n)]


def test_against_a_walk_over_all_lines(spark, odd_texts):
    texts = [t for i, t in enumerate(odd_texts) if t is None or t not in odd_texts[:i]]
    for min_words in (1, 20):
        assert found(spark, texts, min_words=min_words) == expected(texts, min_words)


def test_passages_inside_lines_go_and_the_rest_stays(spark):
    rng = random.Random(2)
    passage = prose(rng, 60)
    texts = []
    for i in range(40):
        own = prose(rng, 300)
        at = rng.randrange(300)
        shown = [w.upper() if i % 2 else w for w in passage]
        texts.append(" ".join(own[:at]) + "\n " + "  ".join(shown if i % 4 else ()) + "\t" + " ".join(own[at:]))
    got = found(spark, texts)
    assert got == expected(texts, 20)
    with_passage = [i for i in range(40) if i % 4]
    assert all(not got[i][1] for i in range(40) if i % 4 == 0 or i == with_passage[0])
    assert all(got[i][1] and len(got[i][0].split()) < 330 for i in with_passage[1:])


def test_rows_equal_in_id_and_text_are_one_document_and_null_ids_rank_last(spark):
    text = " ".join(prose(random.Random(4), 50))
    docs = documents(spark, [text, text, text, text, None], ids=[4, 4, 5, None, 6])
    rows = sorted((-1 if r.doc_id is None else r.doc_id, r.n_removed, r.kept_text or "") for r in dedup_passages(docs).collect())
    assert [r[0] for r in rows] == [-1, 4, 4, 5, 6]
    assert [r[1] > 0 for r in rows] == [True, False, False, True, False]
    assert rows[0][2] == rows[3][2] == "" and rows[1][2] == text


def test_carried_columns_keep_their_names(spark):
    docs = documents(spark, ["a b c", None])
    row = dedup_passages(docs, carry=tuple(docs.columns)).where("doc_id = 0").first()
    assert row.carried.td1 == "x0" and row.carried.n_chars == 5 and row.kept_text == "a b c"


def test_a_line_in_a_third_of_all_rows_and_an_empty_table(spark):
    rng = random.Random(6)
    common = " ".join(prose(rng, 40))
    texts = [(common if i % 3 else "") + " " + " ".join(prose(rng, 12)) for i in range(300)]
    assert found(spark, texts) == expected(texts, 20)
    assert dedup_passages(documents(spark, [])).count() == 0


def test_words_beyond_those_kept_break_alike(spark, monkeypatch):
    import riskweave.llm.passages as passages

    words = prose(random.Random(9), 500)
    whole = passages.break_lines(words, passages._Hashes())
    monkeypatch.setattr(passages, "KNOWN", 3)
    assert passages.break_lines(words, passages._Hashes()).tolist() == whole.tolist()
    assert 6 < len(words) / len(whole) < 11
