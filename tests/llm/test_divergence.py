from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from riskweave.llm.divergence import base_counts, divergences, judge, references, with_classes
from tests.llm.conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASSES = [r"[A-Z]", r"[0-9]", r"[.,;:!?'\"()\-]", r"[\u00C0-\u024F]", r"[^\x00-\x7F\u00C0-\u024F]"]


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def distance(p, q):
    keys = set(p) | set(q)
    m = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in keys}

    def part(a):
        return sum(x * math.log2(x / m[k]) for k, x in a.items() if x > 0)

    return math.sqrt(max(0, part(p) + part(q)) / 2)


def brute_distances(text, reference):
    text = text or ""
    found = [len(re.findall(c, text)) for c in ("[a-z]", r"[\x20\x09-\x0D]", *CLASSES)]
    found.insert(2, len(text) - sum(found))
    chars = distance({i: c / max(1, len(text)) for i, c in enumerate(found)}, dict(enumerate(reference["classes"])))
    words = WORD.findall(text.lower())
    shares = dict(zip(reference["words"], reference["shares"], strict=True))
    mine = {w: c / len(words) for w, c in Counter(words).items() if w in shares}
    p, q = mine | {None: max(0, 1 - sum(mine.values()))}, shares | {None: max(0, 1 - sum(shares.values()))}
    return chars, distance(p, q)


def test_base_counts(spark, odd_texts):
    texts = [*odd_texts, "a b c a b c x a b", "a a a a", "a b\n\na b\n \n \nc", "#*$%&|<> #", "x y z", "x y"]
    rows = base_counts(with_classes(documents(spark, texts).select("doc_id", "text"))).orderBy("doc_id").collect()
    mine = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows]
    assert mine == [brute_counts(t) for t in texts]


@pytest.fixture(scope="module")
def labelled():
    english = [f"The house of the man and the dog is in the town {i} of the land, and so on." * 6 for i in range(30)]
    german = [f"Das Haus und der Hund sind in der Stadt {i}, und die Männer gehen über die Brücke." * 6 for i in range(30)]
    return [*english, *german], ["en"] * 30 + ["de"] * 30


def test_distances_to_the_references(spark, odd_texts, labelled):
    texts, lang = labelled
    texts, lang = [*texts, *odd_texts], [*lang, *[None] * len(odd_texts)]
    docs = documents(spark, texts, lang=lang)
    learned = references(docs.select("text", "lang"), 12)
    assert [r["lang"] for r in learned] == ["de", "en"]
    for r in learned:
        mine = [t for t, x in zip(texts, lang, strict=True) if x == r["lang"]]
        count = Counter(w for t in mine for w in WORD.findall(t.lower()))
        top = sorted(count, key=lambda w: (-count[w], w.encode()))[:12]
        assert r["words"] == sorted(top) and r["shares"] == [count[w] / sum(count.values()) for w in sorted(top)]
        assert sum(r["classes"]) == pytest.approx(1)
    rows = divergences(base_counts(with_classes(docs.select("doc_id", "text"))), learned).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        for r, d in zip(learned, row.divergences, strict=True):
            assert (d.chars, d.words) == pytest.approx(brute_distances(text, r), abs=3e-8), text


def test_verdicts(spark, labelled):
    texts, lang = labelled
    clean = texts[0]
    junk = ["#$%& " * 100, clean.upper(), " | ".join(f"keyword{i}" for i in range(200)), "too short", None, clean.split(".")[0] * 40]
    docs = documents(spark, [*texts, *junk], lang=[*lang, *["en"] * len(junk)])
    rows = judge(docs).orderBy("doc_id").collect()
    assert not any(r.kept for r in rows[60:])
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in rows)


def test_without_labels_the_base_alone_decides(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = judge(documents(spark, [text, "few words", None])).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [True, False, False]


def test_empty_table(spark):
    assert judge(documents(spark, [])).count() == 0
