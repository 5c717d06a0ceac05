from __future__ import annotations

import hashlib
import random
import re

import pytest

from riskweave.llm.personal import BASE, find_personal_data, find_spans, luhn, mod_97
from riskweave.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.conftest import documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and plain_luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def expected(text):
    """The base spans by the patterns as they are written."""
    spans = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        spans += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text or "") if holds(kind, m[0])]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def base(text):
    return [s[:3] for s in find_spans(text) if s[0] in BASE]


CARD = "4539578763621486"
IBAN = "GB82 WEST 1234 5698 7654 32"


@pytest.mark.parametrize(
    "text",
    [
        None, "", "a@b.c", "@b.c", "a@b", "a@@b.c", "a@b.c@d.e", "x..y@-.-", "a@b.c.", "é.a@b.c", "a@b.c%d@e.f",
        "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.0003.255", "1.2.3", "1.2.3.4.5", "9999.1.2.3.4", "1.1.1.256 1.1.1.1",
        CARD, "4539 5787 6362 1486", "4539-5787-6362-1486", "4539  5787 6362 1486", f"{CARD}0", f"0{CARD}", "1" * 40,
        "+1 (555) 010-9999", "+1 555", "+1-555-010-9999-", "+15550109999+15550109999", "++1 555 010 9999", "+1 555 010 9999 88888888",
        f"mail a.b@c.de, call +49 (0) 30 1234567, {CARD} at 10.0.0.1",
    ],
)
def test_base_spans_are_those_of_the_patterns(text):
    assert base(text) == expected(text)


def test_random_texts_against_the_patterns():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("a@.-+ 0123456789()%é\n") for _ in range(rng.randint(0, 80)))
        assert base(text) == expected(text), text


def test_checksums():
    assert luhn(CARD) and not luhn("4539578763621487") and luhn("0")
    assert all(luhn(str(n)) == plain_luhn(str(n)) for n in range(2000))
    assert mod_97("GB82WEST12345698765432") and not mod_97("GB83WEST12345698765432")


def kinds(text):
    return [s[0] for s in find_spans(text)]


def test_added_kinds_need_a_checksum_or_context():
    assert kinds(f"pay to {IBAN} please") == ["iban"]
    assert kinds(f"pay to {IBAN} THANKS") == ["iban"]
    assert kinds("pay to GB83 WEST 1234 5698 7654 32 please") == []
    assert kinds("pay to GB82WEST12345698765432A please") == []
    assert kinds("SSN: 219-09-9999") == ["ssn"] and kinds("part 219-09-9999") == [] and kinds("SSN 000-09-9999") == []
    assert kinds("Tel. 030 123 4567") == ["local_phone"] and kinds("sold 030 123 4567 pieces") == []
    assert kinds("telling 030 123 4567") == []


def test_context_raises_the_score_and_the_threshold_is_a_parameter():
    plain, near = find_spans(f"x {CARD}"), find_spans(f"credit card {CARD}")
    assert plain[0][3] < near[0][3] <= 1
    assert find_spans("SSN 219-09-9999", threshold=0.7) == []
    assert [s[0] for s in find_spans(f"x {CARD}", threshold=2)] == ["card"]


def test_a_span_inside_a_base_span_is_not_listed_again():
    assert kinds("call +1 555 010 9999 now") == ["phone"]
    assert kinds("phone 030 123 4567, +1 555 010 9999, tel 030 123 4567") == ["local_phone", "phone", "local_phone"]


def test_long_texts_take_linear_time(spark):
    texts = ["a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "+1" + "(" * 1_000_000, "a@" * 500_000, "AB12 " * 300_000, "1-" * 500_000, "GB82" + "A" * 10**6]
    found = {r.doc_id: r.found for r in find_personal_data(documents(spark, texts)).collect()}
    assert all(s.kind == "ip" for s in found[2]) and not found[0] and not found[4]


def test_odd_documents(spark, odd_texts):
    texts = [*odd_texts, "a@b.c " * 3, "a@b.c " * 3]
    docs = documents(spark, texts, ids=[None, *range(1, len(texts))])
    found = find_personal_data(docs)
    assert found.columns == ["doc_id", "text", "found"]
    for r in found.collect():
        assert [tuple(s)[:3] for s in r.found if s.kind in BASE] == expected(r.text)
    assert found.count() == len(texts)
    assert find_personal_data(documents(spark, [])).count() == 0


def test_query_against_the_patterns(spark):
    folder = f"{DATA}/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op12_personal_data"](spark, folder).collect()
    assert len(found) == len(docs)
    hits = 0
    for r in found:
        spans = expected(docs[r.doc_id])
        hits += len(spans)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r.spans.split(","))
    assert hits
