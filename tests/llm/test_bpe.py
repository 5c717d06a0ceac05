from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave.llm.bpe import boundaries, encode, encode_documents, merger, monoid, pieces, scan
from tests.llm.conftest import documents

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merge():
    return merger(FILE, 40)  # small, so that the cache turns over


def ids(reference, text):
    return b",".join(b"%d" % i for i in reference.encode_ordinary(text))


@settings(max_examples=500, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("abstmrevlLd' \n\t\r.,!?12é́‍中٣Ⅷ😀\x1c\x85\xa0　"), max_size=20), max_size=4))
def test_pieces_are_the_matches_of_the_pattern(texts):
    found, per_text = pieces(texts)
    expected = [regex.findall(public_tokenizers.PATTERN, t) for t in texts]
    assert per_text.tolist() == [len(e) for e in expected]
    assert [p.decode() for p in found] == [m for e in expected for m in e]


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=40))
def test_any_text_round_trips(reference, merge, text):
    (encoded,) = encode([text], merge)
    assert encoded == ids(reference, text) and merge.decoded(encoded) == text.encode()


def test_long_pieces(reference, merge):
    rng = random.Random(1)
    for text in ("".join(rng.choices("abcde", k=5000)), "a" * 3000, "=" * 2001, "中文" * 400, "ha" * 60):
        assert next(encode([text], merge)) == ids(reference, text)


def test_scans_compose_in_any_blocking():
    of_symbol, product, _, _ = monoid()
    rng = random.Random(2)
    import numpy as np

    functions = of_symbol[np.array([rng.randrange(len(of_symbol)) for _ in range(5000)])]
    turn, expected = 0, []
    for f in functions:
        turn = product[turn, f]
        expected.append(turn)
    for block in (2, 7, 64, 9000):
        assert scan(functions, block).tolist() == expected


def test_documents(spark, odd_texts, reference):
    docs = documents(spark, odd_texts)
    outputs = ("ids", "token_starts", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")
    for r in encode_documents(docs, FILE, outputs, cached=100).collect():
        text = odd_texts[r.doc_id] or ""
        expected = reference.encode_ordinary(text)
        assert (r.ids, r.n_tokens, bytes(r.decoded)) == (expected, len(expected), text.encode())
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        ends = [*r.token_starts[1:], *[len(text.encode())] * bool(text)]
        tokens = [text.encode()[a:b] for a, b in zip(r.token_starts, ends, strict=True)]
        assert tokens == [reference.decode_single_token_bytes(i) for i in expected]


def test_no_texts(spark):
    assert encode_documents(documents(spark, []), FILE).count() == 0
    assert boundaries([])[1].tolist() == boundaries(["", ""])[1].tolist() == []
