from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskweave.llm.token_store import PerfectHash, TokenStore, WordEncoder, locate, read_back, write_store
from riskweave.session import scratch_path
from tests.llm.conftest import documents

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(FILE, 2, 50)


@settings(max_examples=600, deadline=None)
@given(text=st.text(st.sampled_from("abstmrevldAÉéßñİΣσſK'’ \n\t.,!?;:12é́中ª²Ⅷ😀\x1c\x85\xa0"), max_size=30))
def test_words_give_the_ids_of_the_whole_text(tokenizer, encoder, text):
    ids = np.frombuffer(encoder.encode([text.encode()])[0], encoder.dtype).tolist()
    assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize(
    "text",
    [
        "a <|endoftext|> b<|startoftext|>", "<|ENDOFTEXT|> <|EndOfText|>", "x<|endoftext|>,", "<|endoftext|><|endoftext|>.", "<|Endoftext", "<| Ab |>",
        "Ab<|startoftext|>Cd!?", "<|endoftext|>é,", "don't, won't! 12, 3.5; é! n'T. #, a#,! ª. 中, x́. Ａb",
    ],
)
def test_special_strings_and_marks_are_as_the_plain_tokenizer_has_them(tokenizer, encoder, text):
    ids = np.frombuffer(encoder.encode([text.encode()])[0], encoder.dtype).tolist()
    assert ids[:-1] == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 40_000])
def test_perfect_hash_is_minimal_and_survives_a_round_trip(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64) - (1 << 39)
    data = PerfectHash.build(keys).dump()
    loaded, end = PerfectHash.load(data + b"records")
    assert end == len(data)
    assert sorted(loaded.slots(keys).tolist()) == list(range(n))


def test_read_back_and_keyed_access(spark, odd_texts, tokenizer):
    texts = [*odd_texts, "under a null id", "second text of id 3"]
    ids = [*range(0, 3 * len(odd_texts), 3), None, 3]
    root = scratch_path(spark, "tokens")
    store, catalog = write_store(
        documents(spark, texts, ids=ids), root, FILE, 2, shard_bytes=20_000, bucket_keys=4, cached_words=20
    )
    found = read_back(store, catalog).collect()
    encoded = {
        (i, zlib.crc32(np.array(e, "<u4").tobytes())): e
        for i, e in ((i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in zip(ids, texts, strict=True))
    }
    assert len(found) == len(texts) and {(r.doc_id, r.ids_crc32) for r in found} == set(encoded)
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert (r.start, r.n_tokens) == (at, len(encoded[r.doc_id, r.ids_crc32]))
        at += r.n_tokens
    keyed = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert keyed[:-1] == sorted(i for i in ids if i is not None) and keyed[-1] is None

    opened = TokenStore.open(store.root)
    assert opened == store
    for doc_id in (0, 9, 27):
        assert opened.get(doc_id).tolist() in [e for (i, _), e in encoded.items() if i == doc_id]
    assert all(opened.get(x) is None for x in (1, 2, -5, 10**15))
    wanted = spark.createDataFrame([(0,), (1,), (None,), (9,)], "doc_id long")
    assert sorted(r.doc_id for r in locate(wanted, opened).collect()) == [0, 9]


def test_empty_table(spark):
    store, catalog = write_store(documents(spark, []), scratch_path(spark, "tokens"), FILE, 2)
    assert read_back(store, catalog).count() == 0 and store.get(1) is None
