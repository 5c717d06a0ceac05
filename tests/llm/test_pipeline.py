from __future__ import annotations

import hashlib
import random

import public_tokenizers
import tiktoken
import base64

import corpus_pipeline
from riskweave.llm.simhash import simhash
from tests.llm.conftest import documents
from tests.llm.test_passages import expected

WORDS = [f"{a}{b}" for a in ("the", "of", "land", "house", "river") for b in ("", "s", "er", "ing", "ly", "ful")]


def text(i, n=60):
    return " ".join(WORDS[(i * 31 + j * j * 7 + j * i) % len(WORDS)] + ("" if j % 9 else str(i)) for j in range(n))


def run_stages(spark, docs, tmp_path):
    """Each stage's rows, from what the one before wrote."""
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        out.append(spark.read.parquet(f"{tmp_path}/{name}"))
    return out


def test_stages_act_on_what_their_predecessor_kept(spark, tmp_path):
    texts = [text(i) for i in range(60)]
    shared = "one shared passage that several of the documents have " + " ".join(f"and part {i}" for i in range(20))
    texts += [f"{shared}\n{text(100 + i)}" for i in range(5)]
    texts += [texts[3], texts[3], texts[4] + " end", None, "", "12 34 !!"]
    docs = documents(spark, texts, lang=["en"] * len(texts), source=["ab"[i % 2] for i in range(len(texts))])
    raw, known, single, cut, mixed, encoded = run_stages(spark, docs, tmp_path)
    for stage in (known, single, cut, mixed):
        assert stage.columns == docs.columns

    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(known) == list(range(68))
    prints = [simhash(t.encode(), 4) for t in texts[:68]]
    kept = ids(single)
    assert len(kept) == len(set(kept)) and {65, 66}.isdisjoint(kept) and 3 in kept
    for i in range(68):
        assert i in kept or any((prints[i] ^ prints[j]).bit_count() <= 4 for j in range(i))
    rows = {r.doc_id: r for r in cut.collect()}
    assert sorted(rows) == kept
    walked = {i: r[0] for i, r in zip(kept, expected([texts[i] for i in kept], 20), strict=True)}
    assert any(walked[i] != texts[i] for i in kept)
    for i in kept:
        assert (rows[i].text, rows[i].n_chars, rows[i].td1) == (walked[i], len(walked[i]), f"x{i}")
    copies = ids(mixed)
    assert set(copies) <= set(kept) and all(r.text == rows[r.doc_id].text for r in mixed.collect())
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert ids(encoded) == copies
    for r in encoded.collect():
        assert r.ids == reference.encode_ordinary(rows[r.doc_id].text)
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest()


def test_odd_rows_pass_every_stage(spark, tmp_path, odd_texts):
    ids = [None if i % 5 == 0 else i // 2 for i in range(len(odd_texts))]
    docs = documents(spark, odd_texts, lang=["en", None, "de"] * 5 + ["en"], ids=ids)
    *stages, encoded = run_stages(spark, docs, tmp_path)
    assert all(s.columns == docs.columns for s in stages) and encoded.count() > 0
    assert "the same text twice over" in {r.text for r in stages[2].collect()}


def test_repeated_rows_of_one_document_become_one(spark, tmp_path):
    docs = documents(spark, [text(1)] * 4, lang=["en"] * 4, ids=[4, 4, 4, None])
    stages = run_stages(spark, docs, tmp_path)
    assert [r.doc_id for r in stages[2].collect()] == [4]


def test_empty_table(spark, tmp_path):
    assert run_stages(spark, documents(spark, []), tmp_path)[-1].count() == 0


def test_other_scripts_and_noise_have_no_recognised_language(spark):
    rng = random.Random(8)
    clean = [text(i) for i in range(60)]
    foreign = ["Широкая электрификация южных губерний даст мощный толчок " * 4, "私は昨日東京へ行きました。とても楽しかったです。" * 4]
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)), "zxqv kjwq xzzk qvjx wkqz " * 12]
    texts = [*clean, *foreign, *noise]
    kept = corpus_pipeline.language_id(spark, documents(spark, texts, lang=["en"] * 60 + [None] * 4), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
