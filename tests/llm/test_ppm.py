from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm.ppm import _grams, freeze, held_out, identify_languages, learn
from tests.llm.conftest import documents

ENGLISH = "the house of the man and the dog is in the town of the land and so it goes on with them"
GERMAN = "das haus und der hund sind in der stadt und die leute gehen mit ihnen auf das land hinaus"


def brute_bits(grams, text):
    """Escape method C over suffix contexts, a byte at a time."""
    counts = [defaultdict(Counter) for _ in range(4)]
    for gram, n in grams.items():
        for order in range(4):
            counts[order][gram[3 - order : 3]][gram[3]] += n
    padded, bits = b"\0\0\0" + text.lower(), 0.0
    for i in range(3, len(padded)):
        for order in (3, 2, 1, 0):
            seen = counts[order][padded[i - order : i]]
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if padded[i] in seen:
                bits -= math.log2(seen[padded[i]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_are_those_of_the_context_tree():
    samples = {"en": [ENGLISH, "The cat."], "de": [GERMAN, "Ähnlich"]}
    rows, grams = [], {}
    for lang, texts in samples.items():
        values, n = _grams([t.encode() for t in texts])
        rows += [(lang, int(v), int(c)) for v, c in zip(values, n, strict=True)]
        grams[lang] = {int(v).to_bytes(4, "big"): int(c) for v, c in zip(values, n, strict=True)}
    model = freeze(rows, 10_000)
    texts = [ENGLISH, GERMAN, "", "x", "Zebra über der Stadt 中!", "the the " * 100, "\0\0a"]
    found = model.code_lengths([t.encode() for t in texts])
    for text, bits in zip(texts, found, strict=True):
        expected = [brute_bits(grams[x], text.encode()) for x in model.languages]
        # Contexts that another language knows cost nothing where they are unseen.
        assert bits == pytest.approx(expected, rel=1e-5, abs=1e-3), text


def test_long_texts_are_scored_in_steps(monkeypatch):
    import riskweave.llm.ppm as ppm

    values, n = _grams([ENGLISH.encode()])
    model = freeze([("en", int(v), int(c)) for v, c in zip(values, n, strict=True)], 500)
    texts = [b"", ENGLISH.encode() * 30, b"", b"abc", GERMAN.encode() * 7, b""]
    whole = model.code_lengths(texts)
    monkeypatch.setattr(ppm, "STEP", 61)
    assert np.allclose(model.code_lengths(texts), whole, rtol=1e-6)


def test_held_out_follows_the_crc(spark):
    rows = spark.range(-50, 200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_predictions(spark, odd_texts):
    english, german = ENGLISH.split(), GERMAN.split()
    rng = np.random.default_rng(5)
    texts, lang = [], []
    for i in range(120):
        texts.append(" ".join(rng.choice(english if i % 2 else german, 30)))
        lang.append("en" if i % 2 else "de")
    texts += [*odd_texts, "123 !!", "  "]
    lang += [None] * (len(odd_texts) + 2)
    rows = identify_languages(documents(spark, texts, lang=lang), rows_per_language=20).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows[:120]] == lang[:120]
    for r, text in zip(rows[120:], texts[120:], strict=True):
        has_letter = text is not None and any(c.isalpha() for c in text)
        assert (r.lang_pred in ("de", "en")) == has_letter and (has_letter or (r.lang_pred, r.score) == ("und", 0.0))
        assert 0 <= r.score <= 1


def test_labels_of_held_out_documents_are_not_learned(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2][:30]
    docs = documents(spark, [ENGLISH] * 30, lang=["en"] * 30, ids=ids)
    assert {r.lang_pred for r in identify_languages(docs).collect()} == {"und"}


def test_nothing_labelled_and_empty_table(spark):
    assert [r.lang_pred for r in identify_languages(documents(spark, [ENGLISH, None])).collect()] == ["und"] * 2
    assert identify_languages(documents(spark, [])).count() == 0


def test_copies_do_not_shrink_the_sample(spark):
    rows = [(f"{ENGLISH} {i}", "en") for i in range(40)] + [(f"{GERMAN} {i}", "de") for i in range(40)]
    texts = spark.createDataFrame(rows, "text string, lang string")
    copies = spark.range(40_000).select(F.lit("one text that is copied").alias("text"), F.lit("en").alias("lang"))
    once = learn(texts.unionByName(copies.limit(1)), rows_per_language=4)
    often = learn(texts.unionByName(copies), rows_per_language=4)
    assert often.languages == once.languages == ["de", "en"]
    assert np.array_equal(often.cost, once.cost)


def test_surprise_tells_other_scripts_and_noise(spark):
    texts = [f"{ENGLISH} {i}" for i in range(40)] + [f"{GERMAN} {i}" for i in range(40)]
    odd = ["Съешь же ещё этих мягких французских булок " * 4, "いろはにほへとちりぬるを" * 8, "zxqv kjwq xzzk qvjx " * 9, None, "12", "x"]
    docs = documents(spark, texts + odd, lang=["en"] * 40 + ["de"] * 40 + [None] * len(odd))
    rows = identify_languages(docs).orderBy("doc_id").collect()
    assert all(r.surprise < 1.5 for r in rows[:80])
    assert all(r.surprise > 4 for r in rows[80:83])
    assert [r.surprise for r in rows[83:]] == [None, None, 0.0]


def test_the_learned_rate_is_the_mean_code_length():
    values, n = _grams([ENGLISH.encode()])
    model = freeze([("en", int(v), int(c)) for v, c in zip(values, n, strict=True)], 10_000)
    assert model.rate == pytest.approx(model.code_lengths([ENGLISH.encode()])[0] / len(ENGLISH), rel=1e-6)
