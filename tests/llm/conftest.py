from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, td1 string, k int, taken string"


def documents(spark, texts, lang=None, source=None, ids=None):
    """Documents with columns whose names the operators use themselves."""
    rows = []
    for i, text in enumerate(texts):
        rows.append(
            (
                i if ids is None else ids[i],
                text,
                lang[i] if lang else None,
                source[i] if source else None,
                None if text is None else len(text),
                f"x{i}",
                i,
                None,
            )
        )
    return spark.createDataFrame(rows, SCHEMA)


# Nulls, nothing but white space, characters of one to four bytes, controls,
# repeats and lines that several texts share.
ODD = [
    None,
    "",
    " \t\n\r\x0b\x0c ",
    "é中😀‍ ́x y z",
    "a\x00b \x1c\x85 c",
    "Shared line of seven words, no less\nown one here with enough words too",
    "another start of a text of some words\nshared  LINE of seven words, no less",
    "Shared line of seven words, no less\nShared line of seven words, no less",
    "short\nshort\nshort",
    "it's we're they'll I'd he'S 'tis 123 45.6",
    "the same text twice over",
    "the same text twice over",
    "word " * 3000,
    "ü" * 500,
]


@pytest.fixture(scope="session")
def odd_texts():
    rng = random.Random(7)
    words = ["alpha", "Beta", "gamma,", "the", "of", "über", "naïve", "x1", "—", "fin."]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return [*ODD, long, long[:-7] + " other end"]


def columns(df, *names):
    """Rows of the named columns as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
