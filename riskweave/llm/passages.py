"""Substring deduplication by hashing lines whose ends the words themselves choose.

Passages that documents share seldom begin and end with a line of the text. So
the text is first broken into lines anew: a line ends after every word whose
hash and that of the word before it fulfil a condition. Equal passages break at equal
words wherever they stand, so all lines but those at their ends are equal.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from riskweave.llm.lines import HOT_SHARE
from riskweave.llm.text import WORD, digest, keyed, same_document, slices
from riskweave.session import materialize

WORDS = re.compile(WORD)
# Texts that are broken at once, and words whose hashes are kept.
AT_ONCE = 1 << 20
KNOWN = 200_000

# A line ends after a word if this many times the hash of the word before it,
# plus its own, is a multiple of EVERY: after 8 words on average.
FACTOR = 3
EVERY = 8


def word_hash(word: str) -> int:
    """28 bits of the word's MD5, which SQL has too."""
    return int(hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()[:7], 16)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = value = word_hash(word)
        return value


def break_lines(words: list[str], hashes: _Hashes) -> np.ndarray:
    """Numbers of the words behind each line; before the first word stands the empty one."""
    if not words:
        return np.zeros(0, np.int64)
    own = np.fromiter(map(hashes.__getitem__, words), np.int64, len(words))
    before = np.concatenate(([hashes[""]], own[:-1]))
    ends = np.flatnonzero((FACTOR * before + own) % EVERY == 0) + 1
    return ends if len(ends) and ends[-1] == len(words) else np.append(ends, len(words))


def _broken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its lines: two halves of a digest, number of the first word, words."""
    hashes = _Hashes()
    for batch in slices(batches, "text", AT_ONCE):
        counts, firsts, sizes, digests = [], [], [], []
        for text in batch["text"].to_pylist():
            words = WORDS.findall((text or "").lower())
            ends = break_lines(words, hashes)
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            counts.append(len(ends))
            firsts.append(starts)
            sizes.append(ends - starts)
            for first, end in zip(starts.tolist(), ends.tolist(), strict=True):
                digests.append(hashlib.blake2b(" ".join(words[first:end]).encode(), digest_size=16).digest())
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        columns = [halves[:, 0].copy(), halves[:, 1].copy(), *(np.concatenate(x).astype(np.int32) for x in (firsts, sizes))]
        lines = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["ud1", "ud2", "first", "words"])
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        keys = [batch["doc_id"], batch["td1"], batch["td2"]]
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.ListArray.from_arrays(offsets, lines)], names=["doc_id", "td1", "td2", "lines"]
        )


LINES = "array<struct<ud1:bigint,ud2:bigint,first:int,words:int>>"


def dedup_passages(
    docs: DataFrame,
    min_words: int = 20,
    carry: tuple[str, ...] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Cut neighbouring lines of ``min_words`` words or more together that earlier places have.

    Lines are those that the words choose, in lower case with single spaces,
    hashed to 128 bits. Of equal lines the one with the smallest (doc_id, text
    digest, place) is the first. A run of neighbouring lines that are not first
    goes if it has ``min_words`` words; shorter repeats are taken for chance.
    What goes reaches from the run's first word to the next word that stays.

    Per row: ``doc_id``, ``text``, ``n_units`` (lines), ``n_removed`` (lines cut),
    the code point offsets ``removed_starts`` and ``removed_ends`` in the original
    text, and ``kept_text``. A null text has no lines and stays null, an empty
    one has none and stays empty. Rows equal in id and text are one document and
    get one result; a null id ranks last. Other columns are not looked at. An
    empty table gives no rows.

    All lines meet once as half digests and counts, combined before the shuffle,
    and once to find those that repeat; only these go on. The few lines that
    make up a thousandth of all join by broadcast (there are 1,000 at most), so
    no task receives all occurrences of a common one.
    """
    source = keyed(docs, id_col, text_col)
    broken = source.mapInArrow(_broken, f"doc_id bigint, td1 bigint, td2 bigint, lines {LINES}")
    broken = materialize(broken.withColumn("d", F.monotonically_increasing_id()), "broken")
    lines = broken.select("d", F.inline("lines"))

    repeated = lines.groupBy("ud1").agg(F.count("*").alias("times")).where("times > 1")
    repeated = materialize(repeated, "repeated")
    total = broken.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()[0]
    hot = F.broadcast(repeated.where(F.col("times") * HOT_SHARE >= total).select("ud1"))
    rare = repeated.where(F.col("times") * HOT_SHARE < total).select("ud1")
    found = lines.join(hot, "ud1").unionByName(lines.join(hot, "ud1", "left_anti").join(rare, "ud1"))
    found = found.join(broken.select("d", "doc_id", "td1", "td2"), "d")
    found = materialize(found.drop("d"), "found")

    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "td1", "td2", F.col("first").alias("place"))
    origin = materialize(found.groupBy("ud1", "ud2").agg(F.min(rank).alias("origin")), "origin")
    common, others = origin.join(hot, "ud1"), origin.join(hot, "ud1", "left_anti")
    later = (
        found.join(F.broadcast(common), ["ud1", "ud2"])
        .unionByName(found.join(hot, "ud1", "left_anti").join(others, ["ud1", "ud2"]))
        .where(~rank.eqNullSafe(F.col("origin")))
    )
    cuts = later.groupBy("doc_id", "td1", "td2").agg(F.array_sort(F.collect_set(F.struct("first", "words"))).alias("again"))
    words = F.aggregate("again", F.lit(0).cast("long"), lambda sum_, line: sum_ + line["words"])
    cuts = cuts.where(words >= min_words)

    carried = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *digest(F.col(text_col).cast("string"), "t"),
        F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(0).alias("none")]).alias("carried"),
    )
    sizes = broken.groupBy("doc_id", "td1", "td2").agg(F.max(F.size("lines")).cast("long").alias("n_units"))
    about = sizes.alias("n").join(cuts.alias("c"), same_document("n", "c"), "left").select("n.*", "c.again")
    cut = carried.alias("s").join(about.alias("c"), same_document("s", "c"), "left").select("s.*", "c.n_units", "c.again")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", AT_ONCE):
            texts, again = batch["text"].to_pylist(), batch["again"].to_pylist()
            done = zip(*(cut_runs(t, a or (), min_words) for t, a in zip(texts, again, strict=True)), strict=True)
            columns = [pa.array(x, kind) for x, kind in zip(done, ADDED.values(), strict=True)]
            kept = ["doc_id", "text", "carried", "n_units"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *columns], names=[*kept, *ADDED])

    schema = T.StructType(cut.select("doc_id", "text", "carried", "n_units").schema.fields)
    for name, kind in ADDED.items():
        schema.add(name, from_arrow_type(kind))
    cut = cut.mapInArrow(remove, schema)
    return cut if carry else cut.drop("carried")


ADDED = {
    "n_removed": pa.int64(),
    "removed_starts": pa.list_(pa.int64()),
    "removed_ends": pa.list_(pa.int64()),
    "kept_text": pa.string(),
}


def cut_runs(text: str | None, again: list[dict], min_words: int) -> tuple:
    """Lines cut, starts, ends and what stays; ``again`` has the lines that are not first, in order."""
    runs, lines = [], 0
    for line in again:
        if runs and runs[-1][1] == line["first"]:
            runs[-1][1] += line["words"]
            runs[-1][2] += 1
        else:
            runs.append([line["first"], line["first"] + line["words"], 1])
    runs = [r for r in runs if r[1] - r[0] >= min_words]
    if not runs:
        return 0, [], [], text
    places = [m.start() for m in WORDS.finditer(text)]
    places.append(len(text))
    starts, ends, kept, at = [], [], [], 0
    for first, behind, n in runs:
        starts.append(places[first])
        ends.append(places[behind])
        kept.append(text[at : places[first]])
        at = places[behind]
        lines += n
    kept.append(text[at:])
    return lines, starts, ends, "".join(kept)
