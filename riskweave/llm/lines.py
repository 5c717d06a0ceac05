"""Substring deduplication by hashing lines or paragraphs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from riskweave.llm.text import digest, keyed, same_document, slices, word_count
from riskweave.session import materialize

SEPARATOR = {"line": "\n", "paragraph": "\n\n"}

# Units that make up a thousandth of all units or more are at most so many.
HOT_SHARE = 1000

def normalised(unit: Column) -> Column:
    """Lower case, white space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(unit), r"[\x20\x09-\x0D]+", " "))


def dedup_units(
    docs: DataFrame,
    unit: str = "line",
    min_words: int = 5,
    carry: tuple[str, ...] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Cut every line (or paragraph) that an earlier place of the corpus has.

    Units are split at the separator, normalised and hashed to 128 bits. The
    occurrence with the smallest (doc_id, text digest, place) stays, all others
    are cut with the separator after them. Units of fewer than ``min_words``
    words stay always: such lines repeat by chance.

    Per row: ``doc_id``, ``text``, ``n_units``, ``n_removed``, the code point
    offsets ``removed_starts`` and ``removed_ends`` of the cut units in the
    original text, and ``kept_text``. A null text has no units and stays null;
    an empty one has one unit. Rows equal in id and text are one document and
    get one result; a null id ranks last. Other columns are not looked at.

    Only digests are shuffled to find repeats, combined before the shuffle. The
    few units that make up a thousandth of all join by broadcast (there are
    1,000 at most), so no task receives all occurrences of a common line.
    """
    separator = SEPARATOR[unit]
    source = keyed(docs, id_col, text_col)
    units = source.select(
        "doc_id", "td1", "td2", F.posexplode(F.split("text", separator)).alias("place", "unit")
    ).where(word_count(F.col("unit")) >= min_words)
    units = materialize(
        units.select("doc_id", "td1", "td2", "place", *digest(normalised(F.col("unit")), "u")), "units"
    )
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "td1", "td2", "place")
    repeated = units.groupBy("ud1", "ud2").agg(F.min(rank).alias("first"), F.count("*").alias("times"))
    repeated = materialize(repeated.where("times > 1"), "repeated_units")

    hot = repeated.where(F.col("times") * HOT_SHARE >= units.count())
    common = F.broadcast(hot.select("ud1", "ud2", "first"))
    rare = repeated.join(F.broadcast(hot.select("ud1", "ud2")), ["ud1", "ud2"], "left_anti").select("ud1", "ud2", "first")
    rest = units.join(F.broadcast(hot.select("ud1", "ud2")), ["ud1", "ud2"], "left_anti")
    later = units.join(common, ["ud1", "ud2"]).unionByName(rest.join(rare, ["ud1", "ud2"])).where(~rank.eqNullSafe(F.col("first")))
    cuts = later.groupBy("doc_id", "td1", "td2").agg(F.collect_set("place").alias("places"))

    carried = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *digest(F.col(text_col).cast("string"), "t"),
        F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(0).alias("none")]).alias("carried"),
    )
    cut = carried.alias("s").join(cuts.alias("c"), same_document("s", "c"), "left").select("s.*", "c.places")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, places = batch["text"].to_pylist(), batch["places"].to_pylist()
            done = zip(*(_cut(t, set(p or ()), separator) for t, p in zip(texts, places, strict=True)), strict=True)
            columns = [pa.array(x, kind) for x, kind in zip(done, ADDED.values(), strict=True)]
            kept = ["doc_id", "td1", "td2", "text", "carried"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *columns], names=[*kept, *ADDED])

    schema = T.StructType(carried.select("doc_id", "td1", "td2", "text", "carried").schema.fields)
    for name, kind in ADDED.items():
        schema.add(name, from_arrow_type(kind))
    cut = cut.mapInArrow(remove, schema).drop("td1", "td2")
    return cut if carry else cut.drop("carried")


ADDED = {
    "n_units": pa.int64(),
    "n_removed": pa.int64(),
    "removed_starts": pa.list_(pa.int64()),
    "removed_ends": pa.list_(pa.int64()),
    "kept_text": pa.string(),
}


def _cut(text: str | None, places: set[int], separator: str) -> tuple:
    parts = [] if text is None else text.split(separator)
    starts, ends, kept, at = [], [], [], 0
    for place, part in enumerate(parts):
        if place in places:
            starts.append(at)
            ends.append(at + len(part))
        else:
            kept.append(part)
        at += len(part) + len(separator)
    return len(parts), len(starts), starts, ends, None if text is None else separator.join(kept)
