"""What the operators on texts share: words, row digests, Arrow slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

SLICE_BYTES = 4 << 20


def word_count(text: Column) -> Column:
    """Words of a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def digest(value: Column, name: str = "") -> list[Column]:
    """128 bits of a value as the longs ``<name>d1`` and ``<name>d2``."""
    return [
        F.xxhash64(value).alias(f"{name}d1"),
        F.xxhash64(F.lit("second half"), value).alias(f"{name}d2"),
    ]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` and the longs ``td1``, ``td2`` that tell texts apart.

    Columns of other names are left out, so none can clash. A document is its
    id and text: rows equal in both are one document that is stored repeatedly.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return named.select("doc_id", "text", *digest(F.col("text"), "t"))


def same_document(left: str, right: str) -> Column:
    """Join condition of two aliased frames made from ``keyed``."""
    return (
        F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))
        & (F.col(f"{left}.td1") == F.col(f"{right}.td1"))
        & (F.col(f"{left}.td2") == F.col(f"{right}.td2"))
    )


def text_bytes(column: pa.Array) -> list[bytes]:
    """A text column's values as UTF-8 bytes, nulls as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold ``limit`` bytes, or one text alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.fromiter(map(len, text_bytes(batch[column])), np.int64, batch.num_rows))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
