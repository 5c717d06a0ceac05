"""The corpus pipeline: from raw documents to token ids.

Documents without a recognised language go, one document of each class of near
duplicates stays, passages that an earlier document has are cut, sources are
mixed to their target weights, and the texts are encoded. Each stage reads what its
predecessor wrote, all of it; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.bpe import encode_documents
from riskweave.llm.mixing import mixed_documents
from riskweave.llm.passages import dedup_passages
from riskweave.llm.ppm import UNDETERMINED, identify_languages
from riskweave.llm.simhash import near_duplicates
from riskweave.llm.text import digest, same_document
from riskweave.session import materialize

# A document is rejected if no learned language reaches this posterior.
MIN_SCORE = 0.3
# Nor if it needs so many times the bits per byte of the learned texts: those of
# the languages stay below 3, noise and other scripts are above 4.
MOST_SURPRISE = 4.0
# Words that neighbouring repeated lines must have to be cut.
MIN_WORDS = 20


def _keyed(docs: DataFrame) -> DataFrame:
    """Whole rows in one column, where no name can clash, and what tells documents apart."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *digest(F.col("text").cast("string"), "t"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; null texts, texts without letters, noise and other languages go."""
    found = identify_languages(docs)
    likely = (F.col("score") >= MIN_SCORE) & (F.col("surprise") <= MOST_SURPRISE)
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & likely)
    kept = kept.select("doc_id", "td1", "td2").alias("k")
    return _keyed(docs).alias("d").join(kept, same_document("d", "k"), "left_semi").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the smallest id, null last, then the smallest text digest.

    Rows that repeat the chosen document are one document: one row stays.
    """
    classes = near_duplicates(docs, shingle=4, radius=4)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "td1", "td2")
    chosen = classes.groupBy("class_fp").agg(F.min(rank).alias("r"))
    chosen = chosen.select("r.doc_id", "r.td1", "r.td2")
    times = classes.groupBy("doc_id", "td1", "td2").agg(F.count("*").alias("times"))
    kept = materialize(times.alias("t").join(chosen.alias("c"), same_document("t", "c"), "left_semi"), "kept").alias("k")
    rows = _keyed(docs).alias("d").join(kept, same_document("d", "k")).select("d.*", "k.times")
    once = rows.where("times = 1")
    repeated = rows.where("times > 1").dropDuplicates(["doc_id", "td1", "td2"])
    return once.unionByName(repeated).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that an earlier place has; lengths follow the texts."""
    cut = dedup_passages(docs, MIN_WORDS, carry=tuple(docs.columns))
    kept = F.col("kept_text")
    changed = {"text": kept, "n_chars": F.length(kept).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": kept}
    return cut.select(*[changed.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, their count, and digests of ids and decoded bytes."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(docs, ranks, ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("byte_bpe", byte_bpe),
]

# Trained models, components and encodings have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
