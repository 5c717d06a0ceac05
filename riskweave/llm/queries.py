"""The operators as queries over whole tables, with SQL where it can express them."""

from __future__ import annotations

import zlib

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.bpe import encode_documents
from riskweave.llm.divergence import judge
from riskweave.llm.mixing import mix_sources
from riskweave.llm.packing import pack_shards
from riskweave.llm.passages import dedup_passages
from riskweave.llm.periodic import find_periodic_runs
from riskweave.llm.personal import BASE, find_personal_data
from riskweave.llm.ppm import identify_languages
from riskweave.llm.simhash import near_duplicates
from riskweave.llm.spelling import count_words, variant_groups
from riskweave.llm.suffixes import dedup_substrings
from riskweave.llm.text import WORD
from riskweave.llm.token_store import read_back, write_store
from riskweave.llm.topk import quantised, top_k
from riskweave.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_passages(_table(spark, sf_dir, "documents"), min_words=20)
    spans = F.zip_with("removed_starts", "removed_ends", lambda a, b: F.concat_ws("-", a, b))
    return cut.select(
        "doc_id", "n_units", "n_removed", F.concat_ws(",", spans).alias("removed_spans"), F.col("kept_text").alias("text")
    )


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "tokens")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return read_back(*write_store(_table(spark, sf_dir, "documents"), root, vocabulary, end_id=2))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(_table(spark, sf_dir, "embeddings"), scale=64.0)
    return top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = pack_shards(_table(spark, sf_dir, "documents"))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


def op5_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(_table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_substrings(_table(spark, sf_dir, "documents"), length=100, whole=False)
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256"
    )


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256")
    return encode_documents(_table(spark, sf_dir, "documents"), ranks, outputs)


def _slipped(doc_id: int | None, run: str) -> str:
    """The run without one code point where 97 divides its hash; a null id is hashed as nothing."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % 97:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_words(_table(spark, sf_dir, "documents"), _slipped, shortest=5, least=3)
    return variant_groups(counts, ratio=2).select("word", "n", "n_near", "form", "form_n", "root")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_table(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    counts = [F.expr(f"cast(size(filter(found, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def _looped(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by hash, repeats words from some place on; a null id is none of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h"))
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    docs = docs.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    a, p = F.col("a").cast("int"), F.col("p").cast("int")
    places = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
    looped = F.array_join(F.transform(places, lambda i: F.get("words", i)), " ")
    return docs.select("doc_id", F.when(F.col("n") > 0, looped).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_periodic_runs(_looped(_table(spark, sf_dir, "documents")), least=12)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", "collapsed", "runs", longest.alias("m"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("m.col2")).alias("start"),
        F.col("m.length").alias("length"),
        (-F.col("m.col3")).alias("period"),
        F.expr("(1000 * m.length) div (-m.col3)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_store": op2_token_store,
    "op3_topk_search": op3_topk_search,
    "op4_sharding": op4_sharding,
    "op5_quality_divergence": op5_quality_divergence,
    "op6_mixing": op6_mixing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_language_id": op9_language_id,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_personal_data": op12_personal_data,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}

ORACLE_SQL = {
    "op1_substring_dedup": r"""
WITH tokens AS (
  SELECT doc_id, length(text) - length(ltrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS lead,
    unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*')) AS token,
    unnest(range(0, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*')))) AS i
  FROM documents
), words AS (
  SELECT doc_id, i, token, lower(regexp_extract(token, '[^\x20\x09-\x0D]+')) AS w,
    CAST(lead + coalesce(sum(length(token)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM tokens
), hashed AS (
  SELECT *, CAST('0x' || left(md5(w), 7) AS BIGINT) AS h, CAST('0x' || left(md5(''), 7) AS BIGINT) AS none FROM words
), marked AS (
  SELECT *, (3 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), none) + h) % 8 = 0 AS ends FROM hashed
), numbered AS (
  SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line
  FROM marked
), lines AS (
  SELECT doc_id, line, count(*) AS n, min(start) AS start, max(start + length(token)) AS stop,
    string_agg(w, ' ' ORDER BY i) AS norm, string_agg(token, '' ORDER BY i) AS whole
  FROM numbered GROUP BY doc_id, line
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, line) > 1 AS again FROM lines
), runs AS (
  SELECT *, line - row_number() OVER (PARTITION BY doc_id, again ORDER BY line) AS run FROM ranked
), judged AS (
  SELECT *, again AND sum(n) OVER (PARTITION BY doc_id, again, run) >= 20 AS cut FROM runs
), spans AS (
  SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed
  FROM (SELECT doc_id, min(start) AS a, max(stop) AS b FROM judged WHERE cut GROUP BY doc_id, run) GROUP BY doc_id
), kept AS (
  SELECT doc_id, count(*) AS n_units, CAST(count(*) FILTER (cut) AS BIGINT) AS n_removed,
    coalesce(string_agg(whole, '' ORDER BY line) FILTER (NOT cut), '') AS tail
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed_spans,
  left(text, CAST(length(text) - length(ltrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS BIGINT)) || coalesce(tail, '') AS text
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN spans s USING (doc_id)
""",
    "op3_topk_search": """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
""",
    "op5_quality_divergence": r"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), placed AS (
  SELECT doc_id, unnest(words) AS w, unnest(range(0, len(words))) AS i FROM docs
), windows AS (
  SELECT doc_id, i, w, lead(w) OVER d AS w2, lead(w, 2) OVER d AS w3 FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w2, w3) > 1 AND w3 IS NOT NULL AS hit FROM windows
), covered AS (
  SELECT doc_id, hit OR coalesce(lag(hit) OVER d, false) OR coalesce(lag(hit, 2) OVER d, false) AS c
  FROM twice WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), repeats AS (
  SELECT doc_id, count(*) AS n FROM covered WHERE c GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), classes AS (
  SELECT doc_id, lang, text, [
    len(regexp_extract_all(text, '[a-z]')), len(regexp_extract_all(text, '[A-Z]')), len(regexp_extract_all(text, '[0-9]')),
    len(regexp_extract_all(text, '[\x20\x09-\x0D]')), len(regexp_extract_all(text, '[.,;:!?''"()\-]')),
    len(regexp_extract_all(text, '[\x{C0}-\x{24F}]')), len(regexp_extract_all(text, '[^\x00-\x7F\x{C0}-\x{24F}]'))] AS found
  FROM docs
), class_counts AS (
  SELECT doc_id, lang, unnest(list_append(found, length(text) - list_sum(found))) AS c, unnest(range(0, 8)) AS class, length(text) AS size
  FROM classes
), class_reference AS (
  SELECT lang, class, sum(c) / greatest(1, sum(sum(c)) OVER (PARTITION BY lang)) AS q
  FROM class_counts WHERE lang IS NOT NULL GROUP BY lang, class
), chars AS (
  SELECT doc_id, r.lang, round(sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)), 9) AS d
  FROM (SELECT doc_id, class, c / greatest(size, 1) AS p FROM class_counts) JOIN class_reference r USING (class)
  GROUP BY doc_id, r.lang
), lowered AS (
  SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+')) AS w FROM docs
), sizes AS (
  SELECT lang, sum(len(words)) AS n FROM docs WHERE lang IS NOT NULL GROUP BY lang
), word_reference AS (
  SELECT lang, w, c / n AS q FROM (SELECT lang, w, count(*) AS c FROM lowered WHERE lang IS NOT NULL GROUP BY lang, w)
  JOIN sizes USING (lang) WHERE c * 2000 >= n
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY c DESC, w) <= 64
), shares AS (
  SELECT doc_id, w, count(*) / any_value(len(words)) AS p FROM lowered JOIN docs USING (doc_id) GROUP BY doc_id, w
), here AS (
  SELECT doc_id, r.lang, sum(p * log2(2 * p / (p + q)) + q * log2(2 * q / (p + q))) AS f, sum(p) AS p, sum(q) AS q
  FROM shares JOIN word_reference r USING (w) GROUP BY doc_id, r.lang
), word_sums AS (
  SELECT d.doc_id, t.lang, coalesce(f, 0) AS f, coalesce(h.q, 0) AS q, t.q AS whole,
    greatest(1 - coalesce(h.p, 0), 0) AS p0, greatest(1 - t.q, 0) AS q0
  FROM docs d CROSS JOIN (SELECT s.lang, coalesce(sum(q), 0) AS q FROM sizes s LEFT JOIN word_reference USING (lang) GROUP BY s.lang) t
  LEFT JOIN here h ON h.doc_id = d.doc_id AND h.lang = t.lang
), near_words AS (
  SELECT doc_id, lang, round(sqrt(greatest(0, (f + whole - q + CASE WHEN p0 > 0 THEN p0 * log2(2 * p0 / (p0 + q0)) ELSE 0 END
    + CASE WHEN q0 > 0 THEN q0 * log2(2 * q0 / (p0 + q0)) ELSE 0 END) / 2)), 9) AS d
  FROM word_sums
), near AS (
  SELECT doc_id, bool_or((length(text) < 200 OR c.d <= 0.255) AND (len(words) < 50 OR x.d <= 0.49)) AS near
  FROM docs JOIN chars c USING (doc_id) JOIN near_words x USING (doc_id)
  WHERE c.lang = x.lang GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(text) - len(regexp_extract_all(text, '[\x20\x09-\x0D]')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)
)
SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(near, true) AS kept
FROM base LEFT JOIN near USING (doc_id)
""",
}
