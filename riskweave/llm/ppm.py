"""Language identification by prediction by partial matching on bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.text import digest, slices, text_bytes

UNDETERMINED = "und"

ORDER = 3

PAD = b"\0" * ORDER

# Bits of a text that do not count as surprise: a short text tells little.
SPARED = 64.0

# Bits per byte that a language takes at least. Learned texts that repeat
# themselves take fewer; held against those alone, all others would surprise.
LEAST_RATE = 2.0

# Positions whose costs are looked up at once.
STEP = 1 << 18


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: crc32 of the id as text, modulo 4, is 2."""
    rest = F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def _folded(text: bytes) -> np.ndarray:
    return np.frombuffer(PAD + text.lower(), np.uint8)


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of four bytes (context, next) as integers, with counts."""
    parts = []
    for text in texts:
        b = _folded(text).astype(np.uint32)
        parts.append((b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]) if len(text) else b[:0])
    return np.unique(np.concatenate(parts), return_counts=True)


@dataclass
class Model:
    """Frozen code lengths: ``cost[node, symbol, language]`` in bits.

    ``symbol`` maps bytes to the learned alphabet (0: any other byte), ``node``
    maps three symbols to the longest context that was learned. ``rate`` has the
    bits per byte that each language's model needs for what it learned.
    """

    languages: list[str]
    symbol: np.ndarray
    node: np.ndarray
    cost: np.ndarray
    rate: np.ndarray

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits that each language's model needs for each text."""
        size = self.cost.shape[1]
        bits = np.zeros((len(texts), len(self.languages)))
        flat = self.cost.reshape(-1, len(self.languages))
        buffer = self.symbol[np.frombuffer(b"".join(PAD + t.lower() for t in texts), np.uint8)]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.cumsum(lengths + ORDER) - lengths
        edges = np.unique(np.concatenate([starts, starts + lengths, [ORDER]]))
        for at in range(ORDER, len(buffer), STEP):
            stop = min(len(buffer), at + STEP)
            s = buffer[at - ORDER : stop].astype(np.int32)
            context = (s[:-3] * size + s[1:-2]) * size + s[2:-1]
            costs = flat[self.node[context].astype(np.int32) * size + s[3:]]
            cuts = np.concatenate([[at], edges[np.searchsorted(edges, at, "right") : np.searchsorted(edges, stop)]])
            sums = np.add.reduceat(costs, cuts - at, axis=0, dtype=np.float64)
            # A run between edges is part of the text that starts at or before it, or padding.
            owner = np.searchsorted(starts, cuts, "right") - 1
            inside = (owner >= 0) & (cuts < starts[owner] + lengths[owner])
            np.add.at(bits, owner[inside], sums[inside])
        return bits


def learn(docs: DataFrame, rows_per_language: int = 1024, grams_per_language: int = 1 << 15, contexts: int = 8192) -> Model:
    """Fit on ``docs(text, lang)``: context trees of order three and shorter.

    At most ``rows_per_language`` distinct texts of each language are learned
    from, chosen by hash; of these the most frequent ``grams_per_language``
    strings of four bytes, and of their contexts the ``contexts`` most frequent
    of all languages. So the model's size is bounded by these parameters.
    """
    rows = docs.where("lang is not null and text is not null").select("lang", "text", *digest(F.col("text"), "t"))
    # Copies are drawn together, so the share follows the distinct texts; a row per language.
    texts = rows.select("lang", "td1", "td2").distinct()
    counts = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], np.zeros(256, np.uint8), np.zeros(1, np.uint16), np.zeros((1, 1, 0), np.float32), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4 * rows_per_language / n))])
    drawn = rows.where(F.shiftrightunsigned("td1", 11) < F.element_at(share, F.col("lang")) * float(1 << 53))
    by_hash = Window.partitionBy("lang").orderBy("td1", "td2")
    chosen = drawn.select("lang", "td1", "td2").distinct().withColumn("r", F.row_number().over(by_hash))
    chosen = chosen.where(F.col("r") <= rows_per_language).drop("r")  # rows_per_language times languages
    sample = drawn.join(F.broadcast(chosen), ["lang", "td1", "td2"]).dropDuplicates(["lang", "td1", "td2"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs, texts = np.array(batch["lang"].to_pylist(), object), text_bytes(batch["text"])
            for lang in sorted(set(langs)):
                grams, n = _grams([texts[i] for i in np.flatnonzero(langs == lang)])
                columns = [pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    grams = sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    grams = grams.withColumn("r", F.row_number().over(most)).where(F.col("r") <= grams_per_language)
    return freeze([(r["lang"], r["gram"], r["n"]) for r in grams.collect()], contexts)


def freeze(grams: list[tuple[str, int, int]], contexts: int) -> Model:
    """The code lengths of all symbols in all kept contexts, by escape method C.

    A context that saw n symbols, d of them distinct, codes a symbol seen c
    times with c / (n + d) and escapes to the next shorter context with
    d / (n + d); below order zero all 256 bytes are alike.
    """
    languages = sorted({g[0] for g in grams})
    lang = np.array([languages.index(g[0]) for g in grams])
    gram = np.array([g[1] for g in grams], np.int64)
    n = np.array([g[2] for g in grams], np.float64)
    parts = [gram >> shift & 255 for shift in (24, 16, 8, 0)]
    alphabet = np.unique(np.concatenate(parts))
    symbol = np.zeros(256, np.uint8)
    size = min(len(alphabet), 255) + 1
    symbol[alphabet[: size - 1]] = np.arange(1, size)
    s = [symbol[p].astype(np.int64) for p in parts]
    nexts = s[3]

    parent_cost = np.full((1, size, len(languages)), 8.0)
    parent_of = np.zeros(size**ORDER, np.int64)  # by context: its node of the order before
    blocks: list[np.ndarray] = []
    offset = 0
    node = np.zeros(size**ORDER, np.uint32)
    every = np.arange(size**ORDER)
    for order in range(ORDER + 1):
        context = np.zeros_like(nexts)
        for k in range(ORDER - order, ORDER):
            context = context * size + s[k]
        totals = np.bincount(context, n, size**order)
        kept = np.flatnonzero(totals)
        kept = np.sort(kept[np.argsort(-totals[kept], kind="stable")[:contexts]])
        local = np.full(size**order, -1)
        local[kept] = np.arange(len(kept))
        inside = local[context] >= 0
        seen = np.zeros((len(kept), size, len(languages)))
        np.add.at(seen, (local[context[inside]], nexts[inside], lang[inside]), n[inside])
        total, distinct = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
        shorter = parent_cost[parent_of[kept]] if order else np.repeat(parent_cost, len(kept), axis=0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escaped = shorter - np.log2(distinct / (total + distinct))
            cost = np.where(seen > 0, -np.log2(seen / (total + distinct)), np.where(total > 0, escaped, shorter))
        blocks.append(cost.astype(np.float32))
        # Contexts not kept at this order stay with the node of the order before.
        found = local[every % size**order]
        node = np.where(found >= 0, found + offset, node).astype(np.uint32)
        offset += len(kept)
        parent_cost = np.concatenate([b.astype(np.float64) for b in blocks])
        parent_of = node
        if order < ORDER:
            # A context of the next order finds its parent by its last symbols.
            parent_of = node[np.arange(size ** (order + 1))]
    cost = np.concatenate(blocks)
    own = cost[node[(s[0] * size + s[1]) * size + s[2]], nexts, lang] * n
    rate = np.bincount(lang, own, len(languages)) / np.bincount(lang, n, len(languages))
    return Model(languages, symbol, node, cost, rate)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``td1``, ``td2``, ``lang_pred``, ``score``, ``surprise`` of every row.

    The language whose frozen model codes the whole text in the fewest bits, of
    equals the first by name; the score is its posterior under equal priors. A
    text that is null or has no letter is ``und`` with score 0, as is every text
    if nothing was learned. Only the text is looked at.

    The score only weighs the languages against each other. ``surprise`` holds
    the text against the best of them: its bits, less the first ``SPARED``, over
    the bits that as many bytes of the learned texts take, ``LEAST_RATE`` at least. Texts of the language
    are about 1, other scripts and noise far above; it is null for ``und``.
    """
    text = F.col(text_col).cast("string")
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        *digest(text, "t"),
        F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), text).alias("text"),
    )
    names = np.array([*model.languages, UNDETERMINED], object)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            known = batch["text"].is_valid().to_numpy(zero_copy_only=False) & bool(model.languages)
            best, posterior = np.full(batch.num_rows, len(model.languages)), np.zeros(batch.num_rows)
            surprise = np.full(batch.num_rows, np.nan)
            if known.any():
                texts = [t for t, k in zip(text_bytes(batch["text"]), known, strict=True) if k]
                bits = model.code_lengths(texts)
                usual = np.maximum(model.rate, LEAST_RATE)[bits.argmin(axis=1)] * np.fromiter(map(len, texts), np.float64, len(texts))
                surprise[known] = np.maximum(bits.min(axis=1) - SPARED, 0) / usual
                best[known] = bits.argmin(axis=1)
                posterior[known] = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            columns = [batch["doc_id"], batch["td1"], batch["td2"], pa.array(names[best].tolist(), pa.string()), pa.array(posterior)]
            columns.append(pa.array(surprise, from_pandas=True))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "td1", "td2", "lang_pred", "score", "surprise"])

    return source.mapInArrow(score, "doc_id long, td1 long, td2 long, lang_pred string, score double, surprise double")


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **sizes: int
) -> DataFrame:
    """Learn from the labelled documents that are not held out, then identify all.

    Adds ``held_out`` to what ``identify`` returns. Rows without an id or a
    label are predicted, not learned from.
    """
    doc_id = F.col(id_col).cast("long")
    labelled = docs.where(doc_id.isNotNull() & ~held_out(doc_id)).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    found = identify(docs, learn(labelled, **sizes), id_col, text_col)
    return found.withColumn("held_out", held_out(F.col("doc_id")))
