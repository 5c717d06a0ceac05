"""Groups of spelling variants by a dictionary of pairs of trie nodes.

Prefixes of the words are nodes of a trie, suffixes nodes of the trie of the
reversed words; both are numbered. A word cut at a place is the integer pair
(prefix node, suffix node); a word with one position skipped is the pair on its
two sides. Two words with a skipped pair in common differ in that position, and
a word whose cut is another's skipped pair lacks that position: exactly the
neighbours by one replaced, inserted or deleted code point.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.text import slices
from riskweave.operators.ordered import partitions_for
from riskweave.session import materialize

# Runs of Latin letters, as they are after A-Z became a-z.
RUN = re.compile("[a-zÀ-ÿ]+")


def count_words(
    docs: DataFrame,
    change: Callable[[int | None, str], str] | None = None,
    shortest: int = 5,
    least: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word`` and ``n``, its occurrences, for words of ``shortest`` code points and ``least`` occurrences.

    Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts, A-Z
    in lower case; ``change`` may turn a document's run into another word. A
    null or empty text has none, rows that repeat count again, an empty table
    gives no words. Counts are combined per slice and per task before the
    shuffle, so a word in every text arrives as a few rows of each task.
    """
    named = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            total: Counter[str] = Counter()
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                # bytes.lower() changes A-Z alone.
                runs = RUN.findall((text or "").encode().lower().decode())
                if change is None:
                    total.update(runs)
                    continue
                for run, n in Counter(runs).items():
                    total[change(doc_id, run)] += n
            words = [w for w in total if len(w) >= shortest]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([total[w] for w in words], pa.int64())], names=["word", "n"]
            )

    counts = named.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


def _common(a: str, b: str) -> int:
    """Code points that both words begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def trie_nodes(words: DataFrame, reverse: bool = False) -> DataFrame:
    """``word``, ``id`` and ``nodes`` for a frame of distinct, non-empty words.

    ``nodes`` are the numbers of the trie nodes on the word's path, the root's 0
    first; with ``reverse`` of the trie of reversed words. Equal prefixes have
    equal numbers, others different ones. ``id`` rises with the words' order.

    Words are sorted by ranges; in a range each word only adds the nodes behind
    what it has in common with the word before it. A node that lies on both
    sides of a border between ranges gets its number from the border: its
    prefix is one of the last word before and of the first word behind, the only
    two words of a range that reach the driver.
    """
    spark = words.sparkSession
    key = F.reverse("word") if reverse else F.col("word")
    parts = partitions_for(words, words.count())
    placed = words.select(key.alias("key")).repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id())
    placed = materialize(placed, "trie_words")
    # Root and border nodes aside, a range numbers a node for each code point at most.
    ends = placed.groupBy("part").agg(F.min("key"), F.max("key"), F.sum(F.length("key"))).orderBy("part").collect()

    # Numbers of the prefixes on each border; the same prefix keeps its number over several.
    borders: dict[int, list[int]] = {}
    number, before = 0, None
    for part, first, last, _ in ends:
        if before is not None:
            depth = _common(before[1], first)
            known = borders.get(before[0], [])
            shared = known[: min(_common(before[2], first), len(known), depth)]
            borders[part] = [*shared, *range(number + 1, number + 1 + depth - len(shared))]
            number += depth - len(shared)
        before = (part, last, first)
    starts, at = {}, number
    for part, _, _, size in ends:
        starts[part], at = at, at + size
    behind = {a[0]: (a[2], borders[b[0]]) for a, b in zip(ends, ends[1:], strict=False)}

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, previous, nodes, following = None, "", [0], 0
        for batch in batches:
            keys, ids, paths = batch["key"].to_pylist(), [], []
            for here, word in zip(batch["part"].to_pylist(), keys, strict=True):
                if here != part:
                    part, previous, nodes, following = here, "", [0, *borders.get(here, ())], starts[here]
                    same = len(nodes) - 1
                else:
                    same = _common(previous, word)
                    del nodes[same + 1 :]
                last, numbers = behind.get(part, ("", ()))
                shared = min(_common(word, last), len(numbers))
                ids.append(following)
                if same < shared:
                    nodes += numbers[same:shared]
                    same = shared
                nodes += range(following + 1, following + 1 + len(word) - same)
                following += len(word)
                paths.append(nodes.copy())
                previous = word
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(ids, pa.int64()), pa.array(paths, pa.list_(pa.int64()))],
                names=["key", "id", "nodes"],
            )

    ranges = placed.repartition(parts, "part").sortWithinPartitions("part", "key")
    numbered = ranges.mapInArrow(follow, "key string, id bigint, nodes array<bigint>")
    word = F.reverse("key") if reverse else F.col("key")
    return materialize(numbered.select(word.alias("word"), "id", "nodes"), "trie_nodes")


def _pairs() -> Column:
    """A word's pairs: with each position skipped, and of each cut.

    ``fresh`` marks skipped positions whose code point differs from the one
    before: skipping another one of equal neighbours leaves the same word.
    """
    n = F.size("chars")
    places = F.sequence(F.lit(0), n)
    cut = F.transform(
        places,
        lambda i: F.struct(
            F.get("prefix", i).alias("a"), F.get("suffix", n - i).alias("b"),
            F.lit(False).alias("skip"), F.lit(False).alias("fresh"),
        ),
    )
    skipped = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            F.get("prefix", i).alias("a"), F.get("suffix", n - i - 1).alias("b"), F.lit(True).alias("skip"),
            ((i == 0) | (F.get("chars", i) != F.get("chars", i - 1))).alias("fresh"),
        ),
    )
    return F.concat(cut, skipped)


def near_words(words: DataFrame) -> DataFrame:
    """``id``, ``word``, ``n``, ``n_near`` and ``best`` (-n, id) of each word's near words.

    ``words`` has distinct non-empty words and their counts ``n``. A pair's
    group has a row for each code point that can stand in the gap at most, and
    one word without it, so it is bounded by the alphabet, not by the data; its
    members only take its size and its first two words, never each other.
    """
    prefixes = trie_nodes(words).withColumnRenamed("nodes", "prefix")
    suffixes = trie_nodes(words, reverse=True).select("word", F.col("nodes").alias("suffix"))
    paths = words.join(prefixes, "word").join(suffixes, "word")
    paths = paths.withColumn("chars", F.regexp_extract_all("word", F.lit("(?s)."), F.lit(0)))
    rows = paths.select("id", "n", F.inline(_pairs()))

    group = Window.partitionBy("a", "b")
    me = F.struct((-F.col("n")).alias("n"), "id")
    skip, fresh = F.col("skip"), F.col("fresh")
    rows = rows.select("*", me.alias("me")).select(
        "*",
        F.count_if(skip).over(group).alias("skips"),
        F.count_if(fresh).over(group).alias("freshes"),
        F.min(F.when(skip, F.col("me"))).over(group).alias("first"),
        F.min(F.when(fresh, F.col("me"))).over(group).alias("first_fresh"),
        F.min(F.when(~skip, F.col("me"))).over(group).alias("shorter"),
    )
    other = F.when(skip & (F.col("me.id") != F.col("first.id")), F.col("me"))
    rows = rows.where("skips > 1 or (skips = 1 and shorter is not null)").withColumn("second", F.min(other).over(group))
    replaced = F.when(F.col("me.id") == F.col("first.id"), F.col("second")).otherwise(F.col("first"))
    near = F.when(skip, F.col("skips") - 1 + F.when(fresh & F.col("shorter").isNotNull(), 1).otherwise(0)).otherwise(F.col("freshes"))
    best = F.when(skip, F.array_min(F.array(replaced, F.when(fresh, F.col("shorter"))))).otherwise(F.col("first_fresh"))
    found = rows.select("id", near.alias("near"), best.alias("best"))
    found = found.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    named = words.join(prefixes.select("word", "id"), "word")
    return named.join(found, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best")


def roots(links: DataFrame) -> DataFrame:
    """``id`` and ``root``: where the links ``id`` to ``to`` lead in the end, for every linked id.

    Links must not go round. Each round doubles the distance, so their number is
    the logarithm of the longest chain.
    """
    links = materialize(links.select("id", F.col("to").alias("root")), "links")
    while True:
        further = links.select(F.col("id").alias("root"), F.col("root").alias("next"))
        links = links.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        links = materialize(links, "links")
        if links.where("moved").isEmpty():
            return links.select("id", "root")
        links = links.drop("moved")


def variant_groups(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` for counted distinct words.

    Near words differ by exactly one inserted, deleted or replaced code point. A
    word's form is its near word of largest ``n``, of several the first in code
    point order, if that is ``ratio`` (2 or more) times its own; else null. The
    root is where the forms lead. Null and empty words are left out; an empty
    frame gives no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words, or they may go round")
    words = materialize(words.where("length(word) > 0").select("word", F.col("n").cast("long").alias("n")), "words")
    near = materialize(near_words(words), "near_words")
    fits = -F.col("best.n") >= ratio * F.col("n")
    formed = near.select("*", F.when(fits, F.col("best.id")).alias("to"), F.when(fits, -F.col("best.n")).alias("form_n"))
    led = roots(formed.where("to is not null").select("id", "to"))
    forms = near.select(F.col("id").alias("to"), F.col("word").alias("form"))
    ends = near.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    joined = formed.join(forms, "to", "left").join(led.withColumnRenamed("root", "root_id"), "id", "left").join(ends, "root_id", "left")
    return joined.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
