"""Quality rules: how far a document's histograms are from its language's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.text import WORD

WHITE = r"[\x20\x09-\x0D]+"

SYMBOLS = r"[#*$%&|<>]"

SPACE = r"[\x20\x09-\x0D]"

# Character classes of the histogram, besides lower-case ASCII letters, white
# space and what belongs to none of them.
CLASSES = (
    r"[A-Z]",
    r"[0-9]",
    r"[.,;:!?'\"()\-]",
    r"[\x{C0}-\x{24F}]",
    r"[^\x00-\x7F\x{C0}-\x{24F}]",
)

# A word with a smaller share of its language's words is not a common one, so a
# language has at most so many.
COMMON_SHARE = 2000

MIN_WORDS = 50


def _without(text: str, characters: str) -> Column:
    return F.regexp_replace(text, f"{characters}+", "")


def with_classes(docs: DataFrame) -> DataFrame:
    """Adds ``_classes``, code points by character class as longs, and ``n_symbols``, to ``docs`` with ``text``.

    Lower-case letters and white space, most of a text, are cut out first, each
    in one pass; all other classes are counted, by what their removal leaves, in
    the little that stays. So the text is read twice, not once for each class.
    """
    docs = docs.withColumn("_whole", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("_rest", _without("_whole", "[a-z]")).withColumn("_solid", _without("_rest", SPACE))
    length = lambda c: F.length(c).cast("long")
    solid = length("_solid")
    docs = docs.withColumn("_found", F.array(*[solid - F.length(_without("_solid", c)) for c in CLASSES]))
    docs = docs.withColumn("n_symbols", solid - F.length(_without("_solid", SYMBOLS)))
    other = solid - F.aggregate("_found", F.lit(0).cast("long"), lambda s, x: s + x)
    first = F.array(length("_whole") - length("_rest"), length("_rest") - solid, other)
    return docs.withColumn("_classes", F.concat(first, "_found")).drop("_whole", "_rest", "_solid", "_found")


def _split(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def _after(array: str, n: int, length: Column) -> Column:
    """The array from its n-th element on (from 0), ``length`` elements."""
    return F.slice(array, n + 1, F.greatest(length, F.lit(0)))


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds the counts of the base rules to ``docs``, made by ``with_classes``.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` (lines with a
    word that equal an earlier line) and ``n_repeat_words`` (words in a window
    of three words that the text has twice or more). All stay within the row:
    windows are hashed and sorted with their places, so a text of n words costs
    n log n, and texts without a repeated window are not sorted at all.
    """
    text = F.coalesce("text", F.lit(""))
    n = F.col("n_words")
    docs = docs.withColumn("_words", F.transform(_split(text), lambda w: F.xxhash64(w)))
    docs = docs.withColumn("n_words", F.size("_words").cast("long"))
    docs = docs.withColumn("word_chars", F.length(text).cast("long") - F.get("_classes", F.lit(1)))
    docs = docs.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)))
    docs = docs.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    windows = F.transform(
        _after("_words", 0, n - 2), lambda h, i: F.xxhash64(h, F.get("_words", i + 1), F.get("_words", i + 2))
    )
    docs = docs.withColumn("_windows", windows)
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    docs = docs.withColumn("_sorted", F.when(repeats, F.sort_array(placed)))
    twins = F.zip_with(
        "_sorted", _after("_sorted", 1, F.size("_sorted")), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
    )
    docs = docs.withColumn("_places", F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull())))))
    # A window covers three words, or as many as come before the next one's first.
    covered = F.zip_with("_places", _after("_places", 1, F.size("_places")), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    docs = docs.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))
    return docs.drop("_lines", "_words", "_windows", "_sorted", "_places")


def references(docs: DataFrame, words_per_language: int = 64) -> list[dict]:
    """Each language's shares of character classes and common words, over all labelled texts.

    ``docs`` has ``text`` and ``lang``. A language gives one row of class totals
    and ``words_per_language`` words at most; nothing else reaches the driver.
    """
    known = docs.where("lang is not null and text is not null").select("lang", "text")
    classes = range(len(CLASSES) + 3)
    counts = with_classes(known).select("lang", F.size(_split(F.col("text"))).alias("n"), F.col("_classes").alias("c"))
    sums = [F.sum(F.col("c")[i]).alias(f"c{i}") for i in classes]
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"), *sums)
    languages = {r["lang"]: r for r in totals.collect()}
    if not languages:
        return []
    size = F.create_map(*[F.lit(x) for lang, r in languages.items() for x in (lang, r["n"])])
    words = known.select("lang", F.explode(_split(F.lower("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    common = words.where(F.col("n") * COMMON_SHARE >= F.element_at(size, F.col("lang")))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = common.withColumn("r", F.row_number().over(most)).where(F.col("r") <= words_per_language).collect()
    out = []
    for lang, r in sorted(languages.items()):
        chars = [r[f"c{i}"] for i in classes]
        mine = sorted((x["word"], x["n"] / r["n"]) for x in common if x["lang"] == lang)
        out.append(
            {
                "lang": lang,
                "classes": [c / max(1, sum(chars)) for c in chars],
                "words": [w for w, _ in mine],
                "shares": [q for _, q in mine],
            }
        )
    return out


def _part(p: Column, q: Column) -> Column:
    """One bin's share of twice the Jensen-Shannon divergence, in bits."""
    one = F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
    return one + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0)


def divergences(docs: DataFrame, reference: list[dict]) -> DataFrame:
    """Adds ``divergences``: (lang, chars, words) for each reference language.

    Both are Jensen-Shannon distances between 0 and 1 (square roots of the
    divergences), of the document's character classes and of its common words
    (all other words are one bin), rounded to nine digits. ``docs`` has ``text``,
    ``n_words`` and ``_classes``.
    """
    if not reference:
        empty = F.array().cast("array<struct<lang:string,chars:double,words:double>>")
        return docs.withColumn("divergences", empty)
    every = sorted({w for r in reference for w in r["words"]})
    n_chars = F.greatest(F.length("text"), F.lit(1))
    docs = docs.withColumn("_histogram", F.transform("_classes", lambda c: F.coalesce(c / n_chars, F.lit(0.0))))
    common = F.filter(_split(F.lower(F.coalesce("text", F.lit("")))), lambda w: w.isin(every))
    docs = docs.withColumn("_common", F.sort_array(common))
    # Where a word differs from the one before it, and where the last one ends.
    starts = F.filter(
        F.transform("_common", lambda w, i: F.when((i == 0) | (w != F.get("_common", i - 1)), i)), lambda i: i.isNotNull()
    )
    docs = docs.withColumn("_firsts", F.concat(starts, F.array(F.size("_common"))))
    n = F.greatest(F.col("n_words"), F.lit(1))
    # By word, its share in each language, null where it is not common.
    known = [dict(zip(r["words"], r["shares"], strict=True)) for r in reference]
    table = F.map_from_arrays(
        F.array(*map(F.lit, every)),
        F.array(*[F.array(*[F.lit(k.get(w)).cast("double") for k in known]) for w in every]),
    )
    shares = F.transform(
        _after("_firsts", 0, F.size("_firsts") - 1),
        lambda a, i: F.struct(
            F.element_at(table, F.get("_common", a)).alias("q"), ((F.get("_firsts", i + 1) - a) / n).alias("p")
        ),
    )
    docs = docs.withColumn("_shares", shares if every else F.array().cast("array<struct<q:array<double>,p:double>>"))

    def against(place: int, r: dict) -> Column:
        classes = F.array(*map(F.lit, r["classes"])).cast("array<double>")
        chars = F.aggregate(F.zip_with("_histogram", classes, _part), F.lit(0.0), lambda s, x: s + x)
        paired = F.filter(
            F.transform("_shares", lambda x: F.struct(x["p"].alias("p"), x["q"][place].alias("q"))), lambda x: x["q"].isNotNull()
        )
        zero = F.struct(F.lit(0.0).alias("f"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))
        whole = sum(r["shares"])
        rest = max(1 - whole, 0.0)
        words = F.aggregate(
            paired, zero,
            lambda s, x: F.struct((s["f"] + _part(x["p"], x["q"])).alias("f"), (s["p"] + x["p"]).alias("p"), (s["q"] + x["q"]).alias("q")),
            # Words of the language that the document lacks count with their share.
            lambda s: s["f"] + (whole - s["q"]) + _part(F.greatest(1 - s["p"], F.lit(0.0)), F.lit(rest)),
        )
        return F.struct(F.lit(r["lang"]).alias("lang"), _distance(chars).alias("chars"), _distance(words).alias("words"))

    docs = docs.withColumn("divergences", F.array(*[against(i, r) for i, r in enumerate(reference)]))
    return docs.drop("_histogram", "_common", "_firsts", "_shares")


def _distance(twice: Column) -> Column:
    """Rounding can leave the divergence of equal histograms just below zero."""
    return F.round(F.sqrt(F.greatest(twice / 2, F.lit(0.0))), 9)


def judge(
    docs: DataFrame,
    most_chars: float = 0.255,
    most_words: float = 0.49,
    min_chars: int = 200,
    min_words: int = 50,
    words_per_language: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Base counts and the verdict of every row.

    ``base_failed``: fewer than 50 words, or more than half of the words in
    repeated windows. ``kept``: the base holds and some reference language is
    near enough, both in character classes (texts of ``min_chars`` code points
    or more) and in common words (of ``min_words`` words or more); shorter texts
    pass that part, for their histograms say little. The references come from
    all labelled texts; without any, the base alone decides. The label of a row
    does not enter its own verdict. A null text counts as empty. Nothing is
    shuffled but the reference's word counts, and no row meets another.
    """
    text = F.col(text_col).cast("string").alias("text")
    learned = references(docs.select(text, F.col(lang_col).cast("string").alias("lang")), words_per_language)
    rows = with_classes(docs.select(F.col(id_col).cast("long").alias("doc_id"), text))
    rows = divergences(base_counts(rows), learned)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    short_chars = F.coalesce(F.length("text"), F.lit(0)) < min_chars
    short_words = F.col("n_words") < min_words
    near = F.exists("divergences", lambda d: (short_chars | (d["chars"] <= most_chars)) & (short_words | (d["words"] <= most_words)))
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~failed & (near | F.lit(not learned))).drop("text", "_classes")
