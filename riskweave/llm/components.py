"""Connected components of a table of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it reaches, for all nodes of ``links(a, b)``.

    Large stars link the greater neighbours of a node to its smallest one,
    small stars the smaller ones; the number of links never grows and the star
    forest is reached in a logarithmic number of rounds in practice. Rounds end
    when the links no longer change. Each round is written to the shared folder,
    so a lost executor costs one round at most.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = materialize(links, "links")
    seen = None
    while (now := links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")))).first() != seen:
        seen = now.first()
        links = materialize(_small_stars(_large_stars(links)), "links")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()


def _large_stars(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_stars(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    inner = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
