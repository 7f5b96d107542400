"""Connected components of a table of links, as Spark jobs.

Alternating large-star and small-star steps: every step sends the neighbours of
a node to the smallest of them.  Minima are grouped with map-side combine and
joined back, so a node with a third of all links is not gathered anywhere; the
driver sees two numbers of each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import landed


def _star(edges: DataFrame) -> DataFrame:
    """Edges (u, v): every v is sent to the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all ends of the links (a, b); the component is its smallest id."""
    edges = landed(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = _digest(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = _star(large)
        small = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        edges = landed(small, "stars")
        now = _digest(edges)
        if now == before:
            break
        before = now
    mine = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return mine.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
