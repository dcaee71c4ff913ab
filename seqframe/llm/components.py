"""Connected components of a large set of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.session import written


def _least(links: DataFrame) -> DataFrame:
    """For each ``u`` of (u, v) the least of u and its neighbours, back on every link."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("u_"), F.least("u", "m").alias("m"))
    return links.join(least, F.col("u") == F.col("u_")).drop("u_")


def _pairs(links: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """Several (u, v) of each link from one reading of it: unions of what a step joins would double its plan each time."""
    return links.select(F.inline(F.array(*(F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ends))))


def _step(links: DataFrame) -> DataFrame:
    """One large-star and one small-star pass: links move towards the least node of a component."""
    large = _least(_pairs(links, ("u", "v"), ("v", "u"))).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
    return _pairs(_least(large), ("v", "m"), ("u", "m")).filter("u != v").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link to another; component is its least node (action).

    Alternates the two star passes of a published map-reduce method until no link changes. A hub with
    many links is met by aggregates that combine before the shuffle and by joins that Spark can split,
    never gathered. Null ends and self-links are left out; no links give an empty result.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (F.col(a) != F.col(b)).alias("real")).filter("real").drop("real").distinct()
    links, seen = written(links), None
    while True:
        mark = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == tuple(mark) or not mark[0]:
            break
        seen, links = tuple(mark), written(_step(links))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
