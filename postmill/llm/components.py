"""Connected components of links between numbers, as rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.session import durable


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root``: the smallest number that each linked node's component holds.

    Alternates two kinds of round until none changes a link: every node hands its
    larger neighbours, then its smaller ones, to the smallest neighbour it has.
    Rounds grow with the logarithm of the nodes. Links, in each round, are stored
    in the shared folder; the driver sees one checksum a round. Links of a node
    to itself add nothing; an empty table gives an empty result.
    """
    both = links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct()
    edges = durable(both)
    seen = None
    while True:
        large = _handed_on(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), larger=True)
        edges = durable(_handed_on(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), larger=False))
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    stars = edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct()


def _handed_on(directed: DataFrame, larger: bool) -> DataFrame:
    """Link each neighbour v of u to the smallest among u and its neighbours; with
    ``larger`` only those above u, else all (u is then the largest itself)."""
    least = directed.groupBy("u").agg(F.min("v").alias("_m"))
    least = least.select("u", F.least("_m", "u").alias("_m"))
    joined = directed.join(least, "u")
    kept = joined.where(F.col("v") > F.col("u")) if larger else joined.where(F.col("v") != F.col("_m"))
    linked = kept.select(F.col("v").alias("u"), F.col("_m").alias("v"))
    if not larger:  # u itself keeps its link to the smallest
        linked = linked.unionByName(least.where(F.col("u") != F.col("_m")).select("u", F.col("_m").alias("v")))
    return linked.where("u <> v").distinct()
