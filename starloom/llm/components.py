"""Connected components of links between documents, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import scratch_path


def _stored(edges: DataFrame) -> DataFrame:
    path = scratch_path(edges.sparkSession, "component-edges")
    edges.write.parquet(path)
    return edges.sparkSession.read.parquet(path)


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free hash of the edges."""
    h = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    row = edges.agg(F.count("*").alias("n"), h.alias("h")).collect()[0]
    return row.n, row.h


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links(a, b)``; a component is its smallest node.

    Alternating large-star and small-star steps: each is an aggregation (pre-aggregated before
    its shuffle) and a join that AQE may split, so a node with many links needs no single task.
    Every round is written to the shared checkpoint folder. Self-links and repeated links do
    not matter; null ends are dropped; no links give no rows.
    """
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = _stored(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    before = _mark(edges)
    while before[0]:
        # large star: a larger neighbour of lo is tied to the smallest of lo and its neighbours
        near = edges.select(F.col("lo").alias("u"), F.col("lo").alias("v"))
        near = near.unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        large = edges.join(least, edges.lo == least.u).select("hi", F.col("m").alias("lo")).distinct()
        # small star: the smaller neighbours of hi, and hi, are tied to the smallest of them
        first = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        pairs = large.join(first, large.hi == first.u)
        small = pairs.where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = _stored(small.unionByName(first.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct())
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("lo").alias("node")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
