"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.scratch import discard, join_apart, write

ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on distinct edges (u > v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = join_apart(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = join_apart(large, low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge; component is its smallest reachable node.

    Edges are undirected; loops, repeated edges and null ends are ignored. Each round is a few
    key aggregations and joins whose hot side is pre-aggregated; it is written to the shared
    folder, and the round before it removed. The rounds grow with the logarithm of the size.
    """
    spark = edges.sparkSession
    start = (
        edges.where(f"{a} <> {b}")
        .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .distinct()
    )
    path, before = write(start, "edges"), None
    for _ in range(ROUNDS):
        current = spark.read.schema("u long, v long").parquet(path)
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before, old = mark, path
        path = write(_stars(current), "edges")
        discard(spark, old)
    else:
        raise RuntimeError(f"components are not stable after {ROUNDS} rounds")
    done = spark.read.schema("u long, v long").parquet(path)
    return done.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        done.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
