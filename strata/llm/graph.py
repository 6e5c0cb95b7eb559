"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import release, stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("lo"), F.col("hi"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "c")
    joined = edges.join(least, F.col("hi") == F.col("c"))
    down = joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return down.union(least.select(F.col("c").alias("hi"), F.col("m").alias("lo")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (its smallest node) of every node that has a link to another.

    Alternating large-star and small-star rounds; each round is written to the
    shared folder, and the rounds end when one leaves the links as they were.
    Neighbours only ever meet as minima and joins, never as one group in a task.
    """
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    ).distinct()
    edges, mark = stage(edges, "links"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if now == mark or now[0] == 0:
            break
        mark, last = now, edges
        edges = stage(_small_star(_large_star(edges).distinct()).distinct(), "links")
        release(last)
    members = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return members.union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
