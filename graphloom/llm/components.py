"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from graphloom.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it sees."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("a", "m").alias("m"))
    larger = both.where("b > a").join(least, F.col("a") == F.col("at"))
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "at")
    smaller = down.join(least, F.col("a") == F.col("at")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return smaller.unionByName(least.select(F.col("at").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that occurs in ``edges`` (a, b: integers); the
    component is its smallest node.

    Rounds end when the edges are the same as before (count and sum of hashes). Each round's
    edges are staged. A hub is pre-aggregated to its minimum before the shuffle, and the
    join that gives the minimum back is one Spark may split. Self-links and repeated links
    are allowed; no edges give no rows.
    """
    now = stage(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").distinct(), "edges")
    mark = None
    while True:
        seen = Observation()  # taken while the edges are written, so a round is one job
        sums = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")]
        now = stage(_small_star(_large_star(now)).observe(seen, *sums), "edges")
        if seen.get == mark:
            break
        mark = seen.get
    centres = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
