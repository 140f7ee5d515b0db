"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import delete_folder, delete_later, stored


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges (a, b); the component is its smallest node.

    Alternates linking every node's larger neighbours, then its smaller ones, to the smallest
    neighbour, until only stars are left. Minima are combined before each shuffle, a busy node is
    one row in every join, and each round is a written table, so a lost executor costs one round; the table
    before is then deleted. Every round that is not the last makes some node's link smaller, and rounds are
    about logarithmic in the longest path, so there is no limit on them.
    """
    def pairs(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    spark = edges.sparkSession
    links, path = stored(pairs(edges.toDF("u", "v")), "links")
    before = None
    while (now := state(links)) != before:
        before = now
        both = links.union(links.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = pairs(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(small, "u")
        after = pairs(linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))))
        last = path
        links, path = stored(after, "links")
        delete_folder(spark, last)
    delete_later(path)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
