"""Connected components by alternating large and small stars, and tables that cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.session import scratch_path


def keep(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared scratch folder and read back: later steps do not repeat its work."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """a, b and the smallest of a and its neighbours as m, for edges in both directions."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    return edges.join(least, F.col("a") == F.col("c")).select("a", "b", "m")


def _is_final(edges: DataFrame) -> bool:
    """Whether every node has one root and no root has a root itself."""
    seen = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")) \
        .unionAll(edges.select("b", F.lit(0), F.lit(1)))
    seen = seen.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.where("out > 1 or (out = 1 and into = 1)").isEmpty()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable from it, for every node of an edge (a, b) of longs.

    The number of rounds grows with the logarithm of the longest path; every round is two joins and two
    aggregates over the edges, which never become more.
    """
    edges = keep(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "edges")
    while not _is_final(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _least_neighbour(both).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        near = _least_neighbour(large.distinct())
        small = near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(near.select("a", F.col("m").alias("b"))).distinct()
        edges = keep(spark, small, "edges")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
