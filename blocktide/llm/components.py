"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from blocktide.session import new_work_dir


def _written(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """Written and read back, with its rows and a checksum of them."""
    spark = df.sparkSession
    path, seen = new_work_dir(spark, name), Observation()
    check = F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_000_007), F.lit(0))
    df.observe(seen, F.count(F.lit(1)).alias("rows"), check.alias("check")).write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    return read, seen.get.get("rows", 0), seen.get.get("check", 0)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is the smallest node.

    Each round links every node's larger neighbours to the smallest node known
    around it, then its smaller ones, until nothing moves: about log(n) rounds,
    with an edge count that never grows. Both steps aggregate, they never hold a
    node's neighbours in one place. Every round is written to the shared folder.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, rows, check = _written(edges.filter("a <> b").distinct(), "links")
    while rows:
        around = _both_ways(now)
        least = around.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m")
        )
        # Larger neighbours of a node go to the smallest node around it.
        large = around.filter("b > a").join(least, F.col("a") == F.col("n")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        large = large.filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        # So do its smaller neighbours and the node itself.
        small = large.join(down, F.col("a") == F.col("n")).select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*")
        after, rows_after, check_after = _written(small.filter("a <> b").distinct(), "links")
        if (rows_after, check_after) == (rows, check):
            break
        now, rows, check = after, rows_after, check_after
    stars = now.groupBy("a").agg(F.min("b").alias("b"))
    roots = stars.select("b").distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )
