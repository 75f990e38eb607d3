"""Connected components of links between integer ids, by alternating
large-star and small-star steps; each result is written to the shared folder,
so a lost executor costs one step at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfmart.session import scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or not larger) neighbours are linked to its least."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if large:
        return (both.where(F.col("b") > F.col("a")).join(least, "a")
                    .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct())
    down = both.where(F.col("b") < F.col("a"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (moved.unionByName(low.select("a", F.col("m").alias("b")))
                 .where(F.col("a") != F.col("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each linked id.
    ``edges``: columns a and b, in any order, repeats allowed."""
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .where(F.col("a") != F.col("b")).distinct(), "links")
    mark = None
    while True:
        now = saved(_star(_star(now, True), False), "links")
        # done when the set of links stays as it is
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a"), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
