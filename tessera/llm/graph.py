"""Connected components of an edge table by alternating large and small stars.

Every round points nodes to smaller neighbours; after a logarithmic number of
rounds each node points to the smallest id of its component. Rounds are written
to the shared folder, which cuts the lineage; no edge reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.session import remove_scratch, scratch_path


SMALL = 1 << 19       # edges whose minima (16 bytes a node) go to every executor


def _stars(e: DataFrame, edges: int) -> DataFrame:
    """One large star and one small star over edges (a > b), of which there are
    ``edges``: below the bound the minima are broadcast, above it joined."""
    sent = F.broadcast if edges <= SMALL else (lambda x: x)
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    large = both.where(F.col("b") > F.col("a")).join(sent(low), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a > b")
    low2 = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(sent(low2), "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
    small = small.unionByName(low2.select("a", F.col("m").alias("b")))
    return small.where("a > b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge between different nodes;
    component is the smallest node reachable. Null ends and loops are left out."""
    spark = edges.sparkSession

    def written(e: DataFrame):
        """The edges in the shared folder, with their number and a checksum."""
        path, seen = scratch_path(spark, "edges"), Observation()
        e.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
                  ).write.parquet(path)
        return path, (seen.get["n"], seen.get["h"])

    path, state = written(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct())
    while state[0]:
        new, after = written(_stars(spark.read.parquet(path), state[0]))
        remove_scratch(spark, path)
        path, state, before = new, after, state
        if state == before:
            break
    e = spark.read.parquet(path)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
