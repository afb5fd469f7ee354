"""Connected components by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import Staged


def components(edges: DataFrame, staged: Staged, name: str) -> DataFrame:
    """(id, component) of every id in edges (a, b): component is the smallest id reachable.

    Each round hangs every node's larger neighbours on its smallest neighbour,
    then its smaller neighbours on the smallest of them, until nothing changes.
    Only minima are grouped, never neighbour lists, so a hub is a skewed join at
    worst. Rounds are written tables in the shared folder.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = staged.write(pairs, f"{name}-0")
    before, k = None, 0
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before, k = state, k + 1
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_min, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        pairs = staged.write(small, f"{name}-{k}")
        staged.drop(f"{name}-{k - 1}")
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
