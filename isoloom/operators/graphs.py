"""Connected components of graphs that are tables of edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.stages import Staged


def components(edges: DataFrame, u: str = "u", v: str = "v", by: Sequence[str] = ()) -> DataFrame:
    """(by, node, component) of every node of edges (by, u, v), taken without direction; component is
    the smallest node that can be reached.

    Nodes of different ``by`` (such as a locus) are different; ``by`` must not be null. Edges
    with a null end are left out, a loop makes its node a component of its own, repeated edges
    count once, further columns are not read, and no edge gives no row.

    Each round hangs the larger neighbours of a node on its smallest neighbour, and then its
    smaller ones on the smallest of these, until the edges stay as they are; a path of n nodes
    takes about log n rounds. Only minima are grouped, never neighbours, so that a node with
    very many edges is a skewed join at worst. Each round is a table in the shared folder.
    """
    by = list(by)
    given = edges.where(F.col(u).isNotNull() & F.col(v).isNotNull()).select(*by, F.col(u).alias("a"), F.col(v).alias("b"))
    staged = Staged(edges.sparkSession, "components")
    given = staged.write(given.distinct(), "edges")
    now = staged.write(given.where("a <> b").select(*by, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "0")
    before, k = None, 0
    while (state := now.agg(F.count("*"), F.sum(F.xxhash64(*by, "a", "b").cast("decimal(38,0)"))).first()) != before and state[0]:
        before, k = state, k + 1
        both = now.unionByName(now.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(*by, "a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, [*by, "a"]).select(*by, F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy(*by, "a").agg(F.min("b").alias("m"))
        hung = F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.join(lowest, [*by, "a"]).select(*by, F.explode(hung).alias("e")).select(*by, "e.a", "e.b").where("a <> b").distinct()
        now = staged.write(small, str(k))
        staged.drop(str(k - 1))
    nodes = given.select(*by, F.explode(F.array("a", "b")).alias("node")).distinct()
    return nodes.join(now.withColumnsRenamed({"a": "node", "b": "component"}), [*by, "node"], "left").withColumn("component", F.coalesce("component", "node")).select(*by, "node", "component")
