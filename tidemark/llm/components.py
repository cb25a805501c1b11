"""Connected components by randomised contraction, on DataFrames only.

Each level hangs every node on the neighbour (or itself) that comes first in a
random order of that level, then replaces the edges' ends by what they hang on
and drops loops and repeats. The expected number of nodes falls by a constant
factor per level, whatever the shape (chains included), so a graph with n
edges takes O(log n) levels. A hub costs nothing special: its neighbours are
reduced by a map-side ``min`` and it is contracted in the first levels.
Nothing but one edge count per level reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: columns ``a`` and ``b`` of one orderable type, undirected.

    Returns ``node``, ``component`` (the smallest node of the component), one
    row for each node that has an edge to another node. Null ends and loops
    are ignored; repeated edges count once; no edges give no rows."""
    level = materialize(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    hangs = []  # of each level: node -> what it hangs on
    while level.limit(1).count():
        salt = len(hangs)
        order = lambda c: F.struct(F.xxhash64(F.lit(salt), F.col(c)).alias("o"), F.col(c).alias("n"))
        both = level.select(F.col("a").alias("node"), order("b").alias("by")).union(
            level.select(F.col("b").alias("node"), order("a").alias("by")))
        hang = materialize(
            both.groupBy("node").agg(F.min("by").alias("by"))
            .select("node", F.least("by", order("node"))["n"].alias("to")))
        hangs.append(hang)
        ends = lambda c, old: hang.select(F.col("node").alias(old), F.col("to").alias(c))
        level = materialize(
            level.join(ends("x", "a"), "a").join(ends("y", "b"), "b").where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not hangs:
        return level.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = hangs[-1]
    for hang in reversed(hangs[:-1]):
        up = found.select(F.col("node").alias("to"), F.col("to").alias("top"))
        found = hang.join(up, "to", "left").select("node", F.coalesce("top", "to").alias("to"))
    found = materialize(found)
    least = found.groupBy("to").agg(F.min("node").alias("component"))
    return found.join(least, "to").select("node", "component")
