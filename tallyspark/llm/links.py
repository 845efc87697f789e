"""Connected components of a link table, by alternating stars.

Each round replaces every link by links to the smallest neighbour: first
from the larger neighbours of a vertex (large star), then from its smaller
ones (small star).  The links form one star per component after a number of
rounds that grows with the logarithm of the longest path.  All state is a
table; minima are combined before the shuffle, and a vertex with very many
links is split by the adaptive planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.frames import keep, other_key


def _with_min(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each link with the smallest of u and u's neighbours."""
    least = (pairs.groupBy("u").agg(F.min("v").alias("mv"))
             .select(other_key(F.col("u")).alias("k"), F.least("u", "mv").alias("m")))
    return pairs.withColumn("k", other_key(F.col("u"))).join(least, "k").select("u", "v", "m")


def _round(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (_with_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .distinct())
    small = _with_min(large)
    return (small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("x")).select("x.*").where("u > v").distinct())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every vertex with a link to another one; the
    component is the smallest vertex reachable.  Nulls and loops drop out."""
    e = keep(edges.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = None
    while True:
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
        if not state[0]:
            break
        e = keep(_round(e), "links")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
