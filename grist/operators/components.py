"""Connected components by alternating star contraction.

Edges are kept as (vertex, smaller vertex). A round is two steps, each an
aggregate and a join on its key:

* large star: a vertex hands its larger neighbours to the smallest vertex that
  it knows, itself included;
* small star: a vertex and its smaller neighbours all link to the smallest of them.

Both keep the components as they are. The rounds end when the edges are a forest of
stars (each vertex links to one other, which links to none): then every centre is
the smallest vertex of its component. That takes O(log^2 n) rounds for n vertices
whatever the shape of the graph (Kiveris et al., "Connected Components in MapReduce
and Beyond", 2014), so there is no limit of rounds to run into; a chain of a million
takes about its logarithm. LSH buckets are stars already and end after a round or two.

Each round's edges are written as files to the checkpoint folder, which bounds the
lineage (and recovery after a lost executor) to one round. A checkpoint would keep the
planner's estimate of its size, which every join squares: after a dozen rounds that
number has billions of digits. Hubs (a bucket root linked to a
third of the corpus) make a step's join skewed on its key; the number of edges of
each key comes with the aggregate, and the join goes through
:func:`grist.operators.skew.split_join`.

Null ids are on no edge; self-loops and repeated edges change nothing, but a vertex
that has only a self-loop isn't returned; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grist.operators import skew
from grist.session import cut_lineage, materialize


def large_star(pairs: DataFrame, **skew_opts) -> DataFrame:
    """Each pair (v, m), m < v, becomes (v, smallest of m and its neighbours)."""
    ends = pairs.select(F.col("m").alias("k"), F.col("m").alias("w"), F.lit(1).alias("larger")).unionByName(
        pairs.select(F.col("v").alias("k"), F.col("m").alias("w"), F.lit(0).alias("larger")))
    least = cut_lineage(ends.groupBy("k").agg(F.min("w").alias("top"), F.sum("larger").alias("n"))
                        .filter("n > 0").withColumnRenamed("k", "m"))
    return skew.split_join(pairs, least.drop("n"), ["m"], key_counts=least, **skew_opts).select("v", F.col("top").alias("m"))


def small_star(pairs: DataFrame, **skew_opts) -> DataFrame:
    """Of each v and its smaller neighbours, all but the smallest link to the smallest."""
    least = cut_lineage(pairs.groupBy("v").agg(F.min("m").alias("top"), F.count(F.lit(1)).alias("n")))
    several = least.filter("n > 1")
    others = skew.split_join(pairs, several.drop("n"), ["v"], key_counts=several, **skew_opts)
    return (others.filter("m <> top").select(F.col("m").alias("v"), F.col("top").alias("m"))
            .unionByName(least.select("v", F.col("top").alias("m"))).distinct())


def is_star_forest(pairs: DataFrame) -> bool:
    """Whether every vertex either links to one vertex or is linked to."""
    roles = pairs.select(F.col("v").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        pairs.select(F.col("m").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    mixed = roles.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1")
    return not mixed.limit(1).count()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", **skew_opts) -> DataFrame:
    """``(vertex, component)`` for every vertex on an edge; component = min id
    (ids of any type that has an order)."""
    a, b = F.col(src), F.col(dst)
    pairs = materialize(edges.filter(a != b).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m")).distinct(), "edges")
    while not is_star_forest(pairs):
        pairs = materialize(small_star(large_star(pairs, **skew_opts).distinct(), **skew_opts), "edges")
    return (pairs.select(F.col("v").alias("vertex"), F.col("m").alias("component"))
            .unionByName(pairs.select(F.col("m").alias("vertex"), F.col("m").alias("component")).distinct()))
