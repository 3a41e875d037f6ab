"""Connected components of an edge table, by alternating star contractions.

Large-star links every larger neighbour of a node to the node's smallest
neighbour; small-star does the same for the smaller neighbours.  The edge set
becomes one star per component after a logarithmic number of rounds.  Each
round is a grouped minimum (combined before the shuffle) and an equi-join,
which AQE splits where a node has very many neighbours; no neighbour list is
ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.shared import staged


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(low, "a").where("b > a and b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    # every edge already runs from the larger (a) to the smaller (b) node
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    other = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return other.unionAll(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is the
    smallest node id reachable.  Self edges and edges with a null end are
    ignored; repeated edges count once.  An empty table gives no rows."""
    e = (edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a <> b").distinct())
    e = staged(e, "edges")
    seen = None
    for _ in range(max_rounds):
        e = staged(_small_star(_large_star(e)), "edges")
        # a star forest is a fixed point: same edges, counted by an order-free digest
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
