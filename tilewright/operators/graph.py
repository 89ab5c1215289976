"""Connected components of an edge table.

Alternating large-star / small-star rounds: every round is two aggregations and two joins on the edge table, the number
of rounds grows with the logarithm of the longest chain, and each round is written to the shared scratch folder so that
the lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tilewright.sources.scratch import written


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Each edge with its end's least neighbour. The further key makes the join shuffle both sides for itself, apart from the
    aggregate before it, so that adaptive execution may split the edges of a hub over several tasks."""
    return edges.withColumn("k", F.xxhash64("u")).join(least.withColumn("k", F.xxhash64("u")), ["u", "k"]).drop("k")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(down, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that an edge touches; component is the smallest node reachable.

    Null ends and self loops add nothing. A node without edges does not appear: it is its own component. An empty edge
    table gives an empty result. ``max_rounds`` only guards against a cluster that never settles.
    """
    now = written(
        edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        now = written(_small_star(_large_star(now).where("u <> v").distinct()).where("u <> v").distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
