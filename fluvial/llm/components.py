"""Connected components of a graph given as a table of edges, by repeated contraction.

Each round every node picks the least of itself and its neighbours, in the order of the ids in even rounds and in a
hashed order in odd ones, and edges move to the picked nodes. Stars that point to their least node vanish in a round or
two; the hashed order makes any graph shrink by a constant factor in expectation. Each round's picks are written to the
shared folder, so lineage stays short, and are put together at the end. Nothing is collected; the choice is an aggregate
that combines before the shuffle and the moves are joins that Spark can split where one node has many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvial.llm.common import materialize


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge between different nodes; root is some node of the component, the same for all of it.

    Null ends, loops and repeated edges are ignored. No edges: no rows.
    """
    tidy = lambda e: e.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    live = materialize(tidy(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges-0")
    rounds: list[DataFrame] = []
    while not live.isEmpty():
        k = len(rounds)
        order = lambda x: F.struct(F.xxhash64(x, F.lit(k)), x) if k % 2 else F.struct(x)  # noqa: B023, E731
        ends = live.select("u", "v").union(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = ends.groupBy("u").agg(F.min(order(F.col("v"))).alias("best"))
        pick = best.withColumn("own", order(F.col("u")))
        pick = pick.select("u", F.when(F.col("best") < F.col("own"), F.col(_last("best", best))).otherwise(F.col("u")).alias("r"))
        pick = materialize(pick, f"picks-{k}")
        rounds.append(pick)
        moved = live.join(pick.select("u", F.col("r").alias("ru")), "u").join(pick.select(F.col("u").alias("v"), F.col("r").alias("rv")), "v")
        live = materialize(tidy(moved.select(F.col("ru").alias("u"), F.col("rv").alias("v"))), f"edges-{k + 1}")
    if not rounds:
        return live.select(F.col("u").alias("node"), F.col("v").alias("root"))
    whole = rounds[-1].select(F.col("u").alias("node"), F.col("r").alias("root"))
    for pick in reversed(rounds[:-1]):
        later = whole.select(F.col("node").alias("r"), "root")
        whole = pick.join(later, "r", "left").select(F.col("u").alias("node"), F.coalesce("root", "r").alias("root"))
    return whole


def _last(column: str, of: DataFrame) -> str:
    """The node in an order's struct: its last field."""
    return f"{column}.{of.schema[column].dataType.names[-1]}"
