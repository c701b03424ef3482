"""River networks as tables of links: closure, depth, accumulation, order and checks, without collecting the graph.

A forest is a table with an id and the id downstream of it (null at an outlet). Everything that follows a path of unknown length
does so by pointer doubling: after k rounds a row knows what lies 2 ** k reaches downstream, so a basin of depth d takes about log2(d) joins,
each cut from its lineage by a written table. Null ids are dropped; a downstream id that no row has counts as an outlet's.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvial.checkpoint import materialize


def edges(reaches: DataFrame, *, hydroseq: str = "hydroseq", down: str = "dnhydroseq", id: str = "id") -> DataFrame:  # noqa: A002
    """up_id, dn_id: reaches joined to the reach whose hydroseq is their downstream one; 0 and null lead nowhere."""
    up = reaches.where((F.col(down) != 0) & F.col(down).isNotNull()).select(F.col(id).alias("up_id"), F.col(down).alias("at"))
    dn = reaches.select(F.col(id).alias("dn_id"), F.col(hydroseq).alias("at"))
    return up.join(dn, "at").select("up_id", "dn_id")


def upstream_lists(links: DataFrame) -> DataFrame:
    """dn_id, ups: the sorted reaches that flow into each."""
    return links.groupBy("dn_id").agg(F.sort_array(F.collect_list("up_id")).alias("ups"))


def outlets(reaches: DataFrame, *, hydroseq: str = "hydroseq", down: str = "dnhydroseq") -> DataFrame:
    """Reaches whose downstream hydroseq is 0 or not in the table; a null one is neither outlet nor link."""
    known = reaches.select(F.col(hydroseq).alias("known"))
    return reaches.where(F.col(down).isNotNull()).join(known, (F.col(down) == F.col("known")) & (F.col(down) != 0), "left_anti")


def connected(flowpaths: DataFrame, *, id: str = "fp_id", up: str = "up_nex_id", down: str = "dn_nex_id") -> DataFrame:  # noqa: A002
    """up_id, dn_id of flowpaths that share a nexus: one's downstream nexus is the other's upstream one."""
    a = flowpaths.where(F.col(down).isNotNull()).select(F.col(id).alias("up_id"), F.col(down).alias("nex"))
    b = flowpaths.where(F.col(up).isNotNull()).select(F.col(id).alias("dn_id"), F.col(up).alias("nex"))
    return a.join(b, "nex").select("up_id", "dn_id")


def to_outlet(forest: DataFrame, weight: Column | None = None) -> DataFrame:
    """id, outlet_id, depth, path (sum of weight over the reaches strictly downstream) of every row of forest(id, down).

    Rows on a cycle, or upstream of one, reach no outlet and are left out; see `cyclic`.
    """
    return _doubled(forest, weight).where("done").select("id", F.col("at").alias("outlet_id"), "depth", "path")


def cyclic(forest: DataFrame) -> DataFrame:
    """id of the rows of forest(id, down) that lie on a cycle or upstream of one."""
    return _doubled(forest, None).where(~F.col("done")).select("id")


def _doubled(forest: DataFrame, weight: Column | None) -> DataFrame:
    weight = F.lit(0.0) if weight is None else weight
    rows = forest.where("id IS NOT NULL").select("id", F.col("down").alias("down"), weight.cast("double").alias("w"))
    below = rows.select(F.col("id").alias("at"), F.col("w").alias("path"))
    first = rows.join(below, rows["down"] == below["at"], "left").select(
        "id", F.coalesce("at", "id").alias("at"), F.when(F.col("at").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.coalesce("path", F.lit(0.0)).alias("path"), F.col("at").isNull().alias("done")
    )
    state = materialize(first, "walk-0")
    n, k = state.count(), 0
    while (1 << k) < 2 * n and not state.where(~F.col("done")).isEmpty():
        k += 1
        ahead = state.select(F.col("id").alias("at"), F.col("at").alias("at2"), F.col("depth").alias("depth2"), F.col("path").alias("path2"), F.col("done").alias("done2"))
        moved = state.where(~F.col("done")).join(ahead, "at").select("id", F.col("at2").alias("at"), (F.col("depth") + F.col("depth2")).alias("depth"), (F.col("path") + F.col("path2")).alias("path"), F.col("done2").alias("done"))
        state = materialize(state.where("done").unionByName(moved), f"walk-{k}")
    return state


def jump_tables(forest: DataFrame) -> list[DataFrame]:
    """(id, at) tables of the reach 1, 2, 4, ... reaches downstream, until none is left."""
    ids = forest.where("id IS NOT NULL").select(F.col("id").alias("at"))
    table = materialize(forest.where("id IS NOT NULL AND down IS NOT NULL").select("id", F.col("down").alias("at")).join(ids, "at", "left_semi").select("id", "at"), "jump-0")
    tables: list[DataFrame] = []
    limit = 2 * max(1, forest.count())
    while not table.isEmpty():
        if 1 << len(tables) > limit:
            raise ValueError("the links have a cycle")
        tables.append(table)
        on = table.select(F.col("id").alias("at"), F.col("at").alias("further"))
        table = materialize(table.join(on, "at").select("id", F.col("further").alias("at")), f"jump-{len(tables)}")
    return tables


def upstream_sums(values: DataFrame, columns: list[str], tables: list[DataFrame]) -> DataFrame:
    """values(id, columns) with each column summed over the row and all rows upstream of it.

    Sums over the reaches fewer than 2 ** k upstream become those over twice as many by adding the sums of the rows exactly 2 ** k upstream.
    """
    state = values.select("id", *columns)
    for k, table in enumerate(tables):
        more = state.join(table, "id").groupBy("at").agg(*(F.sum(c).alias(f"more_{c}") for c in columns))
        added = ((F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c) for c in columns)
        state = state.join(more, state["id"] == more["at"], "left").select("id", *added)
        state = materialize(state, f"sums-{k}")
    return state


def stream_order(forest: DataFrame, tables: list[DataFrame] | None = None, by_level: bool | None = None) -> DataFrame:
    """id, stream_order (Strahler) of every row of forest(id, down).

    Shallow networks go level by level from the deepest: one round a level. In deep ones an order over k means that somewhere upstream, or here, two
    branches of order k or more meet, so a round for each order marks those confluences and carries the marks downstream by doubling. Which takes
    fewer rounds is read off the depth and size; the result is the same.
    """
    walked = materialize(forest.select("id", "down").join(to_outlet(forest).select("id", "depth"), "id"), "order-depths")
    size = walked.agg(F.max("depth").alias("deepest"), F.count("*").alias("n")).first()
    if not size.n:
        return walked.select("id", F.lit(1).alias("stream_order"))
    if by_level is None:
        by_level = size.deepest <= math.log2(size.n + 1) * math.log2(size.deepest + 2) / 2
    return _orders_by_level(walked, size.deepest) if by_level else _orders_by_marks(forest, tables)


def _orders_by_level(walked: DataFrame, deepest: int) -> DataFrame:
    levels: list[DataFrame] = []
    for d in range(deepest, -1, -1):
        here = walked.where(F.col("depth") == d)
        if levels:
            alike = levels[-1].groupBy("down", "stream_order").count()
            top = alike.groupBy(F.col("down").alias("at")).agg(F.max("stream_order").alias("most"), F.max_by("count", "stream_order").alias("times"))
            order = F.coalesce(F.col("most") + F.when(F.col("times") > 1, 1).otherwise(0), F.lit(1))
            here = here.join(top, here["id"] == top["at"], "left").select("id", "down", order.alias("stream_order"))
        else:
            here = here.select("id", "down", F.lit(1).alias("stream_order"))
        levels.append(materialize(here, f"level-{d}"))
    return reduce(DataFrame.union, levels).select("id", "stream_order")


def _orders_by_marks(forest: DataFrame, tables: list[DataFrame] | None) -> DataFrame:
    tables = jump_tables(forest) if tables is None else tables
    orders = materialize(forest.where("id IS NOT NULL").select("id", "down", F.lit(1).alias("stream_order")), "orders-1")
    k = 1
    while True:
        meets = orders.where((F.col("stream_order") >= k) & F.col("down").isNotNull()).groupBy(F.col("down").alias("at")).count().where("count > 1")
        marks = orders.join(meets, orders["id"] == meets["at"], "left").select("id", F.when(F.col("at").isNotNull(), 1).otherwise(0).cast("long").alias("marks"))
        marks = materialize(marks, f"meets-{k}")
        if marks.where("marks > 0").isEmpty():
            return orders.select("id", "stream_order")
        met = upstream_sums(marks, ["marks"], tables).where("marks > 0").select(F.col("id").alias("met"))
        k += 1
        orders = orders.join(met, orders["id"] == met["met"], "left").select("id", "down", F.when(F.col("met").isNotNull(), k).otherwise(F.col("stream_order")).alias("stream_order"))
        orders = materialize(orders, f"orders-{k}")


def mainstems(reaches: DataFrame) -> DataFrame:
    """id, mainstem_head of reaches(id, down, stream_order, total_area): the lowest reach of the stem that a reach belongs to.

    At a confluence the upstream reach of greatest (stream_order, total_area), then least id, goes on with the stem; others start their own.
    """
    best = W.partitionBy("down").orderBy(F.desc("stream_order"), F.desc("total_area"), "id")
    rank = reaches.withColumn("rank", F.row_number().over(best))
    stems = rank.select("id", F.when(F.col("rank") == 1, F.col("down")).alias("down"))
    return to_outlet(stems).select("id", F.col("outlet_id").alias("mainstem_head"))


def hydroseq(walked: DataFrame, forest: DataFrame) -> DataFrame:
    """id, hydroseq, dn_hydroseq, terminalpa from to_outlet's rows: numbers from 0 that grow upstream, continuous over basins by outlet id.

    Numbers go by (outlet, depth, id). They are put together from the sizes of basins and of their levels, so that a large basin isn't one task.
    """
    levels = walked.groupBy("outlet_id", "depth").count()
    basins = levels.groupBy("outlet_id").agg(F.sum("count").alias("n"))
    upto = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    basins = basins.select("outlet_id", F.coalesce(F.sum("n").over(upto(W.orderBy("outlet_id"))), F.lit(0)).alias("basin_start"))
    levels = levels.select("outlet_id", "depth", F.coalesce(F.sum("count").over(upto(W.partitionBy("outlet_id").orderBy("depth"))), F.lit(0)).alias("level_start"))
    place = F.row_number().over(W.partitionBy("outlet_id", "depth").orderBy("id")) - 1
    numbered = walked.withColumn("place", place).join(levels, ["outlet_id", "depth"]).join(basins, "outlet_id")
    numbered = materialize(numbered.select("id", (F.col("basin_start") + F.col("level_start") + F.col("place")).alias("hydroseq"), F.col("basin_start").alias("terminalpa")), "hydroseq")
    below = numbered.select(F.col("id").alias("down"), F.col("hydroseq").alias("below"))
    down = forest.select("id", "down")
    return numbered.join(down, "id").join(below, "down", "left").select("id", "hydroseq", F.coalesce("below", F.lit(0)).alias("dn_hydroseq"), "terminalpa")


def divergent(links: DataFrame) -> DataFrame:
    """up_id, n of links(up_id, dn_id) that flow into more than one reach."""
    return links.groupBy("up_id").agg(F.count("*").alias("n")).where("n > 1")


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (least node) of the weakly connected components of pairs, and so the groups that share a value.

    Rounds of contraction: each node picks the least of itself and its neighbours, in odd rounds by a hashed order so that any graph
    shrinks, and links move to the picked nodes until none is left between different ones.
    """
    tidy = lambda e: e.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    start = materialize(pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v")), "pairs")
    nodes = start.select(F.col("u").alias("node")).union(start.select("v")).distinct()
    live, picks = materialize(tidy(start), "links-0"), []
    while not live.isEmpty():
        k = len(picks)
        rank = (lambda c: F.xxhash64(F.lit(k), c)) if k % 2 else (lambda c: F.lit(0))  # noqa: B023
        ends = live.select("u", "v").union(live.select("v", "u")).union(live.select("u", "u")).union(live.select("v", "v"))
        picked = materialize(ends.groupBy("u").agg(F.min(F.struct(rank(F.col("v")).alias("rank"), F.col("v").alias("v"))).alias("best")).select("u", F.col("best.v").alias("r")), f"picked-{k}")
        picks.append(picked)
        moved = live.join(picked.withColumnRenamed("r", "ru"), "u").join(picked.select(F.col("u").alias("v"), F.col("r").alias("rv")), "v")
        live = materialize(tidy(moved.select(F.col("ru").alias("u"), F.col("rv").alias("v"))), f"links-{k + 1}")
    whole = nodes.withColumn("root", F.col("node"))
    for picked in picks:
        whole = whole.join(picked, whole["root"] == picked["u"], "left").select("node", F.coalesce("r", "root").alias("root"))
    whole = materialize(whole, "whole")
    least = whole.groupBy("root").agg(F.min("node").alias("component"))
    return whole.join(least, "root").select("node", "component")
