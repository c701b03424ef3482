"""Network queries. The reaches are the parts: ids 0 to n - 1, reach i >= 8 flows into (i - 1) div 2, the first eight are outlets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvial.operators import graph
from fluvial.plans.register import Register
from fluvial.session import table

register = Register()
N_OUTLETS = 8


def reaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, down, hydroseq, dnhydroseq, area, length."""
    i = F.col("p_partkey")
    down = F.when(i >= N_OUTLETS, F.expr("(p_partkey - 1) div 2"))
    return table(spark, sf_dir, "part").select(
        i.alias("id"), down.alias("down"), (i + 1).alias("hydroseq"), F.coalesce(down + 1, F.lit(0)).alias("dnhydroseq"), (F.col("p_retailprice") / 1000).alias("area"), F.col("p_size").cast("double").alias("length")
    )


NET = """WITH RECURSIVE r AS (
  SELECT p_partkey AS id, CASE WHEN p_partkey >= 8 THEN (p_partkey - 1) // 2 END AS down, p_retailprice / 1000 AS area, p_size::DOUBLE AS length FROM part),
up AS (SELECT id, id AS pos, 0::BIGINT AS depth, 0.0::DOUBLE AS path FROM r
  UNION ALL SELECT up.id, r.down, depth + 1, path + b.length FROM up JOIN r ON up.pos = r.id JOIN r b ON b.id = r.down),
walked AS (SELECT id, pos AS outlet_id, depth, path FROM up WHERE pos < 8),
total AS (SELECT up.pos AS id, sum(r.area) AS total_area, count(*) AS n FROM up JOIN r USING (id) GROUP BY up.pos)
"""


@register("net_edges", "SELECT p_partkey AS up_id, (p_partkey - 1) // 2 AS dn_id FROM part WHERE p_partkey >= 8")
def net_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.edges(reaches(spark, sf_dir))


@register(
    "net_upstream_lists",
    """SELECT (p_partkey - 1) // 2 AS dn_id, count(*) AS n_up, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS ups
       FROM part WHERE p_partkey >= 8 GROUP BY 1""",
)
def net_upstream_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = graph.upstream_lists(graph.edges(reaches(spark, sf_dir)))
    return lists.select("dn_id", F.size("ups").cast("long").alias("n_up"), F.array_join(F.transform("ups", lambda x: x.cast("string")), ",").alias("ups"))


@register("net_outlets", "SELECT p_partkey::VARCHAR AS id FROM part WHERE p_partkey < 8 ORDER BY 1")
def net_outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.outlets(reaches(spark, sf_dir)).select(F.col("id").cast("string").alias("id")).orderBy("id")


@register(
    "net_shared_nexus",
    """SELECT a.p_partkey AS up_id, b.p_partkey AS dn_id FROM part a JOIN part b ON (a.p_partkey - 1) // 2 = b.p_partkey WHERE a.p_partkey >= 8""",
)
def net_shared_nexus(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reaches(spark, sf_dir)
    fp = r.select(F.col("id").alias("fp_id"), (F.col("id") + 1_000_000).alias("up_nex_id"), (F.col("down") + 1_000_000).alias("dn_nex_id"))
    return graph.connected(fp)


@register("net_outlet_label", NET + "SELECT id, outlet_id, depth FROM walked")
def net_outlet_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.to_outlet(reaches(spark, sf_dir)).select("id", "outlet_id", "depth")


@register("net_basin_summary", NET + "SELECT outlet_id, count(*) AS n, round(sum(area), 4) AS area, max(depth) AS depth FROM walked JOIN r USING (id) GROUP BY outlet_id")
def net_basin_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reaches(spark, sf_dir)
    walked = graph.to_outlet(r).join(r.select("id", "area"), "id")
    return walked.groupBy("outlet_id").agg(F.count("*").alias("n"), F.round(F.sum("area"), 4).alias("area"), F.max("depth").alias("depth"))


@register("net_total_area", NET + "SELECT id, round(total_area, 4) AS total_area FROM total")
def net_total_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reaches(spark, sf_dir)
    return graph.upstream_sums(r, ["area"], graph.jump_tables(r)).select("id", F.round("area", 4).alias("total_area"))


@register("net_ancestor_count", NET + "SELECT id, n - 1 AS n_anc FROM total")
def net_ancestor_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reaches(spark, sf_dir).withColumn("n", F.lit(1).cast("long"))
    return graph.upstream_sums(r, ["n"], graph.jump_tables(r)).select("id", (F.col("n") - 1).alias("n_anc"))


@register("net_path_length", NET + "SELECT id, path AS path_length FROM walked")
def net_path_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.to_outlet(reaches(spark, sf_dir), F.col("length")).select("id", F.col("path").alias("path_length"))


#: Strahler orders bottom up, one level of the recursion for each order: a reach is of order k + 1 or more where two of order k or more meet upstream.
ORDER = """,
o1 AS (SELECT id, down, 1 AS o FROM r),
""" + "".join(
    f"m{k} AS (SELECT down AS pos FROM o{k} WHERE o >= {k} AND down IS NOT NULL GROUP BY down HAVING count(*) > 1),\n"
    f"o{k + 1} AS (SELECT o.id, o.down, CASE WHEN EXISTS (SELECT 1 FROM s{k} WHERE s{k}.id = o.id) THEN {k + 1} ELSE o.o END AS o FROM o{k} o),\n".replace(
        f"o{k + 1} AS", f"s{k} AS (SELECT DISTINCT up.pos AS id FROM up JOIN m{k} ON up.id = m{k}.pos),\no{k + 1} AS"
    )
    for k in range(1, 17)
)


@register("net_stream_order", NET.rstrip() + ORDER + "x AS (SELECT 1) SELECT id, o AS stream_order FROM o17")
def net_stream_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.stream_order(reaches(spark, sf_dir))


MAINSTEM = """,
kept AS (SELECT o.id, CASE WHEN row_number() OVER (PARTITION BY o.down ORDER BY o.o DESC, round(t.total_area, 4) DESC, o.id) = 1 THEN o.down END AS down
         FROM o17 o JOIN total t USING (id)),
stem AS (SELECT id, id AS pos FROM kept UNION ALL SELECT stem.id, kept.down FROM stem JOIN kept ON stem.pos = kept.id WHERE kept.down IS NOT NULL)
SELECT stem.id, stem.pos AS mainstem_head FROM stem JOIN kept ON stem.pos = kept.id WHERE kept.down IS NULL
"""


@register("net_mainstem", NET.rstrip() + ORDER + "x AS (SELECT 1)" + MAINSTEM)
def net_mainstem(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reaches(spark, sf_dir)
    tables = graph.jump_tables(r)
    area = graph.upstream_sums(r, ["area"], tables).select("id", F.round("area", 4).alias("total_area"))
    return graph.mainstems(r.select("id", "down").join(graph.stream_order(r, tables), "id").join(area, "id"))


@register(
    "net_hydroseq",
    NET
    + """, s AS (SELECT id, outlet_id, row_number() OVER (ORDER BY outlet_id, depth, id) - 1 AS hydroseq FROM walked)
    SELECT s.id, s.hydroseq, coalesce(d.hydroseq, 0) AS dn_hydroseq, min(s.hydroseq) OVER (PARTITION BY s.outlet_id) AS terminalpa
    FROM s JOIN r ON s.id = r.id LEFT JOIN s d ON d.id = r.down""",
)
def net_hydroseq(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reaches(spark, sf_dir)
    return graph.hydroseq(graph.to_outlet(r), r)


@register("net_cycle_check", "SELECT 'cyclic' AS check_name, (SELECT count(*) FROM part WHERE p_partkey = 9 OR p_partkey % 1000 = 999)::BIGINT AS n")
def net_cycle_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reaches on cycles, after reach 9 and each last of a thousand were turned onto themselves; leaves only, so nothing flows into most."""
    r = reaches(spark, sf_dir)
    turned = (F.col("id") == 9) | (F.col("id") % 1000 == 999)
    looped = r.select("id", F.when(turned, F.col("id")).otherwise(F.when(F.col("id") < N_OUTLETS, None).otherwise(F.lit(0))).alias("down"))
    return graph.cyclic(looped).agg(F.lit("cyclic").alias("check_name"), F.count("*").alias("n"))


@register(
    "net_divergence",
    """SELECT up_id, count(*) AS n FROM (SELECT p_partkey AS up_id FROM part WHERE p_partkey >= 8 UNION ALL SELECT n_nationkey FROM nation WHERE n_nationkey >= 8) GROUP BY up_id HAVING count(*) > 1""",
)
def net_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reaches that flow into two, after links from the nations' ids to their regions' were added."""
    added = table(spark, sf_dir, "nation").where(F.col("n_nationkey") >= N_OUTLETS).select(F.col("n_nationkey").cast("long").alias("up_id"), F.col("n_regionkey").cast("long").alias("dn_id"))
    return graph.divergent(graph.edges(reaches(spark, sf_dir)).unionByName(added))


@register("net_components")
def net_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakly connected components of orders and suppliers over the lineitems."""
    pairs = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 2).alias("a"), (F.col("l_suppkey") * 2 + 1).alias("b"))
    return graph.components(pairs, "a", "b")


@register(
    "chain_position",
    """SELECT event_id, count(*) OVER w - 1 AS depth, round(coalesce(sum(value) OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 3) AS path_value
       FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts DESC, event_id DESC)""",
)
def chain_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth and summed value of chains thousands of links deep: each event flows into the next of its type."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type", "ts", "value")
    links = e.withColumn("down", F.lead("id").over(W.partitionBy("event_type").orderBy("ts", "id")))
    return graph.to_outlet(links, F.col("value")).select(F.col("id").alias("event_id"), "depth", F.round("path", 3).alias("path_value"))


@register("net_simplify")
def net_simplify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of all reaches; orders and divides come from the parts' network and sizes. The machine has no SQL; its invariants are tested."""
    from fluvial.operators import simplify

    r = reaches(spark, sf_dir)
    walked, order = graph.to_outlet(r), graph.stream_order(r)
    rows = r.join(walked.select("id", "outlet_id"), "id").join(order, "id")
    rows = rows.select("outlet_id", "id", "down", "stream_order", "area", (F.col("length") / 10).alias("length"), (F.col("length") % 7 != 0).alias("has_divide"))
    return simplify.classify(rows)
