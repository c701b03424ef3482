"""Queries of zonal and raster operators. Lineitems are cells: zone the supplier, value the quantity, weight 1 - discount."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvial.operators import flows, zonal
from fluvial.plans.register import Register
from fluvial.session import table

register = Register()


def cells(spark: SparkSession, sf_dir: str, value: str = "l_quantity") -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("zone"), F.expr(value).alias("value"), (1 - F.col("l_discount")).alias("weight"))


@register("zonal_mean", "SELECT l_suppkey AS zone, round(sum(l_quantity * (1 - l_discount)) / sum(1 - l_discount), 6) AS value FROM lineitem GROUP BY 1")
def zonal_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal.statistics(cells(spark, sf_dir), value=F.round(zonal.mean(), 6))


@register("zonal_max", "SELECT l_suppkey AS zone, max(l_quantity) AS value FROM lineitem GROUP BY 1")
def zonal_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal.statistics(cells(spark, sf_dir), value=F.max("value"))


@register(
    "zonal_mode",
    """SELECT zone, arg_max(value, (weight, -value)) AS value FROM (SELECT l_suppkey AS zone, l_linenumber AS value, round(sum(1 - l_discount), 6) AS weight FROM lineitem GROUP BY ALL) GROUP BY zone""",
)
def zonal_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_value = zonal.touched(cells(spark, sf_dir, "l_linenumber")).groupBy("zone", "value").agg(F.round(F.sum("weight"), 6).alias("weight"))
    return zonal.mode(by_value)


@register(
    "zonal_circular",
    """SELECT zone, round(CASE WHEN d < 0 THEN d + 360 ELSE d END, 5) AS value FROM (
    SELECT l_suppkey AS zone, degrees(atan2(sum((1 - l_discount) * sin(radians(l_partkey % 360))), sum((1 - l_discount) * cos(radians(l_partkey % 360))))) AS d FROM lineitem GROUP BY 1)""",
)
def zonal_circular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal.statistics(cells(spark, sf_dir, "cast(l_partkey % 360 as double)"), value=F.round(zonal.circular_mean(), 5))


@register("zonal_geometric", "SELECT l_suppkey AS zone, round(exp(sum((1 - l_discount) * ln(l_quantity)) / sum(1 - l_discount)), 6) AS value FROM lineitem GROUP BY 1")
def zonal_geometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal.statistics(cells(spark, sf_dir), value=F.round(zonal.geometric_mean(), 6))


def _quantile_sql(levels: tuple[float, ...]) -> str:
    picks = ", ".join(f"min(CASE WHEN running / total >= {q} - 1e-9 THEN value END) AS q{round(100 * q)}" for q in levels)
    return f"""WITH v AS (SELECT l_suppkey AS zone, l_quantity AS value, sum(1 - l_discount) AS weight FROM lineitem WHERE l_discount < 1 GROUP BY ALL),
    r AS (SELECT zone, value, sum(weight) OVER (PARTITION BY zone ORDER BY value ROWS UNBOUNDED PRECEDING) AS running, sum(weight) OVER (PARTITION BY zone) AS total FROM v)
    SELECT zone, {picks} FROM r GROUP BY zone"""


@register("zonal_quantiles", _quantile_sql(zonal.QUARTILES))
def zonal_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal.quantiles(cells(spark, sf_dir), zonal.QUARTILES)


@register("zonal_deciles", _quantile_sql(zonal.DECILES))
def zonal_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal.quantiles(cells(spark, sf_dir), zonal.DECILES)


@register(
    "block_percent",
    """SELECT (event_id // 100) // 8 AS brow, (event_id % 100) // 8 AS bcol, round(avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct FROM events GROUP BY ALL""",
)
def block_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = table(spark, sf_dir, "events").select(F.expr("event_id div 100").alias("row"), (F.col("event_id") % 100).alias("col"), "event_type")
    out = zonal.block_percent(grid, 8, F.col("event_type") == "click")
    return out.select(F.col("block_row").alias("brow"), F.col("block_col").alias("bcol"), F.round("percent", 6).alias("pct"))


@register("burn_max_weight", """SELECT l_suppkey AS "row", l_linenumber::BIGINT AS col, arg_max(l_partkey, (l_extendedprice, -l_partkey)) AS value FROM lineitem GROUP BY ALL""")
def burn_max_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("row"), F.col("l_linenumber").cast("long").alias("col"), F.col("l_partkey").alias("value"), F.col("l_extendedprice").alias("weight"))
    return zonal.burn(rows)


@register(
    "mosaic",
    """WITH a AS (SELECT p_partkey AS cell, CASE WHEN p_size > 25 THEN p_retailprice END AS value FROM part), b AS (SELECT l_partkey AS cell, max(l_extendedprice) AS value FROM lineitem GROUP BY 1)
    SELECT coalesce(a.cell, b.cell) AS cell, coalesce(a.value, b.value) AS value FROM a FULL JOIN b ON a.cell = b.cell""",
)
def mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cell"), F.when(F.col("p_size") > 25, F.col("p_retailprice")).alias("value"))
    second = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("cell")).agg(F.max("l_extendedprice").alias("value"))
    return zonal.mosaic(first, second, ["cell"])


@register("mask_sentinels", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity IN (0, 1) THEN NULL ELSE l_quantity END AS value FROM lineitem")
def mask_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal.mask_values(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("value")), 0.0, 1.0)


@register(
    "regrid_nearest",
    """WITH g AS (SELECT event_id // 100 AS r, event_id % 100 AS c, value FROM events), t AS (SELECT DISTINCT (r / 2.5)::INT AS x, floor(r / 2.5)::BIGINT AS "row", floor(c / 2.5)::BIGINT AS col FROM g)
    SELECT DISTINCT t."row", t.col, g.value FROM t JOIN g ON g.r = floor((t."row" + 0.5) * 2.5) AND g.c = floor((t.col + 0.5) * 2.5)""",
)
def regrid_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = table(spark, sf_dir, "events").select(F.expr("event_id div 100").alias("row"), (F.col("event_id") % 100).alias("col"), "value")
    return zonal.regrid(grid, 10.0, 25.0)


@register(
    "slope_aspect",
    """WITH g AS (SELECT event_id // 100 AS r, event_id % 100 AS c, value AS v FROM events),
    n AS (SELECT a.r, a.c, count(*) AS n,
      sum((b.c - a.c) * CASE WHEN b.r = a.r THEN 2 ELSE 1 END * b.v) / 80.0 AS dx, sum((b.r - a.r) * CASE WHEN b.c = a.c THEN 2 ELSE 1 END * b.v) / 80.0 AS dy
      FROM g a JOIN g b ON b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY a.r, a.c)
    SELECT r AS "row", c AS col, round(degrees(atan(sqrt(dx * dx + dy * dy))), 5) AS slope FROM n WHERE n = 9""",
)
def slope_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = table(spark, sf_dir, "events").select(F.expr("event_id div 100").alias("row"), (F.col("event_id") % 100).alias("col"), "value")
    return zonal.slope_and_aspect(grid, 10.0).select("row", "col", F.round("slope", 5).alias("slope"))


@register(
    "month_delta",
    """SELECT cell, round(abs(max(m) - min(m)), 5) AS delta FROM (SELECT o_custkey AS cell, month(o_orderdate) AS mo, avg(o_totalprice) AS m FROM orders GROUP BY ALL) GROUP BY cell""",
)
def month_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cell"), F.month("o_orderdate").alias("month"), F.col("o_totalprice").alias("value"))
    return zonal.month_delta(rows).select("cell", F.round("delta", 5).alias("delta"))


@register("total_bounds", "SELECT min(l_quantity) - 5 AS min_x, min(l_tax) - 5 AS min_y, max(l_quantity) + 5 AS max_x, max(l_tax) + 5 AS max_y FROM lineitem")
def total_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonal.bounds(table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_tax").alias("y")), 5.0)


@register("unit_shares", "SELECT l_orderkey AS unit, l_linenumber AS member, round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 6) AS share FROM lineitem")
def unit_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), F.col("l_linenumber").alias("member"), F.col("l_quantity").alias("area"))
    return flows.unit_shares(members).select("unit", "member", F.round("share", 6).alias("share"))


@register(
    "unit_measures",
    """SELECT l_orderkey AS unit, round(sum(l_extendedprice) / 1000, 5) AS length_km, round(sum(l_quantity) / 1e6, 9) AS area_sqkm, max(l_partkey) AS hydroseq,
    arg_min(l_linenumber, (l_partkey, l_linenumber)) AS lowest, arg_max(l_linenumber, (l_partkey, -l_linenumber)) AS highest, count(*) AS n FROM lineitem GROUP BY 1""",
)
def unit_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("unit"), F.col("l_linenumber").alias("member"), F.col("l_partkey").alias("hydroseq"), F.col("l_extendedprice").alias("length_m"), F.col("l_quantity").alias("area_m2")
    )
    out = flows.unit_measures(members)
    return out.withColumns({"length_km": F.round("length_km", 5), "area_sqkm": F.round("area_sqkm", 9)})


@register(
    "fold_headwater",
    """SELECT CASE WHEN p_partkey >= 8 AND p_size < 10 THEN (p_partkey - 1) // 2 ELSE p_partkey END AS unit, round(sum(p_retailprice), 4) AS area FROM part GROUP BY 1""",
)
def fold_headwater(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    folds = part.where("p_partkey >= 8 AND p_size < 10").select(F.col("p_partkey").alias("unit"), F.expr("(p_partkey - 1) div 2").alias("into"))
    return flows.fold(part.select(F.col("p_partkey").alias("unit"), F.col("p_retailprice").alias("area")), folds).select("unit", F.round("area", 4).alias("area"))


@register(
    "weighted_flows",
    """WITH w AS (SELECT l_suppkey AS ref_id, l_linenumber AS comid, sum(1 - l_discount) AS fraction FROM lineitem GROUP BY ALL),
    f AS (SELECT o_custkey % 5 + 1 AS comid, date_trunc('month', o_orderdate)::DATE AS day, sum(o_totalprice) AS q FROM orders GROUP BY ALL),
    t AS (SELECT ref_id, sum(fraction) AS total FROM w WHERE comid IN (SELECT comid FROM f) GROUP BY 1),
    s AS (SELECT ref_id, day, sum(q * fraction) AS s FROM w JOIN f USING (comid) GROUP BY ALL)
    SELECT r.ref_id, d.day, round(coalesce(s / total, 0), 2) AS q FROM (SELECT DISTINCT ref_id FROM w) r CROSS JOIN (SELECT DISTINCT day FROM f) d LEFT JOIN s ON s.ref_id = r.ref_id AND s.day = d.day LEFT JOIN t ON t.ref_id = r.ref_id""",
)
def weighted_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("ref_id"), F.col("l_linenumber").alias("comid")).agg(F.sum(1 - F.col("l_discount")).alias("fraction"))
    daily = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 5 + 1).alias("comid"), F.trunc("o_orderdate", "month").alias("day")).agg(F.sum("o_totalprice").alias("q"))
    return flows.weighted_flows(weights, daily).select("ref_id", "day", F.round("q", 2).alias("q"))


@register(
    "flow_disaggregate",
    """SELECT o_orderpriority AS key, day::TIMESTAMP + INTERVAL 1 HOUR * h AS hour, round(q / 24, 6) AS q FROM (SELECT o_orderpriority, o_orderdate::DATE AS day, sum(o_totalprice) AS q FROM orders GROUP BY ALL), range(24) t(h)""",
)
def flow_disaggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("key"), F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("q"))
    return flows.hourly(daily).select("key", F.col("hour").cast("timestamp_ntz").alias("hour"), F.round("q", 6).alias("q"))
