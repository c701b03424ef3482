"""Queries of shapes on cells, of the small building rules, and of lakes and gages. Suppliers, customers and parts stand in for the features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvial.operators import coverage, gages, graph, lakes, outlets, zonal
from fluvial.plans.network import NET, reaches
from fluvial.plans.register import Register
from fluvial.session import table

register = Register()

#: L-shaped zones, one a supplier: a flat box with a tall one on its left end.
SHAPES = """WITH s AS (SELECT s_suppkey AS zone, (s_suppkey % 10) * 3 + 0.3 AS x, (s_suppkey // 10) * 2.5 - 4.3 AS y FROM supplier),
b AS (SELECT zone, x AS x0, x + 3.5 AS x1, y AS y0, y + 1.25 AS y1 FROM s UNION ALL SELECT zone, x, x + 1.5, y + 1.25, y + 4 FROM s),
w AS (SELECT zone, r.row, c.col, sum((least(x1, c.col + 1) - greatest(x0, c.col)) * (least(y1, r.row + 1) - greatest(y0, r.row))) AS weight
  FROM b, (SELECT unnest(range(-6, 400)) AS row) r, (SELECT unnest(range(-2, 40)) AS col) c
  WHERE r.row < y1 AND r.row + 1 > y0 AND c.col < x1 AND c.col + 1 > x0 GROUP BY ALL)
"""


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), ((F.col("s_suppkey") % 10) * 3 + 0.3).alias("x"), (F.expr("s_suppkey div 10") * 2.5 - 4.3).alias("y"))
    p = lambda dx, dy: F.struct((F.col("x") + dx).cast("double").alias("x"), (F.col("y") + dy).cast("double").alias("y"))
    return s.select("id", F.array(p(0, 0), p(3.5, 0), p(3.5, 1.25), p(1.5, 1.25), p(1.5, 4), p(0, 4), p(0, 0)).alias("ring"))


@register("cell_coverage", SHAPES + "SELECT zone, row::BIGINT AS row, col::BIGINT AS col, round(weight, 6) AS weight FROM w WHERE weight > 1e-9")
def cell_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered share of every cell under L-shaped zones."""
    return coverage.cell_weights(shapes(spark, sf_dir), 1.0).where("weight > 1e-9").withColumn("weight", F.round("weight", 6))


@register("zonal_from_rings", SHAPES + "SELECT zone, round(sum(weight * abs((row * 7 + col * 3) % 11)) / sum(weight), 6) AS value FROM w GROUP BY zone")
def zonal_from_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zonal means that start from rings and cells."""
    weights = coverage.cell_weights(shapes(spark, sf_dir), 1.0)
    cells = weights.select("row", "col").distinct().withColumn("value", F.abs((F.col("row") * 7 + F.col("col") * 3) % 11).cast("double"))
    return zonal.statistics(weights.join(cells, ["row", "col"]).select("zone", "value", "weight"), value=F.round(zonal.mean(), 6))


CELLS = "c AS (SELECT p_partkey // 40 AS row, p_partkey % 40 AS col, CASE WHEN p_size <> 7 THEN p_retailprice END AS value FROM part)"


def elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of parts; those of size 7 have no data."""
    value = F.when(F.col("p_size") == 7, F.lit(-999999.0)).otherwise(F.col("p_retailprice"))
    return table(spark, sf_dir, "part").select(F.expr("p_partkey div 40").alias("row"), (F.col("p_partkey") % 40).alias("col"), value.alias("value"))


@register("point_elevation", f"WITH {CELLS} SELECT c_custkey AS id, round(value, 6) AS value FROM customer LEFT JOIN c ON row = (c_custkey * 3) // 70 AND col = c_custkey % 43")
def point_elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 43 + 0.5).alias("x"), (F.expr("c_custkey * 3 div 70") + 0.25).alias("y"))
    return coverage.cell_values(points, elevation(spark, sf_dir), 1.0, -999999.0).select("id", F.round("value", 6).alias("value"))


@register(
    "end_elevation",
    f"""WITH {CELLS}, e AS (SELECT o_custkey AS id, o_orderkey % 43 AS col, o_orderkey % 57 AS row FROM orders UNION ALL SELECT o_custkey, o_orderkey % 31, o_orderkey % 23 FROM orders)
    SELECT id, round(avg(value), 6) AS value FROM e LEFT JOIN c USING (row, col) GROUP BY id""",
)
def end_elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean elevation of the ends of lines of several parts."""
    p = lambda x, y: F.struct((F.col("o_orderkey") % x + 0.5).alias("x"), (F.col("o_orderkey") % y + 0.5).alias("y"))
    lines = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.array(p(43, 57), p(5, 5), p(31, 23)).alias("line"))
    return coverage.end_values(lines, elevation(spark, sf_dir), 1.0, -999999.0).withColumn("value", F.round("value", 6))


@register("remaining_share", "SELECT l_partkey AS div_id, round(greatest(1 - sum(l_discount), 0), 6) AS remaining FROM lineitem GROUP BY 1")
def remaining_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("div_id"), F.col("l_discount").alias("share"))
    return outlets.remaining_share(shares).withColumn("remaining", F.round("remaining", 6))


@register(
    "choose_downstream",
    """SELECT l_orderkey AS id, arg_max(l_partkey, (coalesce(CASE WHEN p_partkey % 5 <> 0 THEN p_size::DOUBLE END, -1), -l_partkey)) AS down FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def choose_downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_size").cast("double")).alias("path_length"))
    return outlets.choose_downstream(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("down")), paths)


@register(
    "fallback_segments",
    """SELECT s_suppkey AS virtual_fp_id, s_nationkey AS div_id, 0.5::DOUBLE AS share FROM supplier WHERE s_acctbal > 6000
       UNION ALL SELECT n_nationkey + 1000, n_nationkey, 1.0 FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 6000)""",
)
def fallback_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    divides = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("div_id"), (F.col("n_nationkey") + 1000).cast("long").alias("fp_id"))
    virtual = table(spark, sf_dir, "supplier").where("s_acctbal > 6000").select(F.col("s_suppkey").alias("virtual_fp_id"), F.col("s_nationkey").alias("div_id"), F.lit(0.5).alias("share"))
    return outlets.with_fallbacks(divides, virtual)


@register(
    "combine_outlets",
    """WITH n AS (SELECT c_custkey AS nex_id, min(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 3 END) AS kept FROM customer)
    SELECT o_orderkey AS fp_id, coalesce(u.kept, o_custkey + 1) AS up_nex_id, coalesce(d.kept, o_custkey) AS dn_nex_id
    FROM orders LEFT JOIN n u ON u.nex_id = o_custkey + 1 LEFT JOIN n d ON d.nex_id = o_custkey""",
)
def combine_outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of several outlets on nexuses of which those at one place that flow into one path were merged."""
    down = F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey") % 3)
    nexuses = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("nex_id"), F.col("c_nationkey").alias("x"), F.col("c_mktsegment").alias("y"), down.alias("dn_fp_id"))
    paths = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("fp_id"), (F.col("o_custkey") + 1).alias("up_nex_id"), F.col("o_custkey").alias("dn_nex_id"))
    return outlets.combine(paths, nexuses)[0]


@register(
    "domain_bounds",
    """SELECT c_custkey AS id FROM customer LEFT JOIN (VALUES (1, 0, 5000, 2), (2, -500, 3000, 9), (3, -1000, 9000, 4)) l(d, lo, hi, most) ON d = c_nationkey % 5
       WHERE NOT coalesce(c_acctbal BETWEEN lo AND hi AND c_custkey % 10 BETWEEN 0 AND most, false)""",
)
def domain_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points outside the limits of their domain."""
    limits = spark.createDataFrame([(1, 0.0, 5000.0, 0.0, 2.0), (2, -500.0, 3000.0, 0.0, 9.0), (3, -1000.0, 9000.0, 0.0, 4.0)], "domain int, x0 double, x1 double, y0 double, y1 double")
    points = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 5).alias("domain"), F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 10).alias("y"))
    return outlets.outside(points, limits).select("id")


@register("class_parameters", "SELECT p_partkey AS id, CASE p_size WHEN 1 THEN 0.5 WHEN 2 THEN 0.75 WHEN 11 THEN 1.25 END::DOUBLE AS value, CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN '0' || p_brand ELSE p_brand END AS code FROM part")
def class_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = outlets.by_class(F.col("p_size"), {1: 0.5, 2: 0.75, 11: 1.25})
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), value.alias("value"), outlets.prefixed(F.col("p_brand"), ["Brand#11", "Brand#12"]).alias("code"))


@register("confirmed_dams", "SELECT o_orderkey::VARCHAR AS dam_id, o_orderpriority AS name, 'lhd' AS source FROM orders WHERE o_orderstatus = 'F'")
def confirmed_dams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outlets.confirmed(table(spark, sf_dir, "orders"), "o_orderstatus", "F", {"o_orderkey": "dam_id", "o_orderpriority": "name"}, {"source": "lhd"})


@register("forest_components", NET + "SELECT id AS node, outlet_id AS component FROM walked WHERE id >= 8 OR id IN (SELECT down FROM r)")
def forest_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected components of the reaches' links: each river's, known by its outlet, the least id."""
    return graph.components(reaches(spark, sf_dir).where("down IS NOT NULL"), "id", "down")


# Lakes and gages

LAKES = "l AS (SELECT (l_orderkey % 700)::VARCHAR AS lake_id, CASE WHEN l_linenumber = 3 THEN 'nwm' WHEN l_linenumber = 1 THEN NULL ELSE 'nid' END AS source, CASE WHEN l_partkey % 4 > 0 THEN l_partkey::DOUBLE END AS hydroseq, l_orderkey::VARCHAR || '-' || l_linenumber AS dam_id FROM lineitem)"


@register("dedup_lakes", f"WITH {LAKES} SELECT lake_id, arg_min(dam_id, (CASE WHEN coalesce(source, '') <> 'nwm' THEN 1 ELSE 0 END, hydroseq IS NULL, coalesce(hydroseq, 0), dam_id)) AS dam_id FROM l GROUP BY 1")
def dedup_lakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 700).cast("string").alias("lake_id"), F.when(n == 3, "nwm").when(n != 1, "nid").alias("source"), F.when(F.col("l_partkey") % 4 > 0, F.col("l_partkey").cast("double")).alias("hydroseq"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("dam_id")
    )
    return lakes.dedup_lakes(rows).select("lake_id", "dam_id")


@register("reservoir_criteria", "SELECT c_custkey AS id FROM customer WHERE c_nationkey % 7 <> 0 AND c_custkey NOT IN (SELECT s_suppkey FROM supplier) AND ((c_custkey % 100 < 60 AND c_acctbal >= 1000) OR c_custkey IN (101, 150))")
def reservoir_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("c_custkey").cast("string")
    rows = table(spark, sf_dir, "customer").select(text.alias("dam_id"), F.when(F.col("c_nationkey") % 7 != 0, F.col("c_nationkey")).alias("ref_fab_wb"), (F.col("c_custkey") % 100).alias("distance"), F.col("c_acctbal").alias("area"))
    taken = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("dam_id"))
    return lakes.reservoir_criteria(rows, [taken], most_distance=60, least_area=1000, keep=("101", "150")).select(F.col("dam_id").cast("long").alias("id"))


@register(
    "lake_assimilation",
    """WITH s AS (SELECT l_orderkey % 900 AS lake_id, l_suppkey::VARCHAR AS site_no, (l_linenumber % 7 + 1)::INT AS da_type, CASE WHEN l_partkey % 2 = 0 THEN 0 ELSE 1 END AS nth FROM lineitem WHERE l_quantity < 6),
    u AS (SELECT * FROM s QUALIFY count(*) OVER (PARTITION BY lake_id, da_type) = 1),
    b AS (SELECT lake_id, arg_max({'site': site_no, 'da': da_type}, (CASE WHEN da_type = 6 THEN 3 WHEN da_type = 4 THEN 2 WHEN da_type > 1 THEN 1 ELSE 0 END, -nth, site_no, da_type)) AS v FROM u GROUP BY 1)
    SELECT c_custkey AS nhf_lake_id, coalesce(v.da, 1) AS da_type FROM customer LEFT JOIN b ON lake_id = c_custkey""",
)
def lake_assimilation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where("l_quantity < 6").select((F.col("l_orderkey") % 900).alias("lake_id"), F.col("l_suppkey").cast("string").alias("site_no"), (F.col("l_linenumber") % 7 + 1).cast("int").alias("da_type"), (F.col("l_partkey") % 2).alias("odd"))
    own = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("nhf_lake_id"), F.col("c_custkey").alias("lake_id"))
    return lakes.assimilation(own, rows.where("odd = 0").drop("odd"), rows.where("odd = 1").drop("odd")).select("nhf_lake_id", "da_type")


@register("forecast_points", "SELECT c_custkey AS site_no FROM customer WHERE c_mktsegment = 'BUILDING' OR c_custkey IN (SELECT l_suppkey FROM lineitem)")
def forecast_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("site_no"), F.col("c_mktsegment").alias("forecast_status"))
    return gages.forecast_points(rows, table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("site_no")), "BUILDING").select("site_no")


@register("append_unknown_gages", "SELECT n_name AS site_no, 'active' AS status FROM nation UNION ALL SELECT trim(r_name), 'routelink' FROM region WHERE trim(r_name) <> '' AND trim(r_name) NOT IN (SELECT n_name FROM nation)")
def append_unknown_gages(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = table(spark, sf_dir, "nation").select(F.col("n_name").alias("site_no"), F.lit("active").alias("status"))
    more = table(spark, sf_dir, "region").select(F.concat(F.lit(" "), "r_name").alias("site_no")).unionByName(table(spark, sf_dir, "nation").limit(3).select(F.col("n_name").alias("site_no")))
    return gages.append_unknown(master, more.unionByName(spark.createDataFrame([("  ",)], "site_no string")))
