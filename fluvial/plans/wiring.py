"""Queries of segments and references, tributaries, joined divides, ends of lines, and polygons on flowpaths. Orders, lines and reaches stand in for the features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvial.operators import overlays, wiring
from fluvial.plans.network import reaches
from fluvial.plans.outlets import shapes
from fluvial.plans.register import Register
from fluvial.session import table

register = Register()

#: Three segments a unit, every third unit's second without length; a reference for each part of an order.
SEGMENTS = """WITH u AS (SELECT DISTINCT l_orderkey AS unit FROM lineitem),
s AS (SELECT unit, k, unit * 10 + k AS seg_id, ((k - 1) * 10 + unit % 4)::DOUBLE AS a, ((k - 1) * 10 + unit % 4 + CASE WHEN k = 2 AND unit % 3 = 0 THEN 0 ELSE 10 END)::DOUBLE AS b
  FROM u, (SELECT unnest([1, 2, 3]) AS k)),
r AS (SELECT l_orderkey AS unit, l_partkey AS ref_id, min(l_quantity) % 30 AS a, min(l_quantity) % 30 + max(l_suppkey) % 13 + 1 AS b FROM lineitem GROUP BY ALL)
"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit")).distinct()
    rows = units.select("unit", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k"))
    a = (F.col("k") - 1) * 10 + F.col("unit") % 4
    size = F.when((F.col("k") == 2) & (F.col("unit") % 3 == 0), 0).otherwise(10)
    return rows.select("unit", (F.col("unit") * 10 + F.col("k")).alias("seg_id"), a.cast("double").alias("a"), (a + size).cast("double").alias("b"))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("unit"), F.col("l_partkey").alias("ref_id")).agg((F.min("l_quantity") % 30).alias("a"), (F.max("l_suppkey") % 13 + 1).alias("n"))
    return rows.select("unit", "ref_id", F.col("ref_id").alias("rank"), "a", (F.col("a") + F.col("n")).alias("b"))


_SCORE = "CASE WHEN least({s}.b, {r}.b) > greatest({s}.a, {r}.a) THEN least({s}.b, {r}.b) - greatest({s}.a, {r}.a) ELSE -abs(({r}.a + {r}.b) / 2 - ({s}.a + {s}.b) / 2) END"


def _taken(k: int) -> str:
    """The pick of the k-th segment among the references that the earlier ones left."""
    earlier = "".join(f" AND ref_id NOT IN (SELECT ref_id FROM t{j} WHERE t{j}.unit = p.unit)" for j in range(1, k))
    return f"t{k} AS (SELECT unit, seg_id, ref_id FROM p WHERE k = {k}{earlier} QUALIFY row_number() OVER (PARTITION BY unit ORDER BY score DESC, ref_id) = 1)"


@register(
    "assign_references",
    SEGMENTS
    + f""", p AS (SELECT s.unit, s.k, seg_id, ref_id, {_SCORE.format(s="s", r="r")} AS score FROM s JOIN r ON s.unit = r.unit WHERE s.b > s.a),
{_taken(1)}, {_taken(2)}, {_taken(3)}, t AS (FROM t1 UNION ALL FROM t2 UNION ALL FROM t3),
f AS (SELECT unit, ref_id, seg_id FROM p QUALIFY row_number() OVER (PARTITION BY unit, ref_id ORDER BY score DESC, k) = 1)
SELECT f.unit, f.ref_id, coalesce(t.seg_id, f.seg_id) AS seg_id FROM f LEFT JOIN t ON t.unit = f.unit AND t.ref_id = f.ref_id""",
)
def assign_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiring.assign_references(segments(spark, sf_dir), references(spark, sf_dir))


@register(
    "segment_at",
    SEGMENTS
    + """SELECT s.unit, ref_id, seg_id FROM s JOIN r ON s.unit = r.unit WHERE s.b > s.a
QUALIFY row_number() OVER (PARTITION BY s.unit, ref_id ORDER BY CASE WHEN (r.a + r.b) / 2 BETWEEN s.a AND s.b THEN 0 ELSE 1 END,
  least(abs((r.a + r.b) / 2 - s.a), abs((r.a + r.b) / 2 - s.b)) * CASE WHEN (r.a + r.b) / 2 BETWEEN s.a AND s.b THEN 0 ELSE 1 END, k) = 1""",
)
def segment_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = references(spark, sf_dir).select("unit", "ref_id", ((F.col("a") + F.col("b")) / 2).alias("at"))
    return wiring.segment_at(segments(spark, sf_dir), places)


#: Reaches from 8 on flow into (i - 1) // 2. Those of i % 3 = 0 are chains with the two that follow as members; units are reaches of i % 5 < 3, by tens; nexuses are at i % 4 = 0.
TRIBUTARIES = """WITH c AS (SELECT p_partkey AS dn_ref, [p_partkey, p_partkey + 1, p_partkey + 2] AS refs, p_partkey % 97 AS hydroseq, p_size::DOUBLE AS length_km FROM part WHERE p_partkey % 3 = 0),
n AS (SELECT *, 1000 + row_number() OVER (ORDER BY hydroseq, dn_ref) AS virtual_fp_id, CASE WHEN dn_ref >= 8 THEN (dn_ref - 1) // 2 END AS below FROM c),
p AS (SELECT *, below // 10 AS div_id FROM n WHERE below % 5 < 3),
m AS (SELECT virtual_fp_id, div_id, unnest(refs) AS ref_id FROM p)
"""


def _tributaries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    i = F.col("p_partkey")
    part = table(spark, sf_dir, "part")
    chains = part.where(i % 3 == 0).select(i.alias("dn_ref"), F.array(i, i + 1, i + 2).alias("refs"), (i % 97).alias("hydroseq"), F.col("p_size").cast("double").alias("length_km"), F.lit(0.0).alias("area_sqkm"))
    units = part.where(i % 5 < 3).select(F.expr("p_partkey div 10").alias("unit"), i.alias("ref_id"))
    shares = part.where(i % 7 != 0).select(i.alias("ref_id"), ((i % 8) / 64).alias("share"))
    nexuses = part.where(i % 4 == 0).select(i.alias("ref_id"), (-i).alias("nex_id"))
    return wiring.tributaries(chains, reaches(spark, sf_dir), units, shares, nexuses, 1001)


@register(
    "tributaries",
    TRIBUTARIES
    + """, s AS (SELECT virtual_fp_id, sum((ref_id % 8) / 64) AS share FROM m WHERE ref_id % 7 <> 0 AND ref_id IN (SELECT p_partkey FROM part) GROUP BY ALL)
SELECT virtual_fp_id, CASE WHEN below % 4 = 0 THEN -below ELSE virtual_fp_id END AS dn_virtual_nex_id, div_id, length_km, 0::DOUBLE AS area_sqkm, coalesce(share, 0) AS share, below % 4 <> 0 AS new_nexus
FROM p LEFT JOIN s USING (virtual_fp_id)""",
)
def tributaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tributaries(spark, sf_dir)[0]


@register("tributary_references", TRIBUTARIES + "SELECT ref_id, max(virtual_fp_id) AS virtual_fp_id, arg_max(div_id, virtual_fp_id) AS div_id FROM m GROUP BY ref_id")
def tributary_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tributaries(spark, sf_dir)[1]


#: Divides are reaches; virtual flowpaths are orders, of which two neighbours may share a nexus; three of four divides have a head nexus, most others a fallback.
WIRES = """WITH d AS (SELECT p_partkey AS fp_id, CASE WHEN p_partkey >= 8 THEN (p_partkey - 1) // 2 END AS fp_to_id FROM part),
v AS (SELECT o_orderkey AS virtual_fp_id, (o_custkey * 7 + o_orderkey) % 1500 AS div_id, 100000 + o_orderkey % 3000 AS up_virtual_nex_id, 200000 + o_orderkey // 2 AS dn_virtual_nex_id FROM orders),
fed AS (SELECT DISTINCT dn_virtual_nex_id AS nex_id, dn_virtual_nex_id - 200000 AS virtual_fp_id FROM v WHERE dn_virtual_nex_id % 5 = 0),
x AS (SELECT v.*, CASE WHEN fp_to_id % 4 < 3 THEN 100000 + fp_to_id END AS head, CASE WHEN fp_to_id % 8 = 3 THEN -fp_to_id END AS feeds
  FROM v LEFT JOIN d ON d.fp_id = v.div_id),
e AS (SELECT dn_virtual_nex_id AS nex_id, min(div_id) AS div_id, arg_min(feeds IS NULL, div_id) AS moves, arg_min(coalesce(feeds, 0), div_id) AS feeds FROM x
  WHERE dn_virtual_nex_id NOT IN (SELECT nex_id FROM fed) AND ((head IS NOT NULL AND head <> up_virtual_nex_id) OR feeds IS NOT NULL) GROUP BY ALL)
"""


def _wired(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    paths = reaches(spark, sf_dir).select(F.col("id").alias("fp_id"), F.col("down").alias("fp_to_id"))
    o = F.col("o_orderkey")
    virtual = table(spark, sf_dir, "orders").select(o.alias("virtual_fp_id"), ((F.col("o_custkey") * 7 + o) % 1500).alias("div_id"), (o % 3000 + 100000).alias("up_virtual_nex_id"), (F.expr("o_orderkey div 2") + 200000).alias("dn_virtual_nex_id"))
    fed = virtual.where("dn_virtual_nex_id % 5 = 0").select(F.col("dn_virtual_nex_id").alias("nex_id"), (F.col("dn_virtual_nex_id") - 200000).alias("virtual_fp_id")).distinct()
    heads = paths.where("fp_id % 4 < 3").select("fp_id", (F.col("fp_id") + 100000).alias("nex_id"))
    fallbacks = paths.where("fp_id % 8 = 3").select("fp_id", (-F.col("fp_id")).alias("virtual_fp_id"))
    return wiring.wire(paths, virtual, fed, heads, fallbacks)


@register(
    "wire_divides",
    WIRES
    + """SELECT virtual_fp_id, x.div_id, up_virtual_nex_id,
CASE WHEN moves AND head IS NOT NULL AND head <> up_virtual_nex_id THEN head ELSE dn_virtual_nex_id END AS dn_virtual_nex_id FROM x LEFT JOIN e ON e.nex_id = x.dn_virtual_nex_id""",
)
def wire_divides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wired(spark, sf_dir)[0]


@register("wire_removed", WIRES + "SELECT nex_id FROM e WHERE moves")
def wire_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wired(spark, sf_dir)[1]


@register("wire_fed", WIRES + "SELECT nex_id, virtual_fp_id FROM fed UNION ALL SELECT nex_id, feeds FROM e WHERE NOT moves")
def wire_fed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wired(spark, sf_dir)[2]


@register(
    "main_ends",
    """WITH l AS (SELECT o_custkey AS id, o_orderkey AS part, o_orderkey % 7 AS x0, o_orderkey % 5 AS y0, (o_orderkey * 3) % 11 AS x1, o_orderkey % 6 AS y1 FROM orders),
e AS (SELECT id, part * 2 AS no, x0 AS x, y0 AS y FROM l UNION ALL SELECT id, part * 2 + 1, x1, y1 FROM l),
p AS (SELECT id, x, y, count(*) AS n, min(no) AS no FROM e GROUP BY ALL),
c AS (SELECT * FROM p WHERE n = 1 OR id NOT IN (SELECT id FROM p WHERE n = 1)),
q AS (SELECT a.id, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS "by", sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS dist, a.no AS i, b.no AS j FROM c a JOIN c b ON a.id = b.id AND a.no < b.no),
f AS (SELECT id, ax, ay, bx, "by", dist FROM q QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist DESC, i, j) = 1)
SELECT id, ax::DOUBLE AS ax, ay::DOUBLE AS ay, bx::DOUBLE AS bx, "by"::DOUBLE AS "by", round(dist, 9) AS dist FROM f
UNION ALL SELECT id, x, y, x, y, NULL FROM c WHERE id NOT IN (SELECT id FROM f)""",
)
def main_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    lines = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), o.alias("part"), F.array(point(o % 7, o % 5), point(o * 3 % 11, o % 6)).alias("line"))
    return wiring.main_ends(lines).withColumn("dist", F.round("dist", 9))


#: Lines with one bend, along the axes, over the L-shaped zones.
BENT = """WITH s AS (SELECT s_suppkey AS zone, (s_suppkey % 10) * 3 + 0.3 AS x, (s_suppkey // 10) * 2.5 - 4.3 AS y FROM supplier),
z AS (SELECT zone, x AS zx, y AS zy, x AS x0, x + 3.5 AS x1, y AS y0, y + 1.25 AS y1 FROM s UNION ALL SELECT zone, x, y, x, x + 1.5, y + 1.25, y + 4 FROM s),
l AS (SELECT c_custkey AS id, c_custkey % 31 + 0.07 AS x, (c_custkey * 7 % 270) / 10 - 3.987 AS y FROM customer),
m AS (SELECT zone, id, greatest(CASE WHEN l.y BETWEEN y0 AND y1 THEN least(x1, l.x + 2) - greatest(x0, l.x) ELSE 0 END, 0)
  + greatest(CASE WHEN l.x + 2 BETWEEN x0 AND x1 THEN least(y1, l.y + 1.5) - greatest(y0, l.y) ELSE 0 END, 0) AS inside
  FROM z JOIN l ON l.x <= x1 AND l.x + 2 >= x0 AND l.y <= y1 AND l.y + 1.5 >= y0),
t AS (SELECT zone, id, sum(inside) AS inside FROM m GROUP BY ALL)
"""


def bent(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("c_custkey") % 31 + 0.07, F.col("c_custkey") * 7 % 270 / 10 - 3.987
    p = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.array(p(0.0, 0.0), p(2.0, 0.0), p(2.0, 1.5)).alias("line"))


@register(
    "polygon_paths",
    BENT
    + """, b AS (SELECT zone, id FROM t WHERE inside > 0.4 AND id % 5 <> 0 QUALIFY row_number() OVER (PARTITION BY zone ORDER BY id % 17 DESC, id DESC) = 1)
SELECT zone AS id, b.id AS line_id, round(s.x + (4.375 * 1.75 + 4.125 * 0.75) / 8.5, 6) AS x, round(s.y + (4.375 * 0.625 + 4.125 * 2.625) / 8.5, 6) AS y FROM s LEFT JOIN b USING (zone)""",
)
def polygon_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bent(spark, sf_dir)
    ancestors = lines.where("id % 5 <> 0").select("id", (F.col("id") % 17).alias("n"))
    found = overlays.polygon_paths(shapes(spark, sf_dir), lines, ancestors, 0.4, 4.0)
    return found.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@register("lake_paths", BENT + "SELECT zone AS id, id AS line_id FROM t WHERE inside > 0 AND id % 50 < 7 UNION ALL SELECT zone, -zone FROM s WHERE zone NOT IN (SELECT zone FROM t WHERE inside > 0 AND id % 50 < 7)")
def lake_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    lakes = shapes(spark, sf_dir).withColumn("line_id", -F.col("id"))
    return overlays.lake_paths(lakes, bent(spark, sf_dir).where("id % 50 < 7"), 4.0)
