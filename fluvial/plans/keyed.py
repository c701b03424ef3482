"""Queries of the keyed operators. Customers stand for a master of gages, suppliers for incoming sites, orders for crosswalks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvial.operators import keyed
from fluvial.plans.register import Register
from fluvial.session import table

register = Register()


@register("xwalk_argmax", "SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def xwalk_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return keyed.arg_max(orders, ["o_custkey"], F.col("o_totalprice"), -F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@register("xwalk_argmin", "SELECT o_custkey, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def xwalk_argmin(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return keyed.arg_min(orders, ["o_custkey"], F.col("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@register(
    "xwalk_two_stage",
    """WITH a AS (SELECT l_orderkey, arg_max(l_suppkey, (l_linenumber, -l_suppkey)) AS l_suppkey FROM lineitem GROUP BY l_orderkey),
    b AS (SELECT l_suppkey, min(l_orderkey) AS l_orderkey FROM a GROUP BY l_suppkey)
    SELECT o_orderkey, o_custkey, l_suppkey FROM orders JOIN b ON o_orderkey = l_orderkey""",
)
def xwalk_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    first = keyed.arg_max(lines, ["l_orderkey"], F.col("l_linenumber"), -F.col("l_suppkey"))
    second = keyed.arg_min(first.select("l_orderkey", "l_suppkey"), ["l_suppkey"], F.col("l_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(second, orders["o_orderkey"] == second["l_orderkey"]).select("o_orderkey", "o_custkey", "l_suppkey")


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("site_no"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("state"), F.col("c_mktsegment").alias("status"))


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 20).alias("site_no"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("state"))


UPSERT = """WITH i AS (SELECT s_suppkey * 20 AS site_no, s_name AS name, s_nationkey AS state FROM supplier)
SELECT c_custkey AS site_no, {name} AS name, {state} AS state, c_mktsegment AS status FROM customer LEFT JOIN i ON c_custkey = i.site_no
UNION ALL SELECT site_no, name, state, '-' FROM i WHERE site_no NOT IN (SELECT c_custkey FROM customer)"""


@register("upsert_master", UPSERT.format(name="coalesce(name, c_name)", state="coalesce(state, c_nationkey)"))
def upsert_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.upsert(_master(spark, sf_dir), _incoming(spark, sf_dir), "site_no", update=["name", "state"])


@register("upsert_append_only", UPSERT.format(name="c_name", state="c_nationkey"))
def upsert_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.upsert(_master(spark, sf_dir), _incoming(spark, sf_dir), "site_no", update=["name", "state"], update_existing=False)


@register("override_by_key", "SELECT c_custkey, coalesce(s_nationkey, c_nationkey) AS c_nationkey, coalesce(s_acctbal, c_acctbal) AS c_acctbal FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def override_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"))
    return keyed.override(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), changes, "c_custkey", ["c_nationkey", "c_acctbal"])


@register(
    "fill_missing_area",
    """WITH s AS (SELECT s_suppkey AS site, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS area FROM supplier)
    SELECT site, coalesce(area, c_acctbal) AS area, CASE WHEN area IS NULL AND c_acctbal IS NOT NULL THEN 'csv' ELSE 'basin' END AS source FROM s LEFT JOIN customer ON site = c_custkey""",
)
def fill_missing_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("site"), F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("area"), F.lit("basin").alias("source"))
    return keyed.fill_missing(sites, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("site"), F.col("c_acctbal").alias("area")), "site", "area", "csv")


@register("remap_ids", "SELECT o_orderkey, o_custkey * 3 + 1000 AS o_custkey FROM orders")
def remap_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("old_id"), (F.col("c_custkey") * 3 + 1000).alias("new_id"))
    return keyed.remap(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), mapping, ["o_custkey"])


#: Codes of data assimilation by order priority; rank 1 unless it is one of the two that come before.
_RANK = "CASE code WHEN 4 THEN 2 WHEN 6 THEN 3 ELSE CASE WHEN code > 1 THEN 1 ELSE 0 END END"
_CODE = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 WHEN '4' THEN 4 ELSE 6 END"


@register(
    "priority_merge_da",
    f"""WITH s AS (SELECT o_custkey AS lake, {_CODE} AS code FROM orders), u AS (SELECT lake, code FROM s GROUP BY ALL HAVING count(*) = 1),
    m AS (SELECT lake, arg_max(code, ({_RANK}, -code)) AS code FROM u GROUP BY lake)
    SELECT c_custkey AS lake, coalesce(code, 1) AS code FROM customer LEFT JOIN m ON c_custkey = lake""",
)
def priority_merge_da(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies of repeated (lake, code) rows go, the best code of each lake stays, lakes without one get level pool (1)."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("lake"), F.expr(_CODE).alias("code"))
    best = keyed.arg_max(keyed.without_copies(rows, ["lake", "code"]), ["lake"], F.expr(_RANK), -F.col("code"))
    lakes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"))
    return lakes.join(best, lakes["c"] == best["lake"], "left").select(F.col("c").alias("lake"), F.coalesce("code", F.lit(1)).alias("code"))


@register(
    "multi_source_dedup",
    """WITH a AS (SELECT 0 AS rank, c_custkey % 500 AS lake, c_custkey AS hydroseq, c_name AS name FROM customer UNION ALL SELECT 1, s_suppkey % 500, s_suppkey, s_name FROM supplier)
    SELECT lake, arg_min(name, (rank, hydroseq, name)) AS name, arg_min(hydroseq, (rank, hydroseq, name)) AS hydroseq FROM a GROUP BY lake""",
)
def multi_source_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each lake: the first source before the second, then the lowest hydroseq."""
    source = lambda rank, t, k, n: table(spark, sf_dir, t).select(F.lit(rank).alias("rank"), (F.col(k) % 500).alias("lake"), F.col(k).alias("hydroseq"), F.col(n).alias("name"))
    rows = keyed.append_sources(source(0, "customer", "c_custkey", "c_name"), source(1, "supplier", "s_suppkey", "s_name"))
    return keyed.arg_min(rows, ["lake"], F.col("rank"), F.col("hydroseq"), F.col("name")).select("lake", "name", "hydroseq")


@register(
    "three_way_anti",
    """SELECT c_custkey AS lake_id FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) AND c_nationkey * 7 NOT IN (SELECT s_suppkey FROM supplier)
       AND substr(c_name, 10)  NOT IN (SELECT substr(s_name, 10) FROM supplier)""",
)
def three_way_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    lakes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("lake_id"), (F.col("c_nationkey") * 7).cast("long").alias("dam_id"), F.expr("substr(c_name, 10)").alias("nid"))
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("lake_id"), F.col("s_suppkey").alias("dam_id"), F.expr("substr(s_name, 10)").alias("nid"))
    return keyed.anti_any(lakes, known, ["lake_id", "dam_id", "nid"]).select("lake_id")


@register(
    "partner_append",
    """SELECT c_custkey::VARCHAR AS site, c_mktsegment AS status FROM customer UNION ALL SELECT 'usbr-' || s_suppkey, 'USBR' FROM supplier
       UNION ALL SELECT regexp_replace(n_name || 'OT', 'OT$', ''), 'adhoc_lakes' FROM nation UNION ALL SELECT r_name, NULL FROM region""",
)
def partner_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("site"), F.col("c_mktsegment").alias("status"))
    usbr = table(spark, sf_dir, "supplier").select(F.concat(F.lit("usbr-"), F.col("s_suppkey").cast("string")).alias("site"), F.lit("USBR").alias("status"))
    adhoc = table(spark, sf_dir, "nation").select(F.regexp_replace(F.concat("n_name", F.lit("OT")), "OT$", "").alias("site"), F.lit("adhoc_lakes").alias("status"))
    return keyed.append_sources(master, usbr, adhoc, table(spark, sf_dir, "region").select(F.col("r_name").alias("site")))


@register(
    "running_ids",
    """SELECT row_number() OVER (ORDER BY t, k) AS hy_id, k AS key FROM (SELECT 0 AS t, r_regionkey::BIGINT AS k FROM region UNION ALL SELECT 1, n_nationkey FROM nation UNION ALL SELECT 2, s_suppkey FROM supplier)""",
)
def running_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [table(spark, sf_dir, t).select(F.col(k).cast("long").alias("key")) for t, k in (("region", "r_regionkey"), ("nation", "n_nationkey"), ("supplier", "s_suppkey"))]
    return keyed.running_ids(tables, ["key"])


@register("missing_sets", "SELECT c_custkey AS key FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def missing_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.missing_keys(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), "key")


@register("common_sets", "SELECT DISTINCT o_custkey AS key FROM orders WHERE o_custkey IN (SELECT s_suppkey FROM supplier)")
def common_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")).intersect(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key")))


@register("mean_full_outer", "SELECT o_custkey AS fp_id, round(avg(l_quantity), 6) AS r FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey")
def mean_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of predictions over a full outer join; predictions without a reach form the null group."""
    orders, lines = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "full")
    return joined.groupBy(F.col("o_custkey").alias("fp_id")).agg(F.round(F.avg("l_quantity"), 6).alias("r"))


@register(
    "composite_left_join",
    """SELECT l_suppkey, l_linenumber, count(*) AS n, count(o_orderkey) AS matched FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND l_suppkey = o_custkey GROUP BY ALL""",
)
def composite_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, (lines["l_orderkey"] == orders["o_orderkey"]) & (lines["l_suppkey"] == orders["o_custkey"]), "left")
    return joined.groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("n"), F.count("o_orderkey").alias("matched"))


@register("group_size", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders")
def group_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row with the size of its group: the counts are aggregated and joined back, so no group has to sit in one task."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(orders.groupBy("o_custkey").agg(F.count("*").alias("n")), "o_custkey").select("o_orderkey", "n")


@register("group_max_ties", "SELECT l_suppkey, l_partkey, q FROM (SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY q DESC) AS r FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)) WHERE r = 1")
def group_max_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by two keys, then all rows equal to the greatest of the first key."""
    sums = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    most = sums.groupBy(F.col("l_suppkey").alias("s")).agg(F.max("q").alias("most"))
    return sums.join(most, (F.col("l_suppkey") == F.col("s")) & (F.col("q") == F.col("most"))).select("l_suppkey", "l_partkey", "q")
