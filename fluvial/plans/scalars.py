"""Queries of scalar rules, hydraulics, channel attributes and validation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvial.functions import hydraulics, scalars
from fluvial.operators import validate
from fluvial.plans.register import Register
from fluvial.session import table

register = Register()


@register(
    "parse_site_no",
    r"""SELECT page_id, coalesce(nullif(regexp_extract(url, '(?i)site_no=(\d+)', 1), ''), nullif(regexp_extract(url, '\b(\d{5,15})\b', 1), '')) AS value FROM pages""",
)
def parse_site_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", scalars.site_no(F.col("url")).alias("value"))


@register("strip_html", "SELECT page_id, trim(regexp_replace(html, '<[^>]+>', '', 'g'), ' ') AS value FROM pages")
def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", scalars.strip_html(F.col("html")).alias("value"))


@register(
    "state_from_name",
    """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(s[1:1]) || lower(s[2:]) ELSE 'Extra' END AS state
       FROM (SELECT p_partkey, regexp_replace(lower(p_brand), '[#]', '') AS s FROM part)""",
)
def state_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.regexp_replace(F.lower("p_brand"), "#", "")
    stem = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("StreamGages_"), brand)).otherwise(F.concat(brand, F.lit("_EXTRA")))
    return table(spark, sf_dir, "part").select("p_partkey", scalars.state_from_file_name(stem).alias("state"))


_CODE_SQL = "list_reduce(list_prepend(0::BIGINT, list_transform(list_filter(string_split({c}, ''), lambda d: contains('23456789CFGHJMPQRVWX', d)), lambda d: (instr('23456789CFGHJMPQRVWX', d) - 1)::BIGINT)), lambda a, b: a * 20 + b)"


@register("location_code_int", f"""SELECT doc_id AS id, {_CODE_SQL.format(c="upper(substr(md5(doc_id::VARCHAR), 1, 10))")} AS code_int FROM documents""")
def location_code_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.upper(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 10))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), scalars.location_code_number(code).alias("code_int"))


@register("null_text", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment FROM customer")
def null_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("c_mktsegment") == "BUILDING", "<NA>").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.null_text_to_null(text).alias("segment"))


@register("relative_errors", "SELECT o_orderkey, round(abs(o_totalprice - c_acctbal) / c_acctbal, 6) AS err FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def relative_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").where("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", F.round(scalars.relative_error(F.col("o_totalprice"), F.col("c_acctbal")), 6).alias("err"))


@register("reach_slope", "SELECT l_orderkey, l_linenumber, round(greatest(coalesce(abs(l_tax - l_discount) / nullif(l_quantity, 0), 1e-5), 1e-5), 8) AS slope FROM lineitem")
def reach_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(scalars.slope(F.col("l_tax") - F.col("l_discount"), F.col("l_quantity")), 8).alias("slope"))


@register("file_dates", "SELECT max(strptime(regexp_extract(f, '\\d{8}'), '%Y%m%d')::DATE) AS latest FROM (SELECT 'glims_' || strftime(o_orderdate, '%Y%m%d') || '.parquet' AS f FROM orders)")
def file_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("glims_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".parquet"))
    return table(spark, sf_dir, "orders").select(scalars.file_date(name).alias("d")).agg(F.max("d").alias("latest"))


def _case(column: str, values: dict[int, float], default: float) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + f" ELSE {default} END"


@register(
    "channel_attrs",
    f"""SELECT p_partkey, n, round(2 * n, 6) AS ncc, {_case("o", hydraulics.BOTTOM_WIDTH, hydraulics.DEFAULT_WIDTH)} AS btmwdth, {_case("o", hydraulics.SIDE_SLOPE, hydraulics.DEFAULT_SLOPE)} AS chslp,
    0.2 AS musx, 3600 AS musk, round(2.44 * pow(da, 0.34), 6) AS topwdth, round(3 * (2.44 * pow(da, 0.34)), 6) AS topwdthcc
    FROM (SELECT *, {_case("o", hydraulics.MANNING_N, hydraulics.DEFAULT_N)} AS n FROM (SELECT p_partkey, p_size % 12 AS o, p_retailprice / 100 AS da FROM part))""",
)
def channel_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    reaches = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 12).alias("stream_order"), (F.col("p_retailprice") / 100).alias("total_da_sqkm"))
    out = hydraulics.channel_attributes(reaches)
    return out.select("p_partkey", "n", F.round("ncc", 6).alias("ncc"), "btmwdth", "chslp", "musx", "musk", F.round("topwdth", 6).alias("topwdth"), F.round("topwdthcc", 6).alias("topwdthcc"))


_DAM = """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'Broad-crested' WHEN 1 THEN 'Ogee gate' WHEN 2 THEN 'Sharp pipe' WHEN 3 THEN 'Tunnel' END AS spillway_type,
  CASE p_size % 3 WHEN 0 THEN 'Earthen' WHEN 1 THEN 'Concrete arch' ELSE 'Rock' END AS dam_type, CASE WHEN p_size % 7 = 0 THEN 'Hydroelectric power' END AS purposes,
  CAST(CASE WHEN p_size % 11 <> 0 THEN p_size - 5 END AS DOUBLE) AS structural_height, CAST(p_size % 4 AS DOUBLE) AS dam_height, CAST(p_size * 3 AS DOUBLE) AS dam_length,
  CAST(CASE WHEN p_size % 2 = 0 THEN p_retailprice END AS DOUBLE) AS ref_elev, CAST(p_retailprice - 20 AS DOUBLE) AS dam_elev, CAST(p_size AS DOUBLE) / 10 AS ref_area_sqkm, CAST(p_size * 2 AS DOUBLE) AS normal_storage FROM part"""


@register(
    "hydraulics",
    f"""WITH d AS ({_DAM}), h AS (SELECT *, coalesce(nullif(structural_height, 0), nullif(dam_height, 0)) AS h, nullif(ref_area_sqkm, 0) AS a, lower(coalesce(spillway_type, '')) AS s, lower(dam_type) AS t FROM d),
    e AS (SELECT *, normal_storage * 1233.48184 / a AS depth, coalesce(nullif(dam_length, 0), 10.0) AS wl,
      CASE WHEN s LIKE '%broad%' THEN 1.6 WHEN s LIKE '%ogee%' THEN 1.7 WHEN s LIKE '%sharp%' THEN 1.84 WHEN t LIKE '%earth%' THEN 1.6 ELSE 0.4 END AS wc,
      CASE WHEN s LIKE '%pipe%' THEN 0.62 WHEN s LIKE '%gate%' OR s LIKE '%tunnel%' OR purposes IS NOT NULL THEN 0.8 ELSE 0.1 END AS oc,
      CASE WHEN h < 10 THEN 0.5 WHEN h < 30 THEN 0.9 WHEN h >= 30 THEN 1.5 WHEN t LIKE '%concrete%' OR s LIKE '%ogee%' THEN 1.2 ELSE 1.0 END AS oa FROM h),
    f AS (SELECT *, coalesce(ref_elev, dam_elev + 0.9 * h, dam_elev + depth) AS we, coalesce(ref_elev + 0.1 * h, ref_elev, dam_elev + h, dam_elev + depth) AS me, coalesce(dam_elev + 0.15 * h, ref_elev - 0.75 * h) AS oe FROM e),
    g AS (SELECT *, CASE WHEN we < oe THEN oe ELSE we END AS we2 FROM f)
    SELECT p_partkey, h AS "H_m", a AS "LkArea", round(CASE WHEN me < we2 THEN we2 ELSE me END, 4) AS "LkMxE", wc AS "WeirC", wl AS "WeirL", round(we2, 4) AS "WeirE", oc AS "OrificeC", oa AS "OrificeA", round(coalesce(oe, we2), 4) AS "OrificeE",
    coalesce(nullif(dam_length, 0), wl) AS "Dam_Length", 0.899 AS ifd FROM g""",
)
def reservoir_hydraulics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "part").createOrReplaceTempView("fluvial_part")
    out = hydraulics.reservoir_hydraulics(spark.sql(_DAM.replace("FROM part", "FROM fluvial_part")))
    rounded = {c: F.round(c, 4) for c in ("LkMxE", "WeirE", "OrificeE")}
    return out.withColumns(rounded).select("p_partkey", "H_m", "LkArea", "LkMxE", "WeirC", "WeirL", "WeirE", "OrificeC", "OrificeA", "OrificeE", "Dam_Length", "ifd")


@register(
    "snow_melt",
    "SELECT p_partkey, round(m, 6) AS mfmax, round(m * r, 6) AS mfmin FROM (SELECT p_partkey, r, (1.03 * (1 - f) * rdb + 2.04 + 0.42 * w) / (2 * (r + 1)) AS m FROM (SELECT p_partkey, (p_size % 10) / 10.0::DOUBLE AS f, p_size / 20.0::DOUBLE AS rdb, (p_size % 7)::DOUBLE AS w, (p_size % 3 + 1) / 4.0::DOUBLE AS r FROM part))",
)
def snow_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    grid = table(spark, sf_dir, "part").select("p_partkey", ((size % 10) / 10.0).alias("f"), (size / 20.0).alias("rdb"), (size % 7).cast("double").alias("wind"), ((size % 3 + 1) / 4.0).alias("r"))
    return hydraulics.snow_melt_factors(grid).select("p_partkey", F.round("mfmax", 6).alias("mfmax"), F.round("mfmin", 6).alias("mfmin"))


@register(
    "null_report",
    """SELECT 'text' AS "column", count(*) FILTER (text IS NULL) AS n_null FROM documents UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL) FROM documents UNION ALL SELECT 'quality', (SELECT count(*) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NULL)""",
)
def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return validate.null_counts(joined, ["text", "lang", "quality"])


@register(
    "null_report_by",
    """SELECT source AS "by", 'quality' AS "column", count(*) AS n_null FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NULL GROUP BY source""",
)
def null_report_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("by"), "text").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return validate.null_counts_by(joined, ["text", "quality"], "by")


@register(
    "range_report",
    """SELECT field, rule, count(*) AS n FROM (
    SELECT 'l_quantity' AS field, CASE WHEN l_quantity IS NULL THEN 'missing' WHEN l_quantity < 3 THEN 'too small' WHEN l_quantity > 45 THEN 'too large' END AS rule FROM lineitem UNION ALL
    SELECT 'l_discount', CASE WHEN l_discount IS NULL THEN 'missing' WHEN l_discount <= 0 THEN 'too small' WHEN l_discount > 0.08 THEN 'too large' END FROM lineitem) WHERE rule IS NOT NULL GROUP BY ALL""",
)
def range_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount")
    found = validate.violations(lines, "l_orderkey", {"l_quantity": (3.0, 45.0, False), "l_discount": (0.0, 0.08, True)})
    return found.groupBy("field", "rule").agg(F.count("*").alias("n"))


@register(
    "presence_report",
    "SELECT count(*) AS n_wanted, count(*) FILTER (c_custkey NOT IN (SELECT s_suppkey * 3 FROM supplier)) AS n_missing, round(100.0 * count(*) FILTER (c_custkey NOT IN (SELECT s_suppkey * 3 FROM supplier)) / count(*), 6) AS percent_missing FROM customer",
)
def presence_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = validate.presence(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("site")), table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3).alias("site")), "site")
    return out.withColumn("percent_missing", F.round("percent_missing", 6))
