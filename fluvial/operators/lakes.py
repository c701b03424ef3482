"""Lakes and reservoirs: which count, which of several sources wins, how they are operated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvial.operators.keyed import append_sources, arg_max, arg_min, without_copies

#: Codes of data assimilation.
LEVEL_POOL, USGS, USACE, RFC, USBR, GREAT_LAKES = 1, 2, 3, 4, 6, 7


def reservoir_criteria(reservoirs: DataFrame, taken: list[DataFrame], *, most_distance: float, least_area: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """Reservoirs(dam_id, ref_fab_wb, distance, area) that are on a water body, that no taken(dam_id) has, and that are near and large enough or to be kept anyhow."""
    out = reservoirs.where("ref_fab_wb IS NOT NULL")
    for t in taken:
        out = out.join(t.select(F.col("dam_id").alias("t_id")), F.col("dam_id") == F.col("t_id"), "left_anti")
    good = (F.col("distance") < most_distance) & (F.col("area") >= least_area)
    return out.where(good | F.col("dam_id").isin(list(keep)) if keep else good)


def required_waterbodies(flagged: DataFrame, reservoirs: DataFrame, areas: DataFrame) -> DataFrame:
    """One row for each lake_id of flagged(lake_id, dam_id): its reservoir's references if there is one, and its area in square kilometres; lakes without an area go."""
    r = reservoirs.select("dam_id", "ref_fab_fp", "ref_fab_wb", "nid")
    joined = flagged.join(r, "dam_id", "left").join(areas.select("lake_id", (F.col("area_m2") / 1e6).alias("area_sqkm")), "lake_id")
    return arg_min(joined.select("lake_id", "dam_id", "ref_fab_fp", "ref_fab_wb", "nid", "area_sqkm"), ["lake_id"], F.coalesce("ref_fab_fp", F.lit(2**62)), F.coalesce("nid", F.lit("")))


def dedup_lakes(lakes: DataFrame) -> DataFrame:
    """One row for each lake_id: an NWM row before others, then the lowest hydroseq, nulls last, then the least dam_id."""
    return arg_min(lakes, ["lake_id"], (F.coalesce(F.col("source"), F.lit("")) != "nwm").cast("int"), F.col("hydroseq").isNull(), F.col("hydroseq"), F.coalesce("dam_id", F.lit("")))


def polygons_by_priority(polygons: DataFrame, order: tuple[str, ...] = ("nwm_lakes", "ref_wb")) -> DataFrame:
    """One polygon for each lake_id, by the order of the sources; of one source the least by its bytes."""
    rank = F.coalesce(*(F.when(F.col("source") == s, i) for i, s in enumerate(order)), F.lit(len(order)))
    return arg_min(polygons, ["lake_id"], rank, F.col("geometry"))


def assimilation(lakes: DataFrame, *sources: DataFrame) -> DataFrame:
    """nhf_lake_id, lake_id, site_no, da_type of lakes(nhf_lake_id, lake_id) from sources(lake_id, site_no, da_type), earlier ones first.

    All copies of rows that agree in lake_id and da_type go; the best ranked code of a lake stays (6, then 4, then any over 1), the first source on ties, then the greatest site and code;
    lakes without one run as level pools.
    """
    ranked = append_sources(sources[0].withColumn("nth", F.lit(0)), *(s.withColumn("nth", F.lit(i + 1)) for i, s in enumerate(sources[1:])))
    rank = F.when(F.col("da_type") == USBR, 3).when(F.col("da_type") == RFC, 2).when(F.col("da_type") > LEVEL_POOL, 1).otherwise(0)
    best = arg_max(without_copies(ranked, ["lake_id", "da_type"]), ["lake_id"], rank, -F.col("nth"), F.coalesce("site_no", F.lit("")), F.col("da_type"))
    return lakes.join(best.select("lake_id", "site_no", "da_type"), "lake_id", "left").select("nhf_lake_id", "lake_id", "site_no", F.coalesce("da_type", F.lit(LEVEL_POOL)).alias("da_type"))


def index_sites(index: DataFrame, code: int, sentinel: int = -99999) -> DataFrame:
    """lake_id, site_no, da_type of a reservoir index(lake_id, gage): bytes decoded and trimmed, the sentinel dropped."""
    return index.where(F.col("lake_id") != sentinel).select(F.col("lake_id").cast("string").alias("lake_id"), F.trim(F.decode("gage", "UTF-8")).alias("site_no"), F.lit(code).alias("da_type"))
