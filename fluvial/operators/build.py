"""Flowpaths, divides and nexuses from routing units, as joins of the unit table with itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvial.operators.flows import unit_measures
from fluvial.operators.keyed import arg_max, arg_min


def flowpaths(units: DataFrame, reaches: DataFrame) -> DataFrame:
    """fp_id, fp_to_id, dn_nex_id, up_nex_id, length_km, area_sqkm, hydroseq, n_refs of units(unit, ref_id) over reaches(id, down, hydroseq, length_m, area_m2).

    A unit flows into the unit of the reach below its lowest member; units that flow into the same one share its nexus, which has that unit's id; an
    outlet's nexus has its own id with a minus. up_nex_id is the nexus that flows into the unit, null at headwaters.
    """
    members = units.select("unit", F.col("ref_id").alias("member")).join(reaches.withColumnRenamed("id", "member"), "member")
    measures = unit_measures(members.select("unit", "member", "hydroseq", "length_m", "area_m2"))
    lowest = arg_min(members.select("unit", "hydroseq", "member", "down"), ["unit"], F.col("hydroseq"), F.col("member")).select("unit", "down")
    below = units.select(F.col("ref_id").alias("down"), F.col("unit").alias("to"))
    to = lowest.join(below, "down", "left").select("unit", F.when(F.col("to") != F.col("unit"), F.col("to")).alias("to"))
    rows = measures.join(to, "unit").select("unit", "to", "length_km", "area_sqkm", "hydroseq", F.col("n").alias("n_refs"), F.coalesce("to", -F.col("unit")).alias("dn_nex_id"))
    fed = rows.where("to IS NOT NULL").select(F.col("to").alias("unit"), F.col("to").alias("up_nex_id")).distinct()
    out = rows.join(fed, "unit", "left")
    return out.select(F.col("unit").alias("fp_id"), F.col("to").alias("fp_to_id"), "dn_nex_id", "up_nex_id", "length_km", "area_sqkm", "hydroseq", "n_refs")


def nexuses(paths: DataFrame) -> DataFrame:
    """nex_id, dn_fp_id of flowpaths' rows: the downstream flowpath, null for an outlet's."""
    return paths.select(F.col("dn_nex_id").alias("nex_id"), F.col("fp_to_id").alias("dn_fp_id")).distinct()


def break_short_cycles(paths: DataFrame) -> DataFrame:
    """flowpaths with up_nex_id emptied where it is the path's own dn_nex_id."""
    return paths.withColumn("up_nex_id", F.when(~F.col("up_nex_id").eqNullSafe(F.col("dn_nex_id")), F.col("up_nex_id")))


def segment_areas(segments: DataFrame) -> DataFrame:
    """seg_id, area of segments(unit, seg_id, length, overlap, budget): each has its overlap, all scaled down if they exceed the unit's budget; what is left of
    the budget goes to them by length."""
    sums = segments.groupBy("unit").agg(F.sum("overlap").alias("found"), F.sum("length").alias("total"), F.max("budget").alias("b"))
    scale = F.when(F.col("found") > F.col("b"), F.col("b") / F.col("found")).otherwise(1.0)
    rest = F.greatest(F.col("b") - F.col("found"), F.lit(0.0))
    area = F.col("overlap") * scale + F.when(F.col("total") > 0, rest * F.col("length") / F.col("total")).otherwise(0.0)
    return segments.join(sums, "unit").select("unit", "seg_id", area.alias("area"))


def covered(virtual: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """crosswalk(virtual_fp_id, div_id, ref_fp_id) with a row for every virtual(virtual_fp_id, div_id): those without one take the least reference of their divide."""
    bare = virtual.join(crosswalk.select("virtual_fp_id").distinct(), "virtual_fp_id", "left_anti")
    donor = crosswalk.groupBy("div_id").agg(F.min("ref_fp_id").alias("ref_fp_id"))
    return crosswalk.unionByName(bare.join(donor, "div_id").select(*crosswalk.columns))


def crosswalk_ids(features: DataFrame, references: DataFrame, columns: list[str]) -> DataFrame:
    """features(ref_fp_id, ...) with columns of the references' row of greatest segment_order, then least virtual_fp_id, for each ref_fp_id."""
    best = arg_max(references.select("ref_fp_id", "segment_order", *columns), ["ref_fp_id"], F.coalesce("segment_order", F.lit(-1)), -F.coalesce("virtual_fp_id", F.lit(0)))
    return features.join(best.select("ref_fp_id", *columns), "ref_fp_id", "left")


def attach_nexuses(features: DataFrame, paths: DataFrame, virtual: DataFrame) -> DataFrame:
    """features(fp_id, virtual_fp_id, ...) with dn_nex_id and dn_virtual_nex_id."""
    out = features.join(paths.select("fp_id", "dn_nex_id"), "fp_id", "left")
    return out.join(virtual.select("virtual_fp_id", "dn_virtual_nex_id"), "virtual_fp_id", "left")
