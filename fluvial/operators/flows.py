"""Units and flows: shares of members, folded headwaters, weighted disaggregation of daily flows to hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unit_shares(members: DataFrame) -> DataFrame:
    """unit, member, share of members(unit, member, area): area over the unit's sum, 0 without an area.

    Sums are aggregated and joined back rather than windowed, so a unit with many members isn't one task.
    """
    total = members.groupBy("unit").agg(F.sum("area").alias("total"))
    share = F.when(F.col("total") > 0, F.coalesce("area", F.lit(0.0)) / F.col("total")).otherwise(F.lit(0.0))
    return members.join(total, "unit").select("unit", "member", share.alias("share"))


def unit_measures(members: DataFrame) -> DataFrame:
    """unit, length_km, area_sqkm, hydroseq (greatest), lowest and highest member, n of members(unit, member, hydroseq, length_m, area_m2)."""
    return members.groupBy("unit").agg(
        (F.sum("length_m") / 1000).alias("length_km"), (F.sum("area_m2") / 1e6).alias("area_sqkm"), F.max("hydroseq").alias("hydroseq"),
        F.min_by("member", F.struct("hydroseq", "member")).alias("lowest"), F.max_by("member", F.struct("hydroseq", -F.col("member"))).alias("highest"), F.count("*").alias("n"),
    )


def fold(areas: DataFrame, folds: DataFrame) -> DataFrame:
    """unit, area of areas(unit, area) after the units of folds(unit, into) have been added to those that they flow into and dropped."""
    moved = areas.join(folds, "unit", "left").select(F.coalesce("into", "unit").alias("unit"), "area")
    return moved.groupBy("unit").agg(F.sum("area").alias("area"))


def weighted_flows(weights: DataFrame, flows: DataFrame) -> DataFrame:
    """ref_id, day, q of weights(ref_id, comid, fraction) over flows(comid, day, q): fractions are normalised over the members that have any flow; days without are 0."""
    there = flows.select("comid").distinct()
    found = weights.join(there, "comid")
    total = found.groupBy("ref_id").agg(F.sum("fraction").alias("total"))
    sums = found.join(flows, "comid").groupBy("ref_id", "day").agg(F.sum(F.col("q") * F.col("fraction")).alias("sum"))
    refs = weights.select("ref_id").distinct()
    # Each basin gets a row for each day that any flow has.
    days = flows.agg(F.lit(1).alias("one"), F.collect_set("day").alias("days"))
    grid = refs.withColumn("one", F.lit(1)).join(days, "one").select("ref_id", F.explode("days").alias("day"))
    out = grid.join(sums, ["ref_id", "day"], "left").join(total, "ref_id", "left")
    return out.select("ref_id", "day", F.coalesce(F.when(F.col("total") > 0, F.col("sum") / F.col("total")), F.lit(0.0)).alias("q"))


def hourly(daily: DataFrame) -> DataFrame:
    """key, hour (timestamp), q of daily(key, day, q): 24 rows a day with a 24th of its flow each."""
    start = F.col("day").cast("timestamp")
    hours = F.sequence(start, start + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))
    return daily.select("key", F.explode(hours).alias("hour"), (F.col("q") / 24).alias("q"))
