"""Ids of features from where they are: a 12-digit location code as a number, with collisions moved aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvial.checkpoint import materialize
from fluvial.functions import scalars

STEP, RINGS = 9e-6, 20


def location_ids(features: DataFrame) -> DataFrame:
    """features(rank, key, lat, lon) with gid (the code) and id (its number): the first of each cell by (rank, key) has the cell's own code, the others one nearby.

    A later feature of a cell tries eight directions on rings of growing distance until a code is free. All moved features bid for their first
    free place at once, in each round the first bidder of a place, by (rank, key), gets it, and the others go on with the places that are
    left, so no two features share a code. A feature without coordinates has nulls; one without a free place within the rings is an error.
    """
    code = scalars.location_code(F.col("lat"), F.col("lon"), 12)
    placed = features.withColumn("code", F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), code)).withColumn("row_no", F.monotonically_increasing_id())
    turn = F.when(F.col("code").isNotNull(), F.row_number().over(W.partitionBy("code").orderBy("rank", "key", "row_no")) - 1).otherwise(0)
    ranked = materialize(placed.withColumn("turn", turn), "placed")
    first = ranked.where("turn = 0").select("row_no", F.col("code").alias("gid"))
    ring, angle = F.ceil(F.col("try") / 8), F.radians(45.0 * (F.col("try") % 8))
    lat, lon = F.col("lat") + ring * STEP * F.sin(angle), F.col("lon") + ring * STEP * F.cos(angle)
    moves = ranked.where("turn > 0").withColumn("try", F.explode(F.sequence(F.lit(1), F.lit(8 * RINGS))))
    tries = moves.select("row_no", "rank", "key", "try", scalars.location_code(lat, lon, 12).alias("gid"))
    tries = materialize(tries.join(first.select("gid"), "gid", "left_anti"), "places-0")
    settled, n = first, 0
    while not tries.isEmpty():
        n += 1
        bids = tries.groupBy("row_no").agg(F.min(F.struct("try", "gid", "rank", "key")).alias("bid")).select("row_no", "bid.*")
        won = bids.groupBy("gid").agg(F.min(F.struct("rank", "key", "row_no")).alias("best")).select(F.col("best.row_no").alias("row_no"), "gid")
        won = materialize(won, f"settled-{n}")
        settled = settled.unionByName(won)
        tries = materialize(tries.join(won.select("row_no"), "row_no", "left_anti").join(won.select("gid"), "gid", "left_anti").select(*tries.columns), f"places-{n}")
    lost = ranked.join(settled, "row_no", "left_anti").select("lat", "lon").first()
    if lost is not None:
        raise ValueError(f"no free location code near {lost.lat}, {lost.lon}")
    out = ranked.join(settled, "row_no").select(*features.columns, "gid")
    return out.withColumn("id", scalars.location_code_number(F.col("gid")))


def duplicates(ids: DataFrame) -> DataFrame:
    """gid, n of the codes that several features have."""
    return ids.where("gid IS NOT NULL").groupBy("gid").agg(F.count("*").alias("n")).where("n > 1")
