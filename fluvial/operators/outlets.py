"""Small rules of building a network: shares, fallbacks, choices among several, and putting built outlets together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvial.operators.keyed import arg_max


def remaining_share(shares: DataFrame) -> DataFrame:
    """div_id, remaining: what the tributaries of shares(div_id, share) leave of each divide, not under 0."""
    return shares.groupBy("div_id").agg(F.greatest(1 - F.coalesce(F.sum("share"), F.lit(0.0)), F.lit(0.0)).alias("remaining"))


def choose_downstream(candidates: DataFrame, paths: DataFrame) -> DataFrame:
    """id, down: of candidates(id, down) the one of greatest paths(id, path_length), unknown lengths counting -1, then the least."""
    known = paths.select(F.col("id").alias("down"), "path_length")
    joined = candidates.join(known, "down", "left").select("id", "down", F.coalesce("path_length", F.lit(-1.0)).alias("path_length"))
    return arg_max(joined, ["id"], F.col("path_length"), -F.col("down")).select("id", "down")


def with_fallbacks(divides: DataFrame, virtual: DataFrame) -> DataFrame:
    """virtual(virtual_fp_id, div_id, share) with one row, of share 1, for each of divides(div_id, fp_id) that has none: it takes the flowpath's id."""
    bare = divides.join(virtual.select("div_id").distinct(), "div_id", "left_anti")
    return virtual.unionByName(bare.select(F.col("fp_id").alias("virtual_fp_id"), "div_id", F.lit(1.0).alias("share")))


def nexus_map(nexuses: DataFrame) -> DataFrame:
    """nex_id, kept: nexuses(nex_id, x, y, dn_fp_id) of several outlets that stand at one place and flow into one flowpath, or into none, are the least of them."""
    kept = nexuses.groupBy("x", "y", "dn_fp_id").agg(F.min("nex_id").alias("kept"))
    same = F.col("a.x").eqNullSafe(F.col("b.x")) & F.col("a.y").eqNullSafe(F.col("b.y")) & F.col("a.dn_fp_id").eqNullSafe(F.col("b.dn_fp_id"))
    return nexuses.alias("a").join(kept.alias("b"), same).select("a.nex_id", "b.kept")


def combine(paths: DataFrame, nexuses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """paths(fp_id, up_nex_id, dn_nex_id, ...) and nexuses(nex_id, x, y, dn_fp_id) of all outlets with equal nexuses merged and paths on those that are kept."""
    found = nexus_map(nexuses)
    out = paths
    for c in ("up_nex_id", "dn_nex_id"):
        names = out.columns
        moved = out.join(found.select(F.col("nex_id").alias("m_id"), F.col("kept").alias("m_kept")).distinct(), F.col(c) == F.col("m_id"), "left")
        out = moved.withColumn(c, F.coalesce("m_kept", c)).select(*names)
    kept = nexuses.join(found.select(F.col("kept").alias("nex_id")).distinct(), "nex_id", "left_semi").dropDuplicates(["nex_id"])
    return out, kept


def outside(points: DataFrame, limits: DataFrame) -> DataFrame:
    """The rows of points(domain, x, y, ...) outside the box of their domain in limits(domain, x0, x1, y0, y1), or of a domain that has none."""
    joined = points.join(F.broadcast(limits.withColumnRenamed("domain", "l_domain")), F.col("domain") == F.col("l_domain"), "left")
    inside = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    return joined.where(~F.coalesce(inside, F.lit(False))).select(*points.columns)


def by_class(value: Column, classes: dict[int, float]) -> Column:
    """A class's parameter; null for classes that the table lacks."""
    table = F.create_map(*(F.lit(x) for pair in classes.items() for x in pair))
    return F.try_element_at(table, value)


def confirmed(rows: DataFrame, status: str, wanted: str, renamed: dict[str, str], constants: dict[str, object]) -> DataFrame:
    """The rows of a wanted review status, with columns renamed to text ones and constants added."""
    kept = rows.where(F.col(status) == wanted)
    return kept.select(*(F.col(a).cast("string").alias(b) for a, b in renamed.items()), *(F.lit(v).alias(k) for k, v in constants.items()))


def prefixed(value: Column, listed: list[str], prefix: str = "0") -> Column:
    """Listed ids with a prefix, others as they are."""
    return F.when(value.isin(listed), F.concat(F.lit(prefix), value)).otherwise(value)
