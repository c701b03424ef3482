"""Overlays of lines and polygons: candidates meet on a grid, the share in common is measured by vectorised kernels on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvial.functions import geometry
from fluvial.operators.keyed import arg_max
from fluvial.operators.spatial import _spread, segments


def capsule_interval(p0: np.ndarray, p1: np.ndarray, a: np.ndarray, b: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """For each segment p0-p1 the part, as fractions of it, within r of the segment a-b; start > end where there is none.

    What lies within r of a segment is convex: a strip between its ends and a disc at each, so the part is from the least start to the greatest end.
    """
    d, u = p1 - p0, b - a
    length = np.hypot(*u.T)
    lo, hi = np.full(len(d), np.inf), np.full(len(d), -np.inf)

    def add(s: np.ndarray, e: np.ndarray) -> None:
        s, e = np.maximum(s, 0), np.minimum(e, 1)
        good = s <= e
        lo[good], hi[good] = np.minimum(lo, s)[good], np.maximum(hi, e)[good]

    for c in (a, b):
        w = p0 - c
        qa, qb, qc = (d * d).sum(1), (d * w).sum(1), (w * w).sum(1) - r * r
        disc = qb * qb - qa * qc
        root = np.sqrt(np.maximum(disc, 0))
        safe = np.where(qa > 0, qa, 1)
        s = np.where(qa > 0, (-qb - root) / safe, np.where(qc <= 0, 0, np.inf))
        e = np.where(qa > 0, (-qb + root) / safe, np.where(qc <= 0, 1, -np.inf))
        add(np.where(disc >= 0, s, np.inf), np.where(disc >= 0, e, -np.inf))
    unit = u / np.where(length > 0, length, 1)[:, None]
    s, e = np.zeros(len(d)), np.ones(len(d))
    w = p0 - a
    for value, slope, least, most in (((w * unit).sum(1), (d * unit).sum(1), 0.0, length), (w[:, 0] * unit[:, 1] - w[:, 1] * unit[:, 0], d[:, 0] * unit[:, 1] - d[:, 1] * unit[:, 0], -r, np.full(len(d), r))):
        flat = slope == 0
        step = np.where(flat, 1, slope)
        t0, t1 = (least - value) / step, (most - value) / step
        out = flat & ((value < least) | (value > most))
        s = np.where(out, np.inf, np.where(flat, s, np.maximum(s, np.minimum(t0, t1))))
        e = np.where(out, -np.inf, np.where(flat, e, np.minimum(e, np.maximum(t0, t1))))
    strip = length > 0
    add(np.where(strip, s, np.inf), np.where(strip, e, -np.inf))
    return lo, hi


def _union_length(parts: Column) -> Column:
    """Total length of a sorted array of (s, e)."""
    start = F.struct(F.lit(-1.0).alias("end"), F.lit(0.0).alias("sum"))
    more = lambda acc, p: F.struct(F.greatest(acc["end"], p["e"]).alias("end"), (acc["sum"] + F.greatest(p["e"] - F.greatest(acc["end"], p["s"]), F.lit(0.0))).alias("sum"))
    return F.aggregate(parts, start, more, lambda acc: acc["sum"])


def buffer_crosswalk(refs: DataFrame, targets: DataFrame, radius: float, least: float) -> DataFrame:
    """id, best, pct of every row of refs(id, line): of targets(id, line) that come within radius the one with the greatest share of its length there.

    Shares are rounded to 4 places, the smaller id wins ties; best is null under the least share, both are null without a candidate.
    """
    size = 8 * radius
    r, t = segments(refs).withColumnRenamed("id", "ref"), segments(targets).withColumnRenamed("id", "target")
    low, high = (lambda p, m=0.0: F.least(f"{p}0", f"{p}1") - m), (lambda p, m=0.0: F.greatest(f"{p}0", f"{p}1") + m)
    r = r.drop("seg")
    a = _spread(r, low("x", radius), high("x", radius), low("y", radius), high("y", radius), size).select("ref", *(F.col(c).alias(f"r{c}") for c in ("x0", "y0", "x1", "y1")), "cx", "cy")
    b = _spread(t, low("x"), high("x"), low("y"), high("y"), size)
    pairs = b.join(a, ["cx", "cy"]).drop("cx", "cy").distinct()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            xy = lambda x, y, p=p: p[[x, y]].to_numpy(float)
            s, e = capsule_interval(xy("x0", "y0"), xy("x1", "y1"), xy("rx0", "ry0"), xy("rx1", "ry1"), radius)
            yield p.assign(s=s, e=e)[s <= e][["ref", "target", "seg", "x0", "y0", "x1", "y1", "s", "e"]]

    types = dict(pairs.dtypes)
    met = pairs.mapInPandas(measure, f"ref {types['ref']}, target {types['target']}, seg int, x0 double, y0 double, x1 double, y1 double, s double, e double")
    by_segment = met.groupBy("ref", "target", "seg").agg(F.first("x0").alias("x0"), F.first("y0").alias("y0"), F.first("x1").alias("x1"), F.first("y1").alias("y1"), F.array_sort(F.collect_list(F.struct("s", "e"))).alias("parts"))
    span = F.sqrt((F.col("x1") - F.col("x0")) ** 2 + (F.col("y1") - F.col("y0")) ** 2)
    inside = by_segment.groupBy("ref", "target").agg(F.sum(_union_length(F.col("parts")) * span).alias("inside"))
    total = targets.select(F.col("id").alias("target"), geometry.length(F.col("line")).alias("total"))
    share = inside.join(total, "target").select("ref", "target", F.bround(F.when(F.col("total") > 0, F.col("inside") / F.col("total")).otherwise(0.0), 4).alias("pct"))
    best = arg_max(share, ["ref"], F.col("pct"), -F.col("target"))
    out = refs.select("id").join(best, F.col("id") == F.col("ref"), "left")
    return out.select("id", F.when(F.col("pct") >= least, F.col("target")).alias("best"), "pct")


def overlap_percent(polygons: DataFrame, shapes: DataFrame, size: float) -> DataFrame:
    """id, percent (2 places) of each of polygons(id, ring) covered by shapes(id, ring), which must be convex and must not overlap each other; 0 without any."""
    box = geometry.envelope(F.col("ring"))
    placed = lambda d, name: _spread(d.withColumn("e", box), F.col("e.x0"), F.col("e.x1"), F.col("e.y0"), F.col("e.y1"), size).select(F.col("id").alias(name), F.col("ring").alias(f"{name}_ring"), "cx", "cy")
    met = placed(polygons, "a").join(placed(shapes, "b"), ["cx", "cy"]).select("a", "a_ring", "b", "b_ring").distinct()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = lambda ring: np.array([(p["x"], p["y"]) for p in ring])
        for p in batches:
            yield pd.DataFrame({"a": p["a"], "common": [geometry.clipped_area(rows(x), rows(y)) for x, y in zip(p["a_ring"], p["b_ring"], strict=True)]})

    common = met.mapInPandas(measure, f"a {dict(met.dtypes)['a']}, common double").groupBy("a").agg(F.sum("common").alias("common"))
    out = polygons.select("id", geometry.area(F.col("ring")).alias("area")).join(common, F.col("id") == F.col("a"), "left")
    return out.select("id", F.bround(F.coalesce(F.when(F.col("area") > 0, F.col("common") / F.col("area") * 100), F.lit(0.0)), 2).alias("percent"))


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """polygon_id, id of the points(id, x, y) inside each of polygons(id, ring)."""
    box = geometry.envelope(F.col("ring"))
    spread = _spread(polygons.withColumn("e", box), F.col("e.x0"), F.col("e.x1"), F.col("e.y0"), F.col("e.y1"), size).select(F.col("id").alias("polygon_id"), "ring", "cx", "cy")
    cell = lambda c: F.floor(F.col(c) / size).cast("long")
    placed = points.where("x IS NOT NULL AND y IS NOT NULL").withColumns({"cx": cell("x"), "cy": cell("y")})
    return spread.join(placed, ["cx", "cy"]).where(geometry.contains(F.col("ring"), F.col("x"), F.col("y"))).select("polygon_id", "id")


def _met(polygons: DataFrame, lines: DataFrame, size: float) -> DataFrame:
    """polygon_id, ring and line_id, seg, x0, y0, x1, y1 of the segments that share a cell with a polygon's box."""
    box = geometry.envelope(F.col("ring"))
    spread = _spread(polygons.withColumn("e", box), F.col("e.x0"), F.col("e.x1"), F.col("e.y0"), F.col("e.y1"), size).select(F.col("id").alias("polygon_id"), "ring", "cx", "cy")
    seg = segments(lines).withColumnRenamed("id", "line_id")
    placed = _spread(seg, F.least("x0", "x1"), F.greatest("x0", "x1"), F.least("y0", "y1"), F.greatest("y0", "y1"), size)
    return spread.join(placed, ["cx", "cy"]).dropDuplicates(["polygon_id", "line_id", "seg"])


_SEGMENT = ("x0", "y0", "x1", "y1")


def polygon_paths(polygons: DataFrame, lines: DataFrame, ancestors: DataFrame, least: float, size: float) -> DataFrame:
    """id, line_id, x, y of each of polygons(id, ring): of lines(id, line) with more than the least length inside, the one of most ancestors(id, n), the greatest id on
    ties; null without one. Lines that ancestors lacks don't count. x, y is the polygon's centroid."""
    inside = geometry.inside_length(F.col("ring"), *map(F.col, _SEGMENT))
    long = _met(polygons, lines, size).select("polygon_id", "line_id", inside.alias("inside")).groupBy("polygon_id", "line_id").agg(F.sum("inside").alias("inside")).where(F.col("inside") > least)
    known = long.join(ancestors.select(F.col("id").alias("line_id"), "n"), "line_id")
    best = arg_max(known.select("polygon_id", "line_id", "n"), ["polygon_id"], F.col("n"), F.col("line_id"))
    out = polygons.select("id", geometry.centroid(F.col("ring")).alias("c")).join(best, F.col("id") == F.col("polygon_id"), "left")
    return out.select("id", "line_id", F.col("c.x").alias("x"), F.col("c.y").alias("y"))


def lake_paths(lakes: DataFrame, lines: DataFrame, size: float) -> DataFrame:
    """id, line_id: all lines(id, line) that meet each of lakes(id, ring, line_id), or the line_id that a lake had before if none does."""
    meets = geometry.meets(F.col("ring"), *map(F.col, _SEGMENT))
    found = _met(lakes.select("id", "ring"), lines, size).where(meets).select(F.col("polygon_id").alias("id"), "line_id").distinct()
    rest = lakes.join(found.select("id").distinct(), "id", "left_anti").select("id", "line_id")
    return found.unionByName(rest)
