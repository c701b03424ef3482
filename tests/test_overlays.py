"""Overlays on the small shapes of the published examples, and kernels against sampling."""

from __future__ import annotations

import numpy as np

from fluvial.functions.geometry import LINE
from fluvial.operators import overlays


def points(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def box(a, b, c, d):
    return points((a, b), (c, b), (c, d), (a, d), (a, b))


def test_buffer_crosswalk(spark):
    refs = spark.createDataFrame([(1, points((0, 0), (10, 0))), (2, points((5000, 5000), (5010, 5000)))], f"id long, line {LINE}")
    near = spark.createDataFrame([(100, points((0, 0), (5, 0))), (101, points((5, 0), (10, 0))), (102, points((5, 0), (5, 8)))], f"id long, line {LINE}")
    assert sorted(map(tuple, overlays.buffer_crosswalk(refs, near, 2.0, 0.5).collect())) == [(1, 100, 1.0), (2, None, None)]
    part = near.where("id = 102")
    assert sorted(map(tuple, overlays.buffer_crosswalk(refs, part, 2.0, 0.5).collect())) == [(1, None, 0.25), (2, None, None)]
    far = spark.createDataFrame([(7, points((1000, 0), (1010, 0)))], f"id long, line {LINE}")
    assert {r.best for r in overlays.buffer_crosswalk(refs, far, 2.0, 0.5).collect()} == {None}


def test_a_line_that_goes_back_counts_each_way(spark):
    refs = spark.createDataFrame([(1, points((0, 0), (10, 0)))], f"id long, line {LINE}")
    back = spark.createDataFrame([(5, points((0, 0), (5, 0), (0, 0), (5, 0)))], f"id long, line {LINE}")
    assert sorted(map(tuple, overlays.buffer_crosswalk(refs, back, 1.0, 0.5).collect())) == [(1, 5, 1.0)]


def test_capsule_interval_against_sampling():
    rnd = np.random.default_rng(1)
    p0, p1, a, b = (rnd.uniform(-3, 3, (200, 2)) for _ in range(4))
    b[:10] = a[:10]
    lo, hi = overlays.capsule_interval(p0, p1, a, b, 1.0)
    t = np.linspace(0, 1, 2001)
    for i in range(200):
        x = p0[i] + t[:, None] * (p1[i] - p0[i])
        u = b[i] - a[i]
        k = np.clip(((x - a[i]) @ u) / max((u @ u), 1e-30), 0, 1)
        inside = np.hypot(*(x - a[i] - k[:, None] * u).T) <= 1.0
        share = max(0.0, hi[i] - lo[i]) if lo[i] <= hi[i] else 0.0
        assert abs(share - inside.mean()) < 2e-3


def test_overlap_percent_and_points(spark):
    divides = spark.createDataFrame([(1, box(0, 0, 2, 2)), (2, box(2, 2, 4, 4)), (3, box(9, 9, 10, 10))], f"id long, ring {LINE}")
    glaciers = spark.createDataFrame([(1, box(0, 0, 1, 1)), (2, box(2, 2, 2.5, 2.5))], f"id long, ring {LINE}")
    assert sorted(map(tuple, overlays.overlap_percent(divides, glaciers, 3.0).collect())) == [(1, 25.0), (2, 6.25), (3, 0.0)]
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 8.0, 8.0), (4, None, 1.0)], "id long, x double, y double")
    assert sorted(map(tuple, overlays.points_in_polygons(p, divides, 3.0).collect())) == [(1, 1), (2, 2)]
