"""Geometry, projections, location ids and streams."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvial.functions import geometry as g
from fluvial.operators import location_ids, spatial
from fluvial.streaming import upserts


def points(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def test_measures(spark):
    square, line = points((0, 0), (4, 0), (4, 2), (0, 2), (0, 0)), points((0, 0), (3, 4), (3, 10))
    df = spark.createDataFrame([(square, line)], f"ring {g.LINE}, line {g.LINE}")
    r = df.select(
        g.length(F.col("line")).alias("length"), g.area(F.col("ring")).alias("area"), g.centroid(F.col("ring")).alias("c"), g.envelope(F.col("line")).alias("e"),
        g.contains(F.col("ring"), F.lit(1.0), F.lit(1.0)).alias("inside"), g.contains(F.col("ring"), F.lit(5.0), F.lit(1.0)).alias("outside"), g.point_at(F.col("line"), F.lit(8.0)).alias("p"),
        g.point_at(F.col("line"), F.lit(99.0)).alias("end"), g.last_point(F.col("line")).alias("last"),
    ).collect()[0]
    assert (r.length, r.area, tuple(r.c), tuple(r.e), r.inside, r.outside) == (11.0, 8.0, (2.0, 1.0), (0.0, 0.0, 3.0, 10.0), True, False)
    assert tuple(r.p) == (3.0, 7.0)
    assert tuple(r.end) == tuple(r["last"]) == (3.0, 10.0)


def test_kernels():
    line = np.array([(0, 0), (10, 0), (10, 10)], float)
    assert g.project(line, (11, 4)) == 14
    assert g.substring(line, 5, 12).tolist() == [[5, 0], [10, 0], [10, 2]]
    assert g.merge_lines([[(1, 1), (2, 2)], [(0, 0), (1, 1)], [(5, 5), (6, 6)]]) == [[(0, 0), (1, 1), (2, 2)], [(5, 5), (6, 6)]]
    box = lambda a, b, c, d: np.array([(a, b), (c, b), (c, d), (a, d), (a, b)], float)
    assert g.clipped_area(box(0, 0, 2, 2), box(1, 1, 5, 5)) == 1
    assert g.clipped_area(box(0, 0, 2, 2), box(1, 1, 5, 5)[::-1]) == 1
    assert g.clipped_area(box(0, 0, 1, 1), box(2, 2, 3, 3)) == 0


@pytest.mark.parametrize(("kind", "c"), [("Point", (1.0, 2.0)), ("LineString", [(0.0, 1.0), (2.0, 3.0)]), ("Polygon", [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]]), ("MultiPoint", [(0.0, 1.0)]), ("MultiPolygon", [[[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]]]), ("LineString", [])])
def test_binary_round_trip(spark, kind, c):
    data = g.to_wkb(kind, c)
    assert g.from_wkb(data) == (kind, c)
    assert g.from_gpkg(b"GP\x00\x01" + b"\x00" * 4 + data) == (kind, c)
    line = g.lines_from_wkb(spark.createDataFrame([(bytearray(data),), (None,)], "geometry binary"), "geometry").collect()
    want = c if kind == "LineString" else c[0] if kind == "Polygon" else None
    assert [None if r.line is None else [tuple(p) for p in r.line] for r in line] == [want, None]


def test_albers(spark):
    lon, lat = np.array([-96.0, -75.0, -120.0]), np.array([23.0, 35.0, 48.0])
    x, y = g.Albers(5070).forward(lon, lat)
    assert (x[0], y[0]) == (pytest.approx(0, abs=1e-6), pytest.approx(0, abs=1e-6))
    back = g.Albers(5070).inverse(x, y)
    assert np.allclose(back[0], lon)
    assert np.allclose(back[1], lat)
    df = spark.createDataFrame([(1, -90.0, 40.0)], "id long, x double, y double")
    r = g.reproject(g.reproject(df, 5070), 5070, inverse=True).collect()[0]
    assert (r.x, r.y) == (pytest.approx(-90), pytest.approx(40))


def test_location_ids_are_unique(spark):
    rows = [(0, k, 40.0, -90.0) for k in range(4)] + [(1, 0, 40.0, -90.0), (0, 10, 41.0, -91.0), (0, 11, None, 1.0)]
    out = location_ids.location_ids(spark.createDataFrame(rows, "rank int, key long, lat double, lon double"))
    got = {(r.rank, r.key): (r.gid, r.id) for r in out.collect()}
    assert len(got) == len(rows)
    assert got[0, 11] == (None, None)
    codes = [c for c, _ in got.values() if c]
    assert len(set(codes)) == len(codes)
    assert got[0, 0][0].startswith("86HG2222+22") or len(got[0, 0][0]) == 13
    assert location_ids.duplicates(out).count() == 0


def test_location_ids_of_crowded_places_are_unique(spark):
    rows = [(k % 2, k, 40.0 + 9e-6 * (k % 6), -90.0 + 9e-6 * (k % 5)) for k in range(300)]
    out = location_ids.location_ids(spark.createDataFrame(rows, "rank int, key long, lat double, lon double")).collect()
    assert len({r.gid for r in out}) == len({r.id for r in out}) == len(out) == 300


def test_nearest_line(spark):
    lines = spark.createDataFrame([(1, points((0, 0), (10, 0))), (2, points((0, 5), (10, 5)))], f"id long, line {g.LINE}")
    pts = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 2.5), (3, 50.0, 50.0), (4, None, 1.0)], "id long, x double, y double")
    assert {r.id: (r.line_id, r.dist) for r in spatial.nearest_line(pts, lines, 3.0).collect()} == {1: (1, 1.0), 2: (1, 2.5), 3: (None, None), 4: (None, None)}


def test_upserts_as_a_stream(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("1", "a"), ("2", "b")], "site string, name string").write.parquet(f"{out}/v=-1")
    spark.createDataFrame([("2", "x", 1), ("2", "B", 2), ("3", "C", 1)], "site string, name string, seq int").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("site string, name string, seq int").parquet(src)
    upserts.upsert_stream(stream, out, str(tmp_path / "cp"), "site", ["name"]).awaitTermination(60)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/v=0").collect())) == [("1", "a"), ("2", "B"), ("3", "C")]
