"""Shapes on cells against sampling, the small building rules, and settings."""

from __future__ import annotations

import random

import pytest

from fluvial import config
from fluvial.functions.geometry import LINE
from fluvial.operators import coverage, flows, keyed, outlets


def points(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_cells_under_a_star(spark):
    star = [(0, 5), (1.2, 1.4), (5, 1.5), (2, -1), (3, -5), (0, -2.5), (-3, -5), (-2, -1), (-5, 1.5), (-1.2, 1.4)]
    shapes = spark.createDataFrame([(1, points(*star)), (2, points(*star[::-1])), (3, None), (4, points((0, 0), (1, 1))), (5, points((0, 0), (1, 0), (1, 1), (0, 1)))], f"id long, ring {LINE}")
    got = {tuple(r)[:3]: r.weight for r in coverage.cell_weights(shapes, 2.0).collect()}
    assert {z for z, _, _ in got} == {1, 2, 5}
    assert got[5, 0, 0] == pytest.approx(0.25)
    assert all(got[1, r, c] == pytest.approx(w) for (z, r, c), w in got.items() if z == 2)

    def inside(x, y):
        odd = False
        for (ax, ay), (bx, by) in zip(star, star[1:] + star[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
        return odd

    rnd = random.Random(1)
    for r in range(-3, 3):
        for c in range(-3, 3):
            share = sum(inside(2 * c + 2 * rnd.random(), 2 * r + 2 * rnd.random()) for _ in range(3000)) / 3000
            assert got.get((1, r, c), 0.0) == pytest.approx(share, abs=0.04)


def test_values_under_points_and_ends(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (0, 1, -9.0), (1, 0, 5.0)], "row int, col int, value double")
    at = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 0.5), (3, 9.0, 9.0), (4, None, 1.0)], "id int, x double, y double")
    assert rows(coverage.cell_values(at, cells, 1.0, -9.0).select("id", "value")) == [(1, 1.0), (2, None), (3, None), (4, None)]
    lines = spark.createDataFrame([(1, points((0.5, 0.5), (7, 7), (0.5, 1.5))), (1, points((1.5, 0.5), (0.1, 0.1))), (2, points((1.5, 0.5), (9, 9))), (3, None)], f"id int, line {LINE}")
    assert rows(coverage.end_values(lines, cells, 1.0, -9.0)) == [(1, pytest.approx(7 / 3)), (2, None), (3, None)]


def test_outlets_are_combined(spark):
    nexuses = spark.createDataFrame([(5, 1.0, 2.0, None), (9, 1.0, 2.0, None), (6, 1.0, 2.0, 4), (7, 3.0, 3.0, 4)], "nex_id long, x double, y double, dn_fp_id long")
    paths = spark.createDataFrame([(1, 9, 5), (2, None, 9), (3, 6, 7)], "fp_id long, up_nex_id long, dn_nex_id long")
    out, kept = outlets.combine(paths, nexuses)
    assert rows(out) == [(1, 5, 5), (2, None, 5), (3, 6, 7)]
    assert sorted(r.nex_id for r in kept.collect()) == [5, 6, 7]


def test_settings(tmp_path, monkeypatch):
    monkeypatch.setenv("PLACE", "there")
    file = tmp_path / "a.yaml"
    file.write_text("root: /r\npaths: ['{root}/x', '{PLACE}/y', '{nowhere_at_all}/z']\nattributes:\n  slope: {file: '{root}/s'}\n  aspect:\n")
    got = config.load(file)
    assert got["paths"] == ["/r/x", "there/y", "{nowhere_at_all}/z"]
    assert got["attributes"] == [{"name": "slope", "file": "/r/s"}, {"name": "aspect"}]
    assert got["data_dir"] == "data"
    file.write_text("- 1\n")
    with pytest.raises(ValueError, match="mapping"):
        config.load(file)


def test_weighted_flows_have_every_day(spark):
    weights = spark.createDataFrame([(1, 10, 0.25), (1, 11, 0.5), (1, 12, 0.25), (2, 99, 1.0)], "ref_id long, comid long, fraction double")
    daily = spark.createDataFrame([(10, 1, 4.0), (11, 1, 1.0), (10, 2, 3.0)], "comid long, day int, q double")
    assert rows(flows.weighted_flows(weights, daily)) == [(1, 1, pytest.approx(2.0)), (1, 2, pytest.approx(1.0)), (2, 1, 0.0), (2, 2, 0.0)]
    assert flows.weighted_flows(weights, daily.limit(0)).count() == 0


def test_running_ids_go_on_from_table_to_table(spark):
    one = spark.createDataFrame([(k, "a") for k in (5, 3, 9)], "k int, t string")
    two = spark.createDataFrame([(k, "b") for k in range(40)], "k int, t string")
    got = sorted((r.hy_id, r.t, r.k) for r in keyed.running_ids([one, two], ["k"]).collect())
    assert got == [(i + 1, *x) for i, x in enumerate([("a", 3), ("a", 5), ("a", 9), *(("b", k) for k in range(40))])]
    assert keyed.running_ids([one.limit(0)], ["k"]).count() == 0
