"""The base network as a job, lakes and gages on inline rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from fluvial.operators import build, gages, lakes
from fluvial.plans import jobs


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_base_network_job(spark, tmp_path):
    rnd = random.Random(2)
    down = {i: None if i == 1 else rnd.randrange(max(1, i - 4), i) for i in range(1, 60)}
    reaches = spark.createDataFrame([(i, d, i, 1000.0 * rnd.randrange(1, 5), rnd.choice([1e4, 5e6]), rnd.random() < 0.8) for i, d in down.items()], "id long, down long, hydroseq long, length_m double, area_m2 double, has_divide boolean")
    job = jobs.Job(spark, str(tmp_path))
    for task, makes in jobs.base_network(reaches):
        job.run(task, makes)
    paths = {r.fp_id: r for r in job.tables["flowpaths"].collect()}
    assert paths
    nexus = {r.nex_id: r.dn_fp_id for r in job.tables["nexus"].collect()}
    for r in paths.values():
        assert nexus[r.dn_nex_id] == r.fp_to_id
        assert r.fp_to_id is None or r.fp_to_id in paths
        assert r.up_nex_id is None or nexus[r.up_nex_id] == r.fp_id
    assert {r.check_name: r.n for r in job.tables["report"].collect()} == {"cyclic": 0, "out of range": 0}

    def never(spark, tables):
        raise AssertionError("ran again")

    job.run(never, ["flowpaths", "nexus"])


def test_segments_and_coverage(spark):
    s = spark.createDataFrame([(1, 1, 1.0, 2.0, 6.0), (1, 2, 3.0, 0.0, 6.0), (2, 3, 1.0, 8.0, 4.0)], "unit long, seg_id long, length double, overlap double, budget double")
    assert rows(build.segment_areas(s)) == [(1, 1, 3.0), (1, 2, 3.0), (2, 3, 4.0)]
    v = spark.createDataFrame([(1, 10), (2, 10)], "virtual_fp_id long, div_id long")
    x = spark.createDataFrame([(1, 10, 7), (1, 10, 5)], "virtual_fp_id long, div_id long, ref_fp_id long")
    assert rows(build.covered(v, x)) == [(1, 10, 5), (1, 10, 7), (2, 10, 5)]
    refs = spark.createDataFrame([(7, 0, 1, 70), (7, 2, 2, 71), (8, None, 3, 80)], "ref_fp_id long, segment_order int, virtual_fp_id long, fp_id long")
    f = spark.createDataFrame([("g", 7), ("h", 8), ("i", None)], "site string, ref_fp_id long")
    assert rows(build.crosswalk_ids(f, refs, ["virtual_fp_id", "fp_id"]).select("site", "virtual_fp_id", "fp_id")) == [("g", 2, 71), ("h", 3, 80), ("i", None, None)]


def test_lakes(spark):
    l = spark.createDataFrame([("a", "nwm", 5.0, "d1"), ("a", "nid", 1.0, "d2"), ("b", None, None, "d3"), ("b", "x", 9.0, "d4")], "lake_id string, source string, hydroseq double, dam_id string")  # noqa: E741
    assert rows(lakes.dedup_lakes(l).select("lake_id", "dam_id")) == [("a", "d1"), ("b", "d4")]
    nhf = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "nhf_lake_id long, lake_id string")
    one = spark.createDataFrame([("a", "s1", 2), ("b", "s2", 3), ("c", "s3", 2), ("c", "s3", 2)], "lake_id string, site_no string, da_type int")
    two = spark.createDataFrame([("a", "s4", 4), ("b", "s5", 1)], "lake_id string, site_no string, da_type int")
    assert rows(lakes.assimilation(nhf, one, two)) == [(1, "a", "s4", 4), (2, "b", "s2", 3), (3, "c", None, 1), (4, "d", None, 1)]
    r = spark.createDataFrame([("1", 5, 10.0, 1.0), ("2", 6, 10.0, 0.01), ("3", None, 1.0, 9.0), ("4", 7, 1.0, 9.0), ("5", 8, 99.0, 9.0)], "dam_id string, ref_fab_wb long, distance double, area double")
    taken = spark.createDataFrame([("4",), (None,)], "dam_id string")
    assert rows(lakes.reservoir_criteria(r, [taken], most_distance=50, least_area=0.5, keep=("2",)).select("dam_id")) == [("1",), ("2",)]
    index = spark.createDataFrame([(5, bytearray(b" 01 ")), (-99999, bytearray(b"x"))], "lake_id long, gage binary")
    assert rows(lakes.index_sites(index, lakes.USGS)) == [("5", "01", 2)]


def test_gages(spark):
    base = spark.createDataFrame([("1", "n1", "USGS", None), ("2", "n2", "USGS", 4.0)], "site_no string, name string, status string, area_sqkm double")
    shapes = [spark.createDataFrame([("2", "N2"), ("3", "N3")], "site_no string, name string")]
    tables = [spark.createDataFrame([("1", "ignored"), ("4", "N4")], "site_no string, name string")]
    partners = {"adhoc": spark.createDataFrame([("55OT", "a")], "site_no string, name string"), "usbr": spark.createDataFrame([(7.0, "u")], "site_no double, name string")}
    link = spark.createDataFrame([(" 1 ", "x"), (" 9 ", "r"), (" ", "b")], "site_no string, name string")
    areas = spark.createDataFrame([("1", 2.5)], "site_no string, area_sqkm double")
    over = spark.createDataFrame([("9", "over")], "site_no string, name string")
    out = gages.build(base, shapes, tables, partners, link, areas, over).select("site_no", "name", "status", "area_sqkm")
    assert rows(out) == sorted(
        [("1", "n1", "USGS", 2.5), ("2", "N2", "USGS", 4.0), ("3", "N3", "-", None), ("4", "N4", "-", None), ("55", "a", "adhoc_lakes", None), ("usbr-7", "u", "USBR", None), ("9", "over", "routelink", None)], key=repr
    )
    f = spark.createDataFrame([("a", "year-round"), ("b", "no"), ("c", None)], "site_no string, forecast_status string")
    assert rows(gages.forecast_points(f, spark.createDataFrame([("b",)], "site_no string"), "year-round").select("site_no")) == [("a",), ("b",)]
    assert f.where(F.col("site_no").isNull()).count() == 0
