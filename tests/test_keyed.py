"""Keyed operators and scalar rules on inline rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fluvial.functions import hydraulics, scalars
from fluvial.operators import flows, keyed, validate, zonal


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_keeps_updates_and_appends(spark):
    master = spark.createDataFrame([("1", "a", "x", 5), ("2", "b", "y", 6)], "site string, name string, status string, n int")
    new = spark.createDataFrame([("2", "B"), ("3", "C")], "site string, name string")
    assert rows(keyed.upsert(master, new, "site", update=["name"])) == [("1", "a", "x", 5), ("2", "B", "y", 6), ("3", "C", "-", None)]
    assert rows(keyed.upsert(master, new, "site", update=["name"], update_existing=False)) == [("1", "a", "x", 5), ("2", "b", "y", 6), ("3", "C", "-", None)]


def test_remap_fails_on_an_unknown_id(spark):
    ids = spark.createDataFrame([(1, None), (2, 1)], "a long, b long")
    mapping = spark.createDataFrame([(1, 10), (2, 20)], "old_id long, new_id long")
    assert rows(keyed.remap(ids, mapping, ["a", "b"])) == [(10, None), (20, 10)]
    with pytest.raises(Exception, match="no new id"):
        keyed.remap(spark.createDataFrame([(7, 1)], "a long, b long"), mapping, ["a"]).collect()


def test_priority_merge_drops_all_copies(spark):
    df = spark.createDataFrame([("a", 2), ("a", 2), ("a", 4), ("b", 1), (None, 3)], "lake string, code int")
    assert rows(keyed.without_copies(df, ["lake", "code"])) == [("a", 4), ("b", 1), (None, 3)]
    assert rows(keyed.arg_max(df, ["lake"], F.col("code"))) == [("a", 4), ("b", 1), (None, 3)]


def test_anti_joins_treat_missing_keys_as_asked(spark):
    a = spark.createDataFrame([("1", None), ("2", "n2"), ("3", "n3")], "lake string, nid string")
    known = spark.createDataFrame([("9", None), ("8", "n3")], "lake string, nid string")
    assert rows(keyed.anti_any(a, known, ["lake", "nid"])) == [("1", None), ("2", "n2")]
    assert rows(keyed.anti_any_as_text(a, known, ["lake", "nid"])) == [("2", "n2")]


def test_fill_override_complete(spark):
    a = spark.createDataFrame([(1, None, "b"), (2, 5.0, "b")], "id long, area double, source string")
    other = spark.createDataFrame([(1, 9.0), (2, 7.0)], "id long, area double")
    assert rows(keyed.fill_missing(a, other, "id", "area", "csv")) == [(1, 9.0, "csv"), (2, 5.0, "b")]
    assert rows(keyed.override(a, other, "id", ["area"])) == [(1, 9.0, "b"), (2, 7.0, "b")]
    assert keyed.complete(a, {"id": "long", "extra": "string"}).dtypes == [("id", "bigint"), ("extra", "string")]
    with pytest.raises(ValueError, match="missing columns: nope"):
        keyed.require(a, ["id", "nope"])


def test_zonal_statistics(spark):
    cells = spark.createDataFrame([(1, 350.0, 1.0), (1, 10.0, 1.0), (1, None, 1.0), (2, 1.0, 1.0), (2, 100.0, 3.0), (3, 5.0, 0.0)], "zone long, value double, weight double")
    out = {r.zone: r for r in zonal.statistics(cells, m=zonal.mean(), c=zonal.circular_mean(), g=zonal.geometric_mean()).collect()}
    assert set(out) == {1, 2}
    assert out[1].c % 360 == pytest.approx(0, abs=1e-9) or out[1].c == pytest.approx(360)
    assert out[2].m == pytest.approx(75.25)
    assert out[2].g == pytest.approx(100**0.75)
    assert rows(zonal.mode(cells)) == [(1, 10.0), (2, 100.0)]
    assert rows(zonal.quantiles(cells)) == [(1, 10.0, 10.0, 350.0, 350.0), (2, 1.0, 100.0, 100.0, 100.0)]


def test_hydraulics_golden_row(spark):
    """The published example of the rules: heights of 22 m, ogee crest, both elevations known."""
    dam = spark.createDataFrame(
        [("Gravity", "Ogee", 22.0, 85.0, 0.5, 1515.0, 1500.0)], "dam_type string, spillway_type string, structural_height double, dam_length double, ref_area_sqkm double, ref_elev double, dam_elev double"
    )
    r = hydraulics.reservoir_hydraulics(dam).collect()[0]
    assert (r.H_m, r.LkArea, r.WeirL, r.WeirC, r.WeirE, r.OrificeA, r.ifd) == (22.0, 0.5, 85.0, 1.7, 1515.0, 0.9, 0.899)
    assert r.LkMxE == pytest.approx(1517.2)
    assert r.OrificeE == pytest.approx(1503.3)
    empty = hydraulics.reservoir_hydraulics(spark.createDataFrame([("x",)], "name string")).collect()[0]
    assert (empty.WeirL, empty.WeirC, empty.OrificeC, empty.OrificeA, empty.Dam_Length, empty.WeirE) == (10.0, 0.4, 0.1, 1.0, 10.0, None)


def test_scalars(spark):
    df = spark.createDataFrame([("u?SITE_NO=0123&x", "<b>hi</b> "), ("no 0123456 here", None), ("a1234", "")], "a string, b string")
    assert [r[0] for r in df.select(scalars.site_no(F.col("a"))).collect()] == ["0123", "0123456", None]
    assert [r[0] for r in df.select(scalars.strip_html(F.col("b"))).collect()] == ["hi", None, ""]
    code = spark.range(1).select(scalars.location_code_number(F.lit("87MFRHPG+FRJP")).alias("n"), scalars.location_code(F.lit(47.0000625), F.lit(8.0000625), 12).alias("c")).collect()[0]
    assert code.n == 1286907630478654
    assert code.c.startswith("8FVC2222+22")


def test_flows_and_reports(spark):
    members = spark.createDataFrame([(1, 1, 3.0), (1, 2, 1.0), (1, 3, None), (2, 4, None)], "unit long, member long, area double")
    assert rows(flows.unit_shares(members)) == [(1, 1, 0.75), (1, 2, 0.25), (1, 3, 0.0), (2, 4, 0.0)]
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, 5.0)], "id long, x double")
    assert rows(validate.violations(df, "id", {"x": (0.0, 4.0, True)})) == [(1, "x", "too small", 0.0), (2, "x", "missing", None), (3, "x", "too large", 5.0)]
    assert rows(validate.null_counts(df, ["id", "x"])) == [("id", 0), ("x", 1)]
    with pytest.raises(ValueError, match="2 keys"):
        validate.assert_complete(df, spark.createDataFrame([(1,)], "id long"), "id")
