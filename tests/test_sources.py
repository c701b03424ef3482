"""Readers and writers on files made here."""

from __future__ import annotations

import sqlite3
import struct
import zipfile

import numpy as np
import pytest

from fluvial.sources import files, sinks


def test_rdb_and_csv(spark, tmp_path):
    p = tmp_path / "gages.txt"
    p.write_text("# head\nagency_cd\tsite_no\tdec_lat_va\tdec_long_va\n5s\t15s\t16n\t16n\nUSGS\t 0123 \t30.5\t-97\nUSGS\t0456\t.\t-97\nUSGS\t0789\tbad\t-97\n")
    assert [tuple(r) for r in files.read_rdb(spark, str(p)).collect()] == [("USGS", "0123", 30.5, -97.0)]
    c = tmp_path / "xy.csv"
    c.write_text("gageid,lon,lat\n 01 ,-1.5,2\n02,x,2\n03,1,\n04,1,1\n")
    assert [tuple(r) for r in files.read_xy_csv(spark, str(c), exclude=("04",)).collect()] == [("01", -1.5, 2.0)]


def test_kmz(spark, tmp_path):
    kml = """<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark><name>&lt;b&gt;Creek&lt;/b&gt;</name><description>http://x?site_no=01234567</description>
    <MultiGeometry><Point><coordinates>-97.5,30.25,0</coordinates></Point><Point><coordinates>1,2</coordinates></Point></MultiGeometry></Placemark>
    <Placemark><name>none</name></Placemark></Document></kml>"""
    with zipfile.ZipFile(tmp_path / "streamgages_new_york.kmz", "w") as z:
        z.writestr("doc.kml", kml)
    got = files.read_kmz_gages(spark, str(tmp_path)).collect()
    assert [(r.site_no, r.name_plain, r.state, r.status, r.x, r.y) for r in got] == [("01234567", "Creek", "New York", "USGS-discontinued", -97.5, 30.25), ("01234567", "Creek", "New York", "USGS-discontinued", 1.0, 2.0)]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        files.read_kmz_gages(spark, str(tmp_path / "empty"))


@pytest.mark.parametrize(("width", "code"), [(2, "<i2"), (4, "<f4")])
def test_xmrg(spark, tmp_path, width, code):
    record = lambda b: struct.pack("<i", len(b)) + b + struct.pack("<i", len(b))
    data = record(struct.pack("<2f2i", 10, 20, 3, 2)) + record(struct.pack("<2i2f", 10, width, 2.0, -1.0)) + record(np.array([1, 20, -1], code).tobytes()) + record(np.array([30, -5, 40], code).tobytes())
    p = tmp_path / "a.xmrg"
    p.write_bytes(data)
    got = {(r.row, r.col): (r.x, r.y, r.value) for r in files.read_xmrg(spark, str(p)).collect()}
    assert got[0, 1] == (12.0, 20.0, 2.0)
    assert got[0, 2][2] is None
    assert got[1, 1][2] is None
    assert got[1, 2] == (14.0, 22.0, 4.0)


def test_geopackage_and_npy(spark, tmp_path):
    p = str(tmp_path / "a.gpkg")
    with sqlite3.connect(p) as con:
        con.execute("CREATE TABLE gpkg_contents (x TEXT)")
        con.execute("CREATE TABLE lakes (fid INTEGER, name TEXT, area REAL, geom BLOB)")
        con.executemany("INSERT INTO lakes VALUES (?, ?, ?, ?)", [(1, "a", 2.5, b"\x01"), (2, None, None, None)])
    df = files.read_any(spark, p, "lakes")
    assert df.dtypes == [("fid", "bigint"), ("name", "string"), ("area", "double"), ("geom", "binary")]
    assert [tuple(r) for r in df.orderBy("fid").collect()] == [(1, "a", 2.5, bytearray(b"\x01")), (2, None, None, None)]
    with pytest.raises(ValueError, match="no layer"):
        files.read_any(spark, p, "rivers")
    with pytest.raises(ValueError, match="no reader"):
        files.read_any(spark, "x.shp")
    np.save(tmp_path / "q.npy", np.array([[1.0, 2.0], [3.0, 4.0]]))
    assert sorted((r.row, r.day, r.q) for r in files.read_npy_matrix(spark, str(tmp_path / "q.npy")).collect()) == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "g", 2)], "fp_id long, gid string, n int")
    assert sinks.ids_as_doubles(df).dtypes == [("fp_id", "double"), ("gid", "string"), ("n", "int")]
    path = str(tmp_path / "layers")
    sinks.write_layers({"flowpaths": df, "empty": df.limit(0)}, path)
    assert spark.read.parquet(f"{path}/empty").dtypes == df.dtypes
    sinks.replace_layer(spark.read.parquet(f"{path}/flowpaths").union(df), f"{path}/flowpaths")
    assert spark.read.parquet(f"{path}/flowpaths").count() == 2
    sinks.write_sqlite_table(df, str(tmp_path / "x.db"), "t")
    with sqlite3.connect(tmp_path / "x.db") as con:
        assert con.execute("SELECT * FROM t").fetchall() == [(1, "g", 2)]
    sinks.write_report({"rows": df}, str(tmp_path / "r.json"))
    with pytest.raises(ValueError, match="no report"):
        sinks.write_report({"rows": spark.range(5)}, str(tmp_path / "r.json"), most_rows=3)
