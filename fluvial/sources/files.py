"""Readers of the file formats that river-network data come in. Binary formats are split by file: each is parsed whole in one task."""

from __future__ import annotations

import io
import os
import re
import sqlite3
import struct
import tempfile
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fluvial.functions import scalars

KMZ_SCHEMA = "site_no string, name_plain string, state string, name_raw string, description string, status string, x double, y double"


def reference_table(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A Parquet table with its id as text without decimals."""
    return spark.read.parquet(path).withColumn(key, scalars.id_text(F.col(key)))


def read_any(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """A Parquet file, or a layer of a GeoPackage; any other extension is an error."""
    kind = os.path.splitext(path.rstrip("/"))[1].lower()
    if kind == ".parquet":
        return spark.read.parquet(path)
    if kind == ".gpkg":
        return read_gpkg(spark, path, layer)
    raise ValueError(f"no reader for {kind or 'a path without extension'}")


def read_rdb(spark: SparkSession, path: str, numbers: tuple[str, ...] = ("dec_lat_va", "dec_long_va", "alt_va")) -> DataFrame:
    """Tab-separated text: # lines and the row of column widths are passed over, cells trimmed, "", blanks and . are null, numbers parsed, rows without coordinates dropped."""
    raw = spark.read.csv(path, sep="\t", comment="#", header=True, inferSchema=False)
    clean = {c: F.trim(F.col(f"`{c}`")) for c in raw.columns}
    clean = {c: F.when(~v.isin("", "."), v) for c, v in clean.items()}
    rows = raw.select(*(v.alias(c) for c, v in clean.items()))
    if "agency_cd" in rows.columns:
        rows = rows.where(F.col("agency_cd").isNull() | ~F.col("agency_cd").rlike(r"^\d+s$"))
    present = [c for c in numbers if c in rows.columns]
    rows = rows.withColumns({c: F.col(c).try_cast("double") for c in present})
    return rows.dropna(subset=[c for c in present if c != "alt_va"])


def read_xy_csv(spark: SparkSession, path: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """site_no, x, y of a CSV with gageid, lon, lat: ids trimmed, rows with a bad or missing value and excluded ids dropped."""
    rows = spark.read.csv(path, header=True, schema="gageid string, lon string, lat string")
    out = rows.select(F.trim("gageid").alias("site_no"), F.col("lon").try_cast("double").alias("x"), F.col("lat").try_cast("double").alias("y"))
    return out.where(F.col("site_no") != "").dropna().where(~F.col("site_no").isin(list(exclude)) if exclude else F.lit(True))


def _kml_points(data: bytes) -> Iterator[tuple[str | None, str | None, float, float]]:
    """name, description, x, y of the points of a KML document, multi-points one by one."""
    local = lambda e: e.tag.rpartition("}")[2]
    for mark in (e for e in ElementTree.fromstring(data).iter() if local(e) == "Placemark"):
        text = {local(e): e.text for e in mark if local(e) in ("name", "description")}
        for point in (e for e in mark.iter() if local(e) == "Point"):
            for at in (e for e in point.iter() if local(e) == "coordinates" and e.text and e.text.strip()):
                x, y = at.text.strip().split(",")[:2]
                yield text.get("name"), text.get("description"), float(x), float(y)


def read_kmz_gages(spark: SparkSession, folder: str) -> DataFrame:
    """Gages of the *.kmz files of a folder whose names hold streamgages_; none is an error, files without points give no rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*streamgages_*.kmz").load(folder)
    if files.limit(1).count() == 0:
        raise FileNotFoundError(f"no streamgages_ kmz in {folder}")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in (n for n in z.namelist() if n.lower().endswith(".kml")):
                        rows += [(os.path.splitext(os.path.basename(path))[0], *p) for p in _kml_points(z.read(name))]
            yield pd.DataFrame(rows, columns=["stem", "name", "description", "x", "y"])

    points = files.select("path", "content").mapInPandas(parse, "stem string, name string, description string, x double, y double")
    name, text = F.col("name"), F.col("description")
    return points.select(
        F.coalesce(scalars.site_no(text), scalars.site_no(name)).alias("site_no"), scalars.strip_html(name).alias("name_plain"), scalars.state_from_file_name(F.col("stem")).alias("state"),
        name.alias("name_raw"), text.alias("description"), F.lit("USGS-discontinued").alias("status"), "x", "y",
    )


def xmrg_cells(data: bytes) -> pd.DataFrame:
    """row, col, x, y, value of an XMRG grid, rows from the south; values at or under the fill are NaN, others divided by the scale.

    The file is a run of little-endian records, each between two copies of its length: origin (2 float32) and size (2 int32); scale and
    bytes of a value (2 int32), cell width and fill (2 float32); then a record for each row, of int16 or float32 values.
    """
    records, at = [], 0
    while at < len(data):
        n = struct.unpack_from("<i", data, at)[0]
        records.append(data[at + 4 : at + 4 + n])
        at += n + 8
    x0, y0, n_col, n_row = struct.unpack("<2f2i", records[0])
    scale, width, cell, fill = struct.unpack("<2i2f", records[1])
    if width not in (2, 4):
        raise ValueError(f"values of {width} bytes")
    grid = np.stack([np.frombuffer(r, "<i2" if width == 2 else "<f4", n_col) for r in records[2 : 2 + n_row]]).astype(float)
    value = np.where(grid > fill, grid / scale, np.nan)
    r, c = np.indices(grid.shape)
    return pd.DataFrame({"row": r.ravel().astype("int64"), "col": c.ravel().astype("int64"), "x": x0 + c.ravel() * cell, "y": y0 + r.ravel() * cell, "value": value.ravel()})


def read_xmrg(spark: SparkSession, path: str) -> DataFrame:
    """path, row, col, x, y, value of XMRG grids."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                yield xmrg_cells(bytes(content)).assign(path=p)[["path", "row", "col", "x", "y", "value"]]

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(parse, "path string, row long, col long, x double, y double, value double").withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def read_npy_matrix(spark: SparkSession, path: str) -> DataFrame:
    """path, row, day, q of .npy matrices, long form; ids of the rows are joined by the caller."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                m = np.atleast_2d(np.load(io.BytesIO(bytes(content)), allow_pickle=False)).astype(float)
                for at in range(0, len(m), 1000):
                    part = m[at : at + 1000]
                    r, d = np.indices(part.shape)
                    yield pd.DataFrame({"path": p, "row": (r.ravel() + at).astype("int64"), "day": d.ravel().astype("int64"), "q": part.ravel()})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, row long, day long, q double")


_SQLITE_TYPES = {"INT": "long", "MEDIUMINT": "long", "INTEGER": "long", "BIGINT": "long", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean"}


def _gpkg_schema(columns: list[tuple[str, str]]) -> str:
    kind = lambda t: _SQLITE_TYPES.get(t.upper(), "string" if re.match(r"TEXT|VARCHAR|CHAR|DATE", t.upper()) else "binary")
    return ", ".join(f"`{n}` {kind(t)}" for n, t in columns)


def _with_sqlite(content: bytes, use):
    """use(connection) on a database held in bytes, by way of a file that lives no longer than the call."""
    with tempfile.NamedTemporaryFile(suffix=".gpkg") as f:
        f.write(content)
        f.flush()
        with sqlite3.connect(f.name) as con:
            return use(con)


def read_gpkg(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """A layer of a GeoPackage, or of several alike; the first layer if none is named. Geometries stay GeoPackage blobs (see geometry.from_gpkg).

    The files are read by Spark, so any store will do; each is parsed in one task, in pages of rows.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    first = files.limit(1).collect()
    if not first:
        raise FileNotFoundError(path)

    def describe(con: sqlite3.Connection) -> tuple[str, list[tuple[str, str]]]:
        names = [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'gpkg_%' AND name NOT LIKE 'rtree_%' AND name NOT LIKE 'sqlite_%'")]
        name = layer or names[0]
        if name not in names:
            raise ValueError(f"no layer {name}; there are {', '.join(names)}")
        return name, [(r[1], r[2]) for r in con.execute(f'PRAGMA table_info("{name}")')]

    name, columns = _with_sqlite(bytes(first[0].content), describe)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with tempfile.NamedTemporaryFile(suffix=".gpkg") as f:
                    f.write(content)
                    f.flush()
                    with sqlite3.connect(f.name) as con:
                        yield from pd.read_sql_query(f'SELECT * FROM "{name}"', con, chunksize=10_000, dtype_backend="numpy_nullable")

    return files.mapInPandas(parse, _gpkg_schema(columns))


def empty_table(spark: SparkSession, schema: str | StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_optional(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """The Parquet table at path, or an empty one of the schema where path is None."""
    return empty_table(spark, schema) if path is None else spark.read.parquet(path)
