"""Geometry on coordinate arrays: a line is ARRAY<STRUCT<x, y>>, a polygon its outer ring closed. Measures are column expressions; what is procedural runs on Arrow batches."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE = "array<struct<x:double,y:double>>"


def _steps(line: Column) -> Column:
    """Pairs of consecutive points."""
    n = F.greatest(F.size(line) - 1, F.lit(0))
    return F.arrays_zip(F.slice(line, F.lit(1), n).alias("a"), F.slice(line, F.lit(2), n).alias("b"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def length(line: Column) -> Column:
    return _sum(F.transform(_steps(line), lambda p: F.sqrt((p["b"]["x"] - p["a"]["x"]) ** 2 + (p["b"]["y"] - p["a"]["y"]) ** 2)))


def _cross(p: Column) -> Column:
    return p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"]


def area(ring: Column) -> Column:
    return F.abs(_sum(F.transform(_steps(ring), _cross))) / 2


def centroid(ring: Column) -> Column:
    """Area centroid of a ring as a struct (x, y); null for a ring without area."""
    steps = _steps(ring)
    twice = _sum(F.transform(steps, _cross))
    x = _sum(F.transform(steps, lambda p: (p["a"]["x"] + p["b"]["x"]) * _cross(p)))
    y = _sum(F.transform(steps, lambda p: (p["a"]["y"] + p["b"]["y"]) * _cross(p)))
    return F.when(twice != 0, F.struct((x / (3 * twice)).alias("x"), (y / (3 * twice)).alias("y")))


def first_point(line: Column) -> Column:
    return F.try_element_at(line, F.lit(1))


def last_point(line: Column) -> Column:
    return F.try_element_at(line, F.lit(-1))


def envelope(line: Column) -> Column:
    low = lambda c: F.array_min(F.transform(line, lambda p: p[c]))
    high = lambda c: F.array_max(F.transform(line, lambda p: p[c]))
    return F.struct(low("x").alias("x0"), low("y").alias("y0"), high("x").alias("x1"), high("y").alias("y1"))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ring holds a point, by the parity of crossings to its right."""
    crossed = F.filter(_steps(ring), lambda p: ((p["a"]["y"] > y) != (p["b"]["y"] > y)) & (x < (p["b"]["x"] - p["a"]["x"]) * (y - p["a"]["y"]) / (p["b"]["y"] - p["a"]["y"]) + p["a"]["x"]))
    return F.size(crossed) % 2 == 1


def _crossings(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Where, as fractions of a segment, it crosses a ring's sides; sides along it don't count."""

    def at(p: Column) -> Column:
        dx, dy, ex, ey = x1 - x0, y1 - y0, p["b"]["x"] - p["a"]["x"], p["b"]["y"] - p["a"]["y"]
        wx, wy, turn = p["a"]["x"] - x0, p["a"]["y"] - y0, dx * ey - dy * ex
        t, u = F.try_divide(wx * ey - wy * ex, turn), F.try_divide(wx * dy - wy * dx, turn)
        return F.when(t.between(0, 1) & u.between(0, 1), t)

    return F.filter(F.transform(_steps(ring), at), lambda t: t.isNotNull())


def meets(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether a segment crosses a simple ring or lies in it."""
    return (F.size(_crossings(ring, x0, y0, x1, y1)) > 0) | contains(ring, x0, y0)


def inside_length(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Length of the part of a segment inside a simple ring, convex or not: it is cut where it crosses, and pieces count by their middles."""
    cuts = F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), _crossings(ring, x0, y0, x1, y1)))
    n = F.size(cuts) - 1
    pieces = F.arrays_zip(F.slice(cuts, F.lit(1), n).alias("a"), F.slice(cuts, F.lit(2), n).alias("b"))
    middle = lambda p: (p["a"] + p["b"]) / 2
    held = F.filter(pieces, lambda p: contains(ring, x0 + middle(p) * (x1 - x0), y0 + middle(p) * (y1 - y0)))
    return _sum(F.transform(held, lambda p: p["b"] - p["a"])) * F.sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2)


def point_at(line: Column, distance: Column) -> Column:
    """The point at a distance along a line, its ends beyond it."""
    n = F.size(line)
    lengths = F.transform(_steps(line), lambda p: F.sqrt((p["b"]["x"] - p["a"]["x"]) ** 2 + (p["b"]["y"] - p["a"]["y"]) ** 2))
    upto = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: _sum(F.slice(lengths, F.lit(1), k)))
    d = F.greatest(F.lit(0.0), F.least(distance, length(line)))
    k = F.greatest(F.lit(1), F.least(n - 1, F.size(F.filter(upto, lambda u: u <= d))))
    a, b = F.try_element_at(line, k), F.try_element_at(line, k + 1)
    step = F.try_element_at(lengths, k)
    t = F.when(step > 0, (d - F.try_element_at(upto, k)) / step).otherwise(0.0)
    return F.struct((a["x"] + t * (b["x"] - a["x"])).alias("x"), (a["y"] + t * (b["y"] - a["y"])).alias("y"))


# Kernels on numpy


def project(line: np.ndarray, point: tuple[float, float]) -> float:
    """Distance along a line, rows of (x, y), of the place nearest to a point."""
    a, d = line[:-1], np.diff(line, axis=0)
    step = np.hypot(d[:, 0], d[:, 1])
    t = np.clip(((point - a) * d).sum(axis=1) / np.where(step > 0, step**2, 1), 0, 1)
    near = np.hypot(*(a + t[:, None] * d - point).T)
    k = int(near.argmin())
    return float(step[:k].sum() + t[k] * step[k])


def substring(line: np.ndarray, start: float, end: float) -> np.ndarray:
    """The part of a line between two distances along it."""
    upto = np.concatenate(([0.0], np.cumsum(np.hypot(*np.diff(line, axis=0).T))))
    start, end = np.clip([start, end], 0, upto[-1])
    at = np.unique(np.concatenate(([start], upto[(upto > start) & (upto < end)], [end])))
    return np.stack([np.interp(at, upto, line[:, 0]), np.interp(at, upto, line[:, 1])], axis=1)


def merge_lines(lines: list[list[tuple[float, float]]]) -> list[list[tuple[float, float]]]:
    """Lines joined end to start wherever exactly one ends and one begins; the rest stay apart, in sorted order."""
    chains = sorted(line for line in lines if line)
    ends: dict[tuple, list[int]] = {}
    starts: dict[tuple, list[int]] = {}
    for i, line in enumerate(chains):
        starts.setdefault(line[0], []).append(i)
        ends.setdefault(line[-1], []).append(i)
    follows = {e[0]: starts[p][0] for p, e in ends.items() if len(e) == 1 and len(starts.get(p, ())) == 1 and starts[p] != e}
    led = set(follows.values())
    out, seen = [], set()
    for i in [k for k in range(len(chains)) if k not in led] + list(range(len(chains))):
        line: list = []
        while i is not None and i not in seen:
            seen.add(i)
            line += chains[i][1:] if line else chains[i]
            i = follows.get(i)
        if line:
            out.append(line)
    return out


def clip_to_convex(ring: np.ndarray, window: np.ndarray) -> np.ndarray:
    """A closed ring cut to a convex closed window of either orientation, edge by edge; rows of (x, y), not closed."""
    out, win = ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring, window
    turn = np.sign((win[:-1, 0] * win[1:, 1] - win[1:, 0] * win[:-1, 1]).sum())
    for p, q in zip(win[:-1], win[1:], strict=True):
        if not len(out):
            break
        side = turn * ((q[0] - p[0]) * (out[:, 1] - p[1]) - (q[1] - p[1]) * (out[:, 0] - p[0]))
        nxt, s_nxt = np.roll(out, -1, axis=0), np.roll(side, -1)
        kept = []
        for a, b, sa, sb in zip(out, nxt, side, s_nxt, strict=True):
            if sa >= 0:
                kept.append(a)
            if (sa > 0 > sb) or (sa < 0 < sb):
                kept.append(a + sa / (sa - sb) * (b - a))
        out = np.array(kept).reshape(-1, 2)
    return out


def clipped_area(ring: np.ndarray, window: np.ndarray) -> float:
    part = clip_to_convex(ring, window)
    x, y = part[:, 0], part[:, 1]
    return float(abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2) if len(part) > 2 else 0.0


# Well-known binary


def to_wkb(kind: str, coordinates) -> bytes:
    """Little-endian WKB of a Point (x, y), LineString, Polygon (rings), MultiLineString or MultiPolygon."""
    head = lambda n: struct.pack("<BI", 1, n)
    points = lambda ps: struct.pack("<I", len(ps)) + b"".join(struct.pack("<2d", *p[:2]) for p in ps)
    if kind == "Point":
        return head(1) + struct.pack("<2d", *coordinates[:2])
    if kind == "LineString":
        return head(2) + points(coordinates)
    if kind == "Polygon":
        return head(3) + struct.pack("<I", len(coordinates)) + b"".join(map(points, coordinates))
    if kind in ("MultiPoint", "MultiLineString", "MultiPolygon"):
        return head({"MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}[kind]) + struct.pack("<I", len(coordinates)) + b"".join(to_wkb(kind[5:], c) for c in coordinates)
    raise ValueError(f"no binary form of {kind}")


def from_wkb(data: bytes) -> tuple[str, object]:
    """(kind, coordinates) of WKB in either byte order; Z and M, in the ISO or extended form, are dropped."""
    kind, coordinates, _ = _read_wkb(bytes(data), 0)
    return kind, coordinates


def _read_wkb(data: bytes, at: int) -> tuple[str, object, int]:
    o = "<" if data[at] else ">"
    code = struct.unpack_from(f"{o}I", data, at + 1)[0]
    at += 5
    extra = bool(code & 0x80000000) + bool(code & 0x40000000)
    at += 4 * bool(code & 0x20000000)
    code &= 0xFFFF
    extra += {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000]
    dims, code = 2 + extra, code % 1000

    def point() -> tuple[float, float]:
        nonlocal at
        p = struct.unpack_from(f"{o}{dims}d", data, at)
        at += 8 * dims
        return p[:2]

    def count() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(f"{o}I", data, at - 4)[0]

    if code == 1:
        return "Point", point(), at
    if code == 2:
        return "LineString", [point() for _ in range(count())], at
    if code == 3:
        return "Polygon", [[point() for _ in range(count())] for _ in range(count())], at
    if code in (4, 5, 6):
        parts = []
        for _ in range(count()):
            _, part, at = _read_wkb(data, at)
            parts.append(part)
        return {4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}[code], parts, at
    raise ValueError(f"no geometry of code {code}")


def from_gpkg(blob: bytes) -> tuple[str, object]:
    """A GeoPackage blob: a header whose envelope length stands in its flags, then WKB."""
    if bytes(blob[:2]) != b"GP":
        raise ValueError("no GeoPackage geometry")
    return from_wkb(bytes(blob[8 + {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[blob[3] >> 1 & 7] :]))


def lines_from_wkb(df: DataFrame, column: str, out: str = "line") -> DataFrame:
    """df with the line of a LineString, or the outer ring of a Polygon, of a WKB column as an array of points; null for other kinds."""

    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = []
            for b in batch:
                kind, c = from_wkb(b) if b is not None else (None, None)
                line = c if kind == "LineString" else c[0] if kind == "Polygon" and c else None
                rows.append(None if line is None else [{"x": x, "y": y} for x, y in line])
            yield pd.Series(rows)

    return df.withColumn(out, F.pandas_udf(parse, LINE)(F.col(column)))


# Projections

#: The ellipsoid GRS 80, and by EPSG code the parallels, origin latitude and longitude, false easting and northing of Albers projections.
A, FLATTENING = 6378137.0, 1 / 298.257222101
ALBERS = {5070: (29.5, 45.5, 23.0, -96.0, 0.0, 0.0), 3338: (55.0, 65.0, 50.0, -154.0, 0.0, 0.0)}


class Albers:
    """Equal-area conic projection of an ellipsoid (Snyder 1987, pages 101 and 102), both ways, in degrees and metres."""

    def __init__(self, epsg: int):
        p1, p2, p0, self.lon0, self.x0, self.y0 = ALBERS[epsg]
        self.e = math.sqrt(FLATTENING * (2 - FLATTENING))
        m = lambda p: math.cos(p) / math.sqrt(1 - (self.e * math.sin(p)) ** 2)
        f1, f2, f0 = map(math.radians, (p1, p2, p0))
        q1, q2 = self._q(math.sin(f1)), self._q(math.sin(f2))
        self.n = (m(f1) ** 2 - m(f2) ** 2) / (q2 - q1)
        self.c = m(f1) ** 2 + self.n * q1
        self.rho0 = A * math.sqrt(self.c - self.n * self._q(math.sin(f0))) / self.n

    def _q(self, s):
        e = self.e
        return (1 - e * e) * (s / (1 - (e * s) ** 2) - np.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def forward(self, lon, lat):
        rho = A * np.sqrt(self.c - self.n * self._q(np.sin(np.radians(lat)))) / self.n
        theta = self.n * np.radians((np.asarray(lon) - self.lon0 + 180) % 360 - 180)
        return self.x0 + rho * np.sin(theta), self.y0 + self.rho0 - rho * np.cos(theta)

    def inverse(self, x, y):
        x, y = np.asarray(x, float) - self.x0, self.rho0 - (np.asarray(y, float) - self.y0)
        rho, theta = np.hypot(x, y), np.arctan2(math.copysign(1, self.n) * x, math.copysign(1, self.n) * y)
        q = (self.c - (rho * self.n / A) ** 2) / self.n
        lat, e = np.arcsin(np.clip(q / 2, -1, 1)), self.e
        for _ in range(8):
            s = np.sin(lat)
            lat = lat + (1 - (e * s) ** 2) ** 2 / (2 * np.cos(lat)) * (q / (1 - e * e) - s / (1 - (e * s) ** 2) + np.log((1 - e * s) / (1 + e * s)) / (2 * e))
        return self.lon0 + np.degrees(theta / self.n), np.degrees(lat)


def reproject(points: DataFrame, epsg: int, *, inverse: bool = False) -> DataFrame:
    """points with x, y taken from longitude and latitude to the projection, or back."""
    schema = points.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        albers = Albers(epsg)
        for batch in batches:
            x, y = (albers.inverse if inverse else albers.forward)(batch["x"].to_numpy(float), batch["y"].to_numpy(float))
            yield batch.assign(x=x, y=y)

    return points.mapInPandas(run, schema)
