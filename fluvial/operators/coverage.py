"""From shapes to cells: which share of each cell a polygon covers, and the values of cells under points and line ends.

Cells are squares of a given size, named by row and col, the floor of y and x over the size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvial.functions import geometry


def cell_weights(polygons: DataFrame, size: float) -> DataFrame:
    """zone, row, col, weight (covered share of the cell, over 0) of polygons(id, ring); a ring may be of any simple shape.

    Each polygon is spread over the rows of cells that it reaches and cut there once, each strip then at its cells, so a large polygon is many
    tasks' work. Null rings and rings of fewer than three points cover nothing; shapes that share an id add up.
    """
    box = geometry.envelope(F.col("ring"))
    cell = lambda v: F.floor(v / size).cast("long")
    rows = polygons.where("size(ring) > 2").select("id", "ring", box.alias("e"))
    rows = rows.withColumn("row", F.explode(F.sequence(cell(F.col("e.y0")), cell(F.col("e.y1"))))).select(F.col("id").alias("zone"), "row", "ring")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            zone, row, col, weight = [], [], [], []
            for z, r, ring in zip(p["zone"], p["row"], p["ring"], strict=True):
                xy = np.array([(q["x"], q["y"]) for q in ring], float)
                low, high = r * size, (r + 1) * size
                x0, x1 = xy[:, 0].min(), xy[:, 0].max()
                window = lambda a, b, low=low, high=high: np.array([(a, low), (b, low), (b, high), (a, high), (a, low)], float)
                strip = geometry.clip_to_convex(xy, window(x0 - size, x1 + size))
                if len(strip) < 3:
                    continue
                for c in range(int(np.floor(strip[:, 0].min() / size)), int(np.floor(strip[:, 0].max() / size)) + 1):
                    share = geometry.clipped_area(strip, window(c * size, (c + 1) * size)) / size**2
                    if share > 1e-12:
                        zone.append(z)
                        row.append(r)
                        col.append(c)
                        weight.append(share)
            yield pd.DataFrame({"zone": pd.Series(zone, dtype=p["zone"].dtype), "row": np.array(row, np.int64), "col": np.array(col, np.int64), "weight": np.array(weight, float)})

    parts = rows.mapInPandas(cut, f"zone {dict(rows.dtypes)['zone']}, row long, col long, weight double")
    return parts.groupBy("zone", "row", "col").agg(F.sum("weight").alias("weight"))


def zonal_cells(polygons: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """zone, value, weight for the statistics of `zonal`: the cells(row, col, value) under each of polygons(id, ring)."""
    return cell_weights(polygons, size).join(cells, ["row", "col"]).select("zone", "value", "weight")


def cell_values(points: DataFrame, cells: DataFrame, size: float, nodata: float | None = None) -> DataFrame:
    """points(x, y, ...) with value, that of the cell of cells(row, col, value) that a point lies in; null outside and where the cell has no data."""
    at = lambda c: F.floor(F.col(c) / size).cast("long")
    known = cells.select(F.col("row").alias("c_row"), F.col("col").alias("c_col"), "value")
    if nodata is not None:
        known = known.withColumn("value", F.when(F.col("value") != nodata, F.col("value")))
    return points.join(known, (at("y") == F.col("c_row")) & (at("x") == F.col("c_col")), "left").drop("c_row", "c_col")


def end_values(lines: DataFrame, cells: DataFrame, size: float, nodata: float | None = None) -> DataFrame:
    """id, value: the mean over the ends of all parts of lines(id, line) of the cells' values that there are; null without any."""
    ends = lines.where("size(line) > 0").select("id", F.explode(F.array(F.element_at("line", 1), F.element_at("line", -1))).alias("p")).select("id", "p.x", "p.y")
    found = cell_values(ends, cells, size, nodata).groupBy("id").agg(F.avg("value").alias("value"))
    return lines.select("id").distinct().join(found, "id", "left")
