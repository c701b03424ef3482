"""Coverage-weighted statistics of cells by zone, and cell-table forms of raster operators.

Cells are rows (zone, value, weight), the weight being the covered share of the cell. Cells without a value, or of weight 0 or
less, take no part; a zone with none left has no row. All but the quantiles are aggregates that combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUARTILES, DECILES = (0.25, 0.5, 0.75, 1.0), tuple(i / 10 for i in range(1, 11))


def touched(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")) & (F.col("weight") > 0))


def mean() -> Column:
    return F.sum(F.col("weight") * F.col("value")) / F.sum("weight")


def circular_mean() -> Column:
    """Weighted mean direction in degrees, 0 to 360."""
    radians = F.radians("value")
    angle = F.degrees(F.atan2(F.sum(F.col("weight") * F.sin(radians)), F.sum(F.col("weight") * F.cos(radians))))
    return F.pmod(angle, F.lit(360.0))


def geometric_mean() -> Column:
    return F.exp(F.sum(F.col("weight") * F.ln("value")) / F.sum("weight"))


def statistics(cells: DataFrame, **stats: Column) -> DataFrame:
    """zone with each of the named statistics, all in one aggregation."""
    return touched(cells).groupBy("zone").agg(*(c.alias(k) for k, c in stats.items()))


def mode(cells: DataFrame) -> DataFrame:
    """zone, value of greatest total weight; the smaller value on ties."""
    by_value = touched(cells).groupBy("zone", "value").agg(F.sum("weight").alias("weight"))
    return by_value.groupBy("zone").agg(F.max_by("value", F.struct("weight", -F.col("value"))).alias("value"))


def quantiles(cells: DataFrame, levels: tuple[float, ...] = QUARTILES, prefix: str = "q") -> DataFrame:
    """zone, q25, q50, ...: the least value at which the share of the zone's weight up to it reaches the level.

    Weights of equal values are summed first, so what a zone's window sorts is its distinct values.
    """
    by_value = touched(cells).groupBy("zone", "value").agg(F.sum("weight").alias("weight"))
    total = by_value.groupBy("zone").agg(F.sum("weight").alias("total"))
    running = F.sum("weight").over(W.partitionBy("zone").orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    shared = by_value.withColumn("running", running).join(total, "zone").withColumn("share", F.col("running") / F.col("total"))
    return shared.groupBy("zone").agg(*(F.min(F.when(F.col("share") >= q - 1e-9, F.col("value"))).alias(f"{prefix}{round(100 * q)}") for q in levels))


def block_percent(cells: DataFrame, block: int, is_one: Column) -> DataFrame:
    """block_row, block_col, percent of the cells(row, col) of each block for which is_one holds."""
    at = lambda c: F.floor(F.col(c) / block).cast("long")
    return cells.groupBy(at("row").alias("block_row"), at("col").alias("block_col")).agg((F.avg(is_one.cast("double")) * 100).alias("percent"))


def burn(rows: DataFrame) -> DataFrame:
    """row, col, value of rows(row, col, value, weight): the value of greatest weight of each cell, then the smaller value."""
    return rows.groupBy("row", "col").agg(F.max_by("value", F.struct("weight", -F.col("value"))).alias("value"))


def mosaic(primary: DataFrame, secondary: DataFrame, keys: list[str], column: str = "value") -> DataFrame:
    """Cells of both, the primary's value where it has one."""
    second = secondary.select(*keys, F.col(column).alias("second"))
    return primary.join(second, keys, "full").select(*keys, F.coalesce(column, "second").alias(column))


def mask_values(cells: DataFrame, *nodata: float, column: str = "value") -> DataFrame:
    """cells with the no-data values as null."""
    return cells.withColumn(column, F.when(F.col(column).isin(*nodata), None).otherwise(F.col(column)))


def regrid(cells: DataFrame, from_size: float, to_size: float) -> DataFrame:
    """Cells of a grid of to_size that take the value of the cell of from_size under their centre."""
    factor = to_size / from_size
    target = cells.select(F.floor(F.col("row") / factor).cast("long").alias("row"), F.floor(F.col("col") / factor).cast("long").alias("col")).distinct()
    under = lambda c: F.floor((F.col(c) + 0.5) * factor).cast("long")
    source = cells.select(F.col("row").alias("s_row"), F.col("col").alias("s_col"), "value")
    keyed = target.withColumn("s_row", under("row")).withColumn("s_col", under("col"))
    return keyed.join(source, ["s_row", "s_col"]).select("row", "col", "value")


def slope_and_aspect(cells: DataFrame, size: float) -> DataFrame:
    """row, col, slope and aspect (degrees) by Horn's 3 x 3 weights, for cells that have all eight neighbours; rows run south.

    Each cell is sent to its neighbours by an explode and one aggregation, so tiles need no borders.
    """
    steps = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (-1, 0, 1) for c in (-1, 0, 1)))
    sent = cells.withColumn("s", F.explode(steps)).select((F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col"), "s", "value")
    sent = sent.select("row", "col", (-F.col("s.r")).alias("dr"), (-F.col("s.c")).alias("dc"), "value")
    heavy = lambda other: F.when(F.col(other) == 0, 2).otherwise(1)
    sums = sent.groupBy("row", "col").agg(
        F.count("value").alias("n"),
        (F.sum(F.col("dc") * heavy("dr") * F.col("value")) / (8 * size)).alias("dx"),
        (F.sum(F.col("dr") * heavy("dc") * F.col("value")) / (8 * size)).alias("dy"),
    )
    slope = F.degrees(F.atan(F.sqrt(F.col("dx") ** 2 + F.col("dy") ** 2)))
    aspect = F.pmod(90 - F.degrees(F.atan2(F.col("dy"), -F.col("dx"))), F.lit(360.0))
    return sums.where("n = 9").select("row", "col", slope.alias("slope"), aspect.alias("aspect"))


def month_delta(cells: DataFrame) -> DataFrame:
    """cell, delta of cells(cell, month, value): the range over months of the mean over years."""
    means = cells.where("value IS NOT NULL").groupBy("cell", "month").agg(F.avg("value").alias("mean"))
    return means.groupBy("cell").agg(F.abs(F.max("mean") - F.min("mean")).alias("delta"))


def bounds(points: DataFrame, margin: float = 0.0) -> DataFrame:
    return points.agg((F.min("x") - margin).alias("min_x"), (F.min("y") - margin).alias("min_y"), (F.max("x") + margin).alias("max_x"), (F.max("y") + margin).alias("max_y"))
