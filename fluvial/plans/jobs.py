"""Jobs: named tasks that pass tables on, each written before the next reads it, so that a job that stopped goes on from what is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvial.operators import build, graph, simplify, validate

Task = Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]


class Job:
    """Runs tasks in order over a folder of layers; a task whose layers are all there is not run again unless asked."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.tables = spark, folder.rstrip("/"), {}

    def _there(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def run(self, task: Task, makes: list[str], again: bool = False) -> Job:
        if again or not all(map(self._there, makes)):
            made = task(self.spark, self.tables)
            if set(made) != set(makes):
                raise ValueError(f"{task.__name__} made {sorted(made)}, not {sorted(makes)}")
            for name, df in made.items():
                df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        self.tables |= {name: self.spark.read.parquet(f"{self.folder}/{name}") for name in makes}
        return self


def base_network(reaches: DataFrame) -> list[tuple[Task, list[str]]]:
    """The tasks from reaches(id, down, hydroseq, length_m, area_m2, has_divide) to flowpaths, nexuses and traced attributes."""

    def trace(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        jumps = graph.jump_tables(reaches)
        order = graph.stream_order(reaches, jumps)
        area = graph.upstream_sums(reaches.select("id", (F.col("area_m2") / 1e6).alias("total_da_sqkm")), ["total_da_sqkm"], jumps)
        walked = graph.to_outlet(reaches, F.col("length_m") / 1000).withColumnRenamed("path", "path_length")
        return {"traced": walked.join(order, "id").join(area, "id")}

    def units(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        rows = reaches.join(t["traced"].select("id", "outlet_id", "stream_order"), "id")
        rows = rows.select("outlet_id", "id", "down", "stream_order", (F.col("area_m2") / 1e6).alias("area"), (F.col("length_m") / 1000).alias("length"), "has_divide")
        classes = simplify.classify(rows)
        return {"classes": classes, "units": simplify.units(classes).select("outlet_id", F.col("unit").cast("long").alias("unit"), F.col("ref_id").cast("long").alias("ref_id"), "type")}

    def network(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        paths = build.flowpaths(t["units"], reaches)
        return {"flowpaths": paths, "nexus": build.nexuses(paths)}

    def check(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        links = t["flowpaths"].select(F.col("fp_id").alias("id"), F.col("fp_to_id").alias("down"))
        cyclic = graph.cyclic(links).agg(F.lit("cyclic").alias("check_name"), F.count("*").alias("n"))
        broken = validate.violations(t["flowpaths"], "fp_id", {"length_km": (0.0, None, True), "area_sqkm": (0.0, None, False)}).agg(F.lit("out of range").alias("check_name"), F.count("*").alias("n"))
        return {"report": cyclic.unionByName(broken)}

    return [(trace, ["traced"]), (units, ["classes", "units"]), (network, ["flowpaths", "nexus"]), (check, ["report"])]
