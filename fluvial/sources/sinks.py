"""Writers: one Parquet folder for each layer, replaced as a whole; CSV by hour; small JSON reports."""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_layers(layers: dict[str, DataFrame], folder: str) -> None:
    """Each layer to folder/name; an empty layer keeps its schema."""
    for name, df in layers.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def replace_layer(df: DataFrame, path: str) -> None:
    """Replace the table at path, from which df may itself be read: a new folder is written first and then takes its place."""
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}.new"
    df.write.mode("overwrite").parquet(fresh)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop(path), True)
    if not fs.rename(hadoop(fresh), hadoop(path)):
        raise OSError(f"could not move {fresh} to {path}")


def ids_as_doubles(df: DataFrame) -> DataFrame:
    """Whole-number columns with id in their name as doubles, for stores without nullable integers; text ones stay."""
    whole = ("tinyint", "smallint", "int", "bigint")
    return df.select(*(F.col(f"`{c}`").cast("double").alias(c) if t in whole and "id" in c.lower() else F.col(f"`{c}`") for c, t in df.dtypes))


def write_partitioned(df: DataFrame, path: str, by: str = "vpu_id") -> None:
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_hourly_csv(flows: DataFrame, path: str) -> None:
    """flows(key, hour, q) as CSV in one folder for each hour, hour=YYYYmmddHHMM."""
    flows.withColumn("hour", F.date_format("hour", "yyyyMMddHHmm")).write.mode("overwrite").partitionBy("hour").option("header", True).csv(path)


def write_report(report: dict[str, DataFrame], path: str, most_rows: int = 10_000) -> None:
    """Small tables as one JSON file with indent 4; a report of more than most_rows rows is an error."""
    out = {}
    for name, df in report.items():
        rows = df.limit(most_rows + 1).collect()
        if len(rows) > most_rows:
            raise ValueError(f"{name} is no report: it has over {most_rows} rows")
        out[name] = [r.asDict(recursive=True) for r in rows]
    with open(path, "w") as f:
        json.dump(out, f, indent=4, default=str)


def write_sqlite_table(df: DataFrame, path: str, name: str) -> None:
    """Replace one table of an SQLite file on the driver, streamed partition by partition."""
    kinds = {"tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER", "double": "REAL", "float": "REAL", "boolean": "INTEGER", "binary": "BLOB"}
    quoted = [f'"{c}" {kinds.get(t, "TEXT")}' for c, t in df.dtypes]
    rows: Iterator = (tuple(r) for r in df.toLocalIterator())
    with sqlite3.connect(path) as con:
        con.execute(f'DROP TABLE IF EXISTS "{name}"')
        con.execute(f'CREATE TABLE "{name}" ({", ".join(quoted)})')
        con.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * len(df.columns))})', rows)
