"""Intermediate tables of iterative plans: written to the folder that the session shares, never kept on one executor."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
#: With this on, Spark removes a query's shuffle files when the query ends; else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir as the session has it; where it is unset, a new one, but only if all run on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="fluvial-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: later stages restart from those files when executors are lost.

    The files go when the driver's Python ends. The shuffle files of the write go at once: nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/fluvial-{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    if not _written:
        atexit.register(_drop_written)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """make()'s result, materialized; the tables that were materialized on the way to it go at once."""
    n = len(_written)
    out = materialize(make(), label)
    passing = _written[n:-1]
    del _written[n:-1]
    for spark, path in passing:
        _drop(spark, path)
    return out


def _drop(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _drop_written() -> None:
    for spark, path in _written:
        try:
            _drop(spark, path)
        except Exception:  # the session has ended already  # noqa: BLE001
            return
