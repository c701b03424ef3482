"""Structured Streaming extensions: gage upserts batch by batch, and event-time windows with late data. The batch operators do the work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fluvial.operators import keyed


def upsert_stream(incoming: DataFrame, path: str, checkpoint: str, key: str, update: list[str]) -> StreamingQuery:
    """Merge each micro-batch of incoming into the Parquet table at path; of several rows of a key in a batch the last by `seq` counts.

    Versions are folders path/v=<batch id>: a batch that is run again writes the same folder from the same predecessor, so each has its effect once.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = keyed.arg_max(batch, [key], F.col("seq")).drop("seq")
        master = spark.read.parquet(f"{path}/v={batch_id - 1}")
        keyed.upsert(master, newest, key, update=update).write.mode("overwrite").parquet(f"{path}/v={batch_id}")

    return incoming.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, *, late: str = "10 minutes", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """start, event_type, n, total of events(ts, event_type, value) by event-time windows; what is later than the watermark is left out of streams."""
    when = F.window("ts", width, slide or width)
    out = events.withWatermark("ts", late).groupBy(when.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, *, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """user_id, start, end, n of events(ts, user_id): runs of a user's events with no gap between them."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")
