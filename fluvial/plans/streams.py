"""Queries of the streaming extensions, run over the whole events table as a batch; the tests run them as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvial.plans.register import Register
from fluvial.session import table
from fluvial.streaming import upserts

register = Register()


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@register("event_windows", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = upserts.event_windows(_events(spark, sf_dir))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@register(
    "user_sessions",
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM e)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, s""",
)
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = upserts.sessions(_events(spark, sf_dir))
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")
