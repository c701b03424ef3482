"""Validation reports: nulls, ranges and completeness, as small tables of counts or the offending rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_null of each column, from one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], columns, "column", "n_null")


def null_counts_by(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """by, column, n_null where there are any."""
    counts = df.groupBy(by).agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([by], columns, "column", "n_null").where("n_null > 0")


def rows_with_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns)))


def violations(df: DataFrame, key: str, rules: dict[str, tuple[float | None, float | None, bool]]) -> DataFrame:
    """key, field, rule, value for each value outside its rule (least, greatest, whether the least itself is out) or null."""
    checks = []
    for field, (low, high, open_low) in rules.items():
        value = F.col(field).cast("double")
        broken = F.when(value.isNull() | F.isnan(value), "missing")
        if low is not None:
            broken = broken.when(value <= low if open_low else value < low, "too small")
        if high is not None:
            broken = broken.when(value > high, "too large")
        checks.append(F.struct(F.lit(field).alias("field"), broken.alias("rule"), value.alias("value")))
    found = df.select(F.col(key), F.explode(F.filter(F.array(*checks), lambda c: c["rule"].isNotNull())).alias("c"))
    return found.select(key, "c.field", "c.rule", "c.value")


def presence(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """n_wanted, n_missing, percent_missing of the distinct keys of wanted."""
    w = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    p = present.select(F.col(key).alias("p_key"), F.lit(1).alias("there")).distinct()
    joined = w.join(p, F.col(key) == F.col("p_key"), "left")
    return joined.agg(F.count("*").alias("n_wanted"), F.count_if(F.col("there").isNull()).alias("n_missing")).withColumn("percent_missing", 100 * F.col("n_missing") / F.greatest("n_wanted", F.lit(1)))


def assert_complete(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """present, or an error that counts the keys of wanted that it lacks; null keys aren't asked for."""
    lacking = wanted.select(key).where(F.col(key).isNotNull()).join(present.select(F.col(key).alias("p_key")), F.col(key).cast("string") == F.col("p_key").cast("string"), "left_anti").count()
    if lacking:
        raise ValueError(f"{lacking} keys of {key} are missing")
    return present
