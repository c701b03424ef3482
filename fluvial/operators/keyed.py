"""Keyed relational operators: one row for each key, upserts, overrides, remaps, priority merges and running ids.

Choices of one row are aggregates of structs, which combine before the shuffle, so a frequent key is no hot spot; every choice has a total
order. Null keys form a group of their own where a choice is made, and match nothing in joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvial.checkpoint import materialize


def arg_max(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The row of each key that is greatest by the order; give ties as further, negated or not, columns."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).alias("best"))
    return best.select(*keys, *(F.col(f"best.{c}").alias(c) for c in rest))


def arg_min(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The row of each key that is least by the order; a null orders first, so filter or coalesce before."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).alias("best"))
    return best.select(*keys, *(F.col(f"best.{c}").alias(c) for c in rest))


def upsert(master: DataFrame, incoming: DataFrame, key: str, *, update: list[str], update_existing: bool = True, fill: str = "-") -> DataFrame:
    """master with incoming rows merged by key: known keys take the update columns, unknown ones are appended.

    An appended row has the incoming columns and, in the master's other text columns, the fill; other types stay null.
    """
    new = incoming.select(F.col(key).alias("in_key"), *(F.col(c).alias(f"in_{c}") for c in incoming.columns if c != key))
    known = master.join(new.select("in_key", *(f"in_{c}" for c in update)), master[key] == F.col("in_key"), "left")
    changed = {c: F.when(F.col("in_key").isNotNull(), F.col(f"in_{c}")).otherwise(F.col(c)) for c in update} if update_existing else {}
    kept = known.select(*(changed.get(c, F.col(c)).alias(c) for c in master.columns))
    fresh = incoming.join(master.select(F.col(key).alias("m_key")), incoming[key] == F.col("m_key"), "left_anti")
    types = dict(master.dtypes)
    absent = {c: F.lit(fill) if types[c] == "string" else F.lit(None).cast(types[c]) for c in master.columns if c not in incoming.columns}
    return kept.unionByName(fresh.select(*(absent.get(c, F.col(c) if c in incoming.columns else None).alias(c) for c in master.columns)))


def override(df: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """df with the columns of changes put in place where its key matches; changes has one row for each key."""
    new = changes.select(F.col(key).alias("ch_key"), *(F.col(c).alias(f"ch_{c}") for c in columns))
    joined = df.join(new, df[key] == F.col("ch_key"), "left")
    return joined.select(*((F.when(F.col("ch_key").isNotNull(), F.col(f"ch_{c}")).otherwise(F.col(c)).alias(c)) if c in columns else F.col(c) for c in df.columns))


def fill_missing(df: DataFrame, other: DataFrame, key: str, column: str, label: str, source: str = "source") -> DataFrame:
    """df with nulls of column filled from other by key; source says label on the filled rows and keeps its value on the rest."""
    new = other.select(F.col(key).alias("o_key"), F.col(column).alias("o_value"))
    joined = df.join(new, df[key] == F.col("o_key"), "left")
    filled = F.col(column).isNull() & F.col("o_value").isNotNull()
    out = {column: F.coalesce(column, "o_value"), source: F.when(filled, F.lit(label)).otherwise(F.col(source) if source in df.columns else F.lit(None).cast("string"))}
    names = df.columns + ([] if source in df.columns else [source])
    return joined.select(*(out.get(c, F.col(c) if c in df.columns else None).alias(c) for c in names))


def remap(df: DataFrame, mapping: DataFrame, columns: list[str], old: str = "old_id", new: str = "new_id") -> DataFrame:
    """df with ids replaced through mapping in each column; null stays null, an id without a mapping is an error."""
    for c in columns:
        m = mapping.select(F.col(old).alias("rm_old"), F.col(new).alias("rm_new"))
        joined = df.join(m, df[c] == F.col("rm_old"), "left")
        missing = F.col(c).isNotNull() & F.col("rm_old").isNull()
        checked = F.when(missing, F.raise_error(F.concat(F.lit(f"no new id for {c} "), F.col(c).cast("string")))).otherwise(F.col("rm_new"))
        df = joined.select(*((checked.alias(c)) if x == c else F.col(x) for x in df.columns))
    return df


def without_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """Only the rows whose keys occur once: all copies of a repeated key go."""
    single = df.groupBy(*keys).count().where("count = 1").select(*(F.col(k).alias(f"s_{k}") for k in keys))
    return df.join(single, reduce(lambda a, b: a & b, (df[k].eqNullSafe(F.col(f"s_{k}")) for k in keys)), "left_semi")


def anti_any(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of df of which no key occurs in known; a null key matches nothing."""
    for k in keys:
        df = df.join(known.select(F.col(k).alias("k_known")), df[k] == F.col("k_known"), "left_anti")
    return df


def anti_any_as_text(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """As anti_any, but keys are compared as text and missing ones as the text None, which match each other."""
    text = lambda d, k: F.coalesce(d[k].cast("string"), F.lit("None"))
    for k in keys:
        df = df.join(known.select(text(known, k).alias("k_known")), text(df, k) == F.col("k_known"), "left_anti")
    return df


def append_sources(master: DataFrame, *sources: DataFrame) -> DataFrame:
    """Union of all rows, by name; columns that a source lacks are null. Keys aren't made unique."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources, master)


def running_ids(tables: list[DataFrame], order: list[str], name: str = "hy_id", first: int = 1) -> DataFrame:
    """The tables one after the other with one running id, in each table by the order.

    The rows are sorted by ranges and written; each range's rows are numbered by themselves and start where the ranges before them end.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("table_rank", F.lit(i)) for i, t in enumerate(tables)])
    spark = stacked.sparkSession
    ranged = stacked.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "table_rank", *order).withColumn("range_no", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    counts = ranged.groupBy("range_no").count()
    before = F.coalesce(F.sum("count").over(W.orderBy("range_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    within = F.row_number().over(W.partitionBy("range_no").orderBy("table_rank", *order))
    out = ranged.withColumn("range_row", within).join(F.broadcast(counts.select("range_no", before.alias("range_start"))), "range_no")
    return out.withColumn(name, (F.col("range_start") + F.col("range_row") + (first - 1)).cast("long")).drop("table_rank", "range_no", "range_row", "range_start")


def missing_keys(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Distinct keys of wanted that present lacks."""
    return wanted.select(key).where(F.col(key).isNotNull()).distinct().join(present.select(F.col(key).alias("p_key")), F.col(key) == F.col("p_key"), "left_anti")


def complete(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df projected to the columns in order, with those that it lacks as typed nulls."""
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, if it has all the columns; else an error that names those it lacks."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return df
