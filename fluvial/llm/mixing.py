"""Mixing sources to target weights by systematic sampling, with DataFrame functions alone.

Sources share a total of words by weight; no target exceeds `cap` times its source's size, and what is cut off is shared
anew by weight among the others until none is above. Within a source every document has the same expected number of
copies, target / source size. The documents are laid out in a fixed order, one random offset is added to the prefix sum
of expected copies, and a document is emitted once for each integer that its step crosses: floor or ceil of the
expectation. The order goes by classes of size (four leading bits), so that the words taken follow the target, not just
the documents; inside a class it goes by a digest of the id.

The prefix sum is made in three levels (classes of a source, 256 digest prefixes of a class, documents of a prefix), so
that a source with most of the rows is spread over many tasks and no window sees more than a small share of it.

Null texts have size 0; a null source is a source of its own and the last in order; null ids come first in their class.
Rows that repeat are each sampled. A source without words has target 0. An empty table gives an empty result. Extra
columns are carried; where one has the name of a result column the result's stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvial.llm.common import materialize, with_columns

WORD = r"[^\x20\x09-\x0D]+"
#: Sources by code point take these weights in turn.
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"
#: The random offset is a multiple of 2 ** -20: sums stay exact where the expectation is a whole number.
OFFSET_DIGITS = 5


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """sizes(src_null, src, source_size), a row for each source, with target added.

    Sources ordered by cap / weight fill up one after the other as the common level rises. The level that uses up the
    total is (total - caps before) / (weights from here on) at the first source that it does not fill; for those that follow
    this quotient only falls, so the level is its maximum over the sources that it does not fill.
    """
    n = F.row_number().over(W.orderBy("src_null", "src")) - 1
    by_weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (n % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", by_weight).withColumn("most", cap * F.col("source_size").cast("double"))
    rising = W.orderBy(F.col("most") / F.col("weight"), "src_null", "src")
    s = s.withColumns(
        {
            "total": F.sum("source_size").over(W.partitionBy()).cast("double"),
            "before": F.coalesce(F.sum("most").over(rising.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
            "open": F.sum("weight").over(rising.rowsBetween(0, W.unboundedFollowing)),
        }
    ).withColumn("level", (F.col("total") - F.col("before")) / F.col("open"))
    first = F.max(F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))).over(W.partitionBy())
    return s.withColumn("target", F.least("most", first * F.col("weight"))).select("src_null", "src", "source_size", "target")


def mix_sources(docs: DataFrame, *, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """docs(doc_id, text, source, ...) with size, source_size, target and copies (0 to cap) added; `size` may replace the count of words."""
    size = n_words() if size is None else size
    bits = F.bin("mx_size")
    rows = (
        docs.select(F.struct("*").alias("mx_row"), F.col("doc_id").alias("mx_id"), F.col("source").alias("mx_source"), size.alias("mx_size"))
        .withColumn("mx_digest", F.md5(F.coalesce(F.col("mx_id").cast("string"), F.lit(""))))
        .select(
            "mx_row", "mx_id", "mx_size", "mx_digest",
            F.col("mx_source").isNull().alias("src_null"), F.coalesce("mx_source", F.lit("")).alias("src"),
            F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 4)).alias("class"),
            F.substring("mx_digest", 1, 2).alias("prefix"),
        )
    )
    source, in_class, in_prefix = ["src_null", "src"], ["src_null", "src", "class"], ["src_null", "src", "class", "prefix"]
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    prefixes = materialize(rows.groupBy(*in_prefix).agg(F.count("*").alias("n"), F.sum("mx_size").alias("words")), "mix-prefixes")
    classes = prefixes.groupBy(*in_class).agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    classes = materialize(classes.withColumn("class_start", F.coalesce(F.sum("n").over(before(W.partitionBy(*source).orderBy("class"))), F.lit(0))), "mix-classes")
    per_source = targets(classes.groupBy(*source).agg(F.sum("words").alias("source_size")), weights, cap)
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.when(F.col("src_null"), "-").otherwise("+"), "src")), 1, OFFSET_DIGITS)
    per_source = per_source.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    per_source = per_source.withColumn("offset", F.conv(digits, 16, 10).cast("double") / float(16**OFFSET_DIGITS))
    starts = (
        prefixes.withColumn("prefix_start", F.coalesce(F.sum("n").over(before(W.partitionBy(*in_class).orderBy("prefix"))), F.lit(0)))
        .join(classes.select(*in_class, "class_start"), in_class)
        .join(per_source, source)
        .select(*in_prefix, (F.col("class_start") + F.col("prefix_start")).alias("start"), "source_size", "target", "rate", "offset")
    )
    starts = materialize(starts, "mix-starts")
    place = F.row_number().over(W.partitionBy(*in_prefix).orderBy("mx_digest", "mx_id", "mx_size"))
    laid = rows.withColumn("place", place).join(starts, in_prefix)
    upto = lambda n: F.floor(F.col("offset") + F.col("rate") * n.cast("double"))
    n = F.col("start") + F.col("place")
    copies = F.least(upto(n) - upto(n - 1), F.lit(cap)).cast("long")
    added = {"size": "mx_size", "source_size": "source_size", "target": "target"}
    laid = laid.select("mx_row", *(F.col(v).alias(f"mx_{k}") for k, v in added.items()), copies.alias("mx_copies"))
    out = laid.select("mx_row.*", *(F.col(f"mx_{k}") for k in (*added, "copies")))
    out = with_columns(out, **{k: F.col(f"mx_{k}") for k in (*added, "copies")})
    return out.drop(*(f"mx_{k}" for k in (*added, "copies")))


def emitted(mixed: DataFrame) -> DataFrame:
    """Each row of a mix as often as its copies say, numbered from 1 in copy_no."""
    return mixed.where("copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))


#: The same in DuckDB's SQL.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         source IS NULL AS src_null, coalesce(source, '') AS src, md5(coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
s0 AS (SELECT src_null, src, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
s1 AS (SELECT *, ([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[((row_number() OVER (ORDER BY src_null, src) - 1) % 3 + 1)::INT] AS weight,
              3 * source_size::DOUBLE AS most, (sum(source_size) OVER ())::DOUBLE AS total FROM s0),
s2 AS (SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, src_null, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before,
              sum(weight) OVER (ORDER BY most / weight, src_null, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM s1),
s3 AS (SELECT *, (total - before) / open AS level FROM s2),
s4 AS (SELECT *, max(CASE WHEN level <= most / weight THEN level END) OVER () AS first FROM s3),
s5 AS (SELECT src_null, src, source_size, least(most, first * weight) AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
              ('0x' || substr(md5('mix|' || CASE WHEN src_null THEN '-' ELSE '+' END || src), 1, 5))::BIGINT / 1048576.0::DOUBLE AS off FROM s5),
n AS (SELECT d.*, row_number() OVER (PARTITION BY src_null, src
        ORDER BY lpad(length(bin(size))::VARCHAR, 2, '0') || substr(bin(size), 1, 4), substr(digest, 1, 2), digest, doc_id NULLS FIRST, size) AS n FROM d)
SELECT doc_id, size, source_size, target,
       least(floor(off + rate * n::DOUBLE) - floor(off + rate * (n - 1)::DOUBLE), 3)::BIGINT * size AS taken
FROM n JOIN s6 USING (src_null, src)
"""
