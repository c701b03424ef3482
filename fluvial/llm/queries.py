"""The text operators' queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvial.llm import decontaminate, language_id, line_dedup, mixing, quality, simhash, substring_dedup, token_counts, top_k, url_filter
from fluvial.llm.common import bounded_batches, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "documents":
        bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, n_shingles, n_matched, containment of every benchmark item inside a document."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    docs = _table(spark, sf_dir, "documents")
    light = materialize(docs.select("doc_id", "source", mixing.n_words().alias("words")), "mix-sizes")
    mixed = mixing.mix_sources(light, size=F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_spans, repeated_words, removed_words of every document that holds a repeated passage."""
    return substring_dedup.repeated_documents(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page; score is the trees' probability of block."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned from the documents that aren't held out."""
    docs = _table(spark, sf_dir, "documents")
    training = language_id.is_training()
    model = language_id.fit(docs.where(training))
    found = language_id.identify(docs.select("doc_id", "text", (~training).alias("held_out")), model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, line_no, group_doc_id, group_line_no, kept of every occurrence of a repeated line."""
    return line_dedup.repeated_lines(_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, expected_grade (0 toxic, 1 poor, 2 good), p_not_toxic, p_good, keep of every document."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.graded(_table(spark, sf_dir, "labels")))
    scored = quality.score(docs, model)
    return scored.select("doc_id", "expected_grade", F.element_at("tails", 1).alias("p_not_toxic"), F.element_at("tails", 2).alias("p_good"), quality.selected().alias("keep"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the five best other vectors of every vector whose id is divisible by 50."""
    return top_k.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_mix_sources, op3_substring_dedup, op4_url_filter, op5_language_id, op6_line_dedup, op7_quality_classifier, op8_exact_top_k, op9_token_counts, op10_simhash_near_dedup)}
ORACLES = {"op1_decontaminate": decontaminate.ORACLE, "op2_mix_sources": mixing.ORACLE, "op8_exact_top_k": top_k.ORACLE}
