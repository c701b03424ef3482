"""What the text operators leave on disk while their results are in use."""

from __future__ import annotations

import os
import random
import time

import pytest

from fluvial.checkpoint import materialize, settled, shared_root
from fluvial.llm import line_dedup, simhash


def tables(spark):
    return set(os.listdir(shared_root(spark).removeprefix("file://")))


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    lines = [" ".join(rnd.choice(words) for _ in range(12)) for _ in range(60)]
    texts = ["\n".join(rnd.sample(lines, 4)) for _ in range(80)]
    return materialize(spark.createDataFrame([(i, t + " and so on" * (i % 2)) for i, t in enumerate(texts + texts)], "doc_id long, text string"), "docs")


@pytest.mark.parametrize("stage", [line_dedup.dedup_lines, simhash.keep_one])
def test_a_stage_leaves_one_small_table(spark, docs, stage):
    before = tables(spark)
    out = stage(docs)
    assert len(tables(spark) - before) == 1
    assert 0 < out.count() <= docs.count()


def test_shuffle_files_go_with_the_table_that_needed_them(spark, docs):
    before = shuffle_files(spark)
    settled(lambda: materialize(docs.repartition(4, "doc_id"), "dealt").repartition(4, "text"), "texts")
    deadline = time.time() + 20
    while shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_texts_are_not_dealt_out_to_drop_a_few_copies(spark):
    """Many documents, few copies: the ids that stay are too many to be sent to every task, those that go are not."""
    n = 30_000
    rows = spark.range(n).selectExpr("id AS doc_id", "concat_ws(' ', id, id * 7, id * 11, id * 13, id * 17, id * 19) AS text")
    docs = materialize(rows.unionAll(rows.where("doc_id < 3").selectExpr(f"doc_id + {n}", "text")), "many")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        out = simhash.keep_one(docs)
        assert out.count() == n
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan
