"""Texts stay where they are: rows chosen by number or hash, and shuffle files that go when a table is written."""

import time

import corpus_pipeline
from pyspark.sql import functions as F

from grovespark.llm.common import Workspace


def plans(spark, stage, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return stage(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stages_of_the_pipeline_pick_rows_without_a_shuffle_of_texts(spark):
    docs = spark.createDataFrame([(i, f"a b c d e f{i} g{i} h{i}", "en", "a0", 20) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.mix_sources):
        plan = plans(spark, stage, docs)
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_only_is_a_semi_join(spark):
    work, keys = Workspace(spark, "only"), [0, 1, 63, 64, 65, 127, (1 << 33) - 1, 1 << 33, (5 << 33) + 62, -1, -64, -65, None]
    docs = spark.createDataFrame([(k, f"t{k}") for k in keys for _ in range(2)], "row long, `te.xt` string")
    for some in ([], keys, keys[::2] * 2, keys[1::3]):
        rows = spark.createDataFrame([(k,) for k in some], "row long")
        for most in (0, 100):
            got = work.only(docs, rows, "row", most)
            assert got.columns == docs.columns
            assert sorted(map(tuple, got.collect())) == sorted((k, f"t{k}") for k in {*some} - {None} for _ in range(2))


def test_shuffle_files_go_when_a_table_is_written(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager
    shuffled = lambda: {x for x in files().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}
    for _ in range(3):
        before = shuffled()
        out = Workspace(spark, "shuffle").save(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "counts")
        end = time.time() + 5
        while shuffled() - before and time.time() < end:
            time.sleep(0.1)
        assert not shuffled() - before
        assert out.count() == 10
