"""The sample that toxicity is fitted on: texts are not shuffled for it."""

import functools
import time

import numpy as np

from grovespark.llm import toxicity


def test_fitting_shuffles_hashes_and_the_chosen_texts(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(1)
    docs = [(i, " ".join(map(str, rng.integers(1 << 60, size=50).tolist()))) for i in range(1500)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 3 // 2) for i, _ in docs], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(toxicity, "fit", functools.partial(toxicity.fit, most_rows=30, trials=1))
    store = spark.sparkContext._jsc.sc().statusStore()
    group = "fitting"
    spark.sparkContext.setJobGroup(group, group)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toxicity.query(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker, written = spark.sparkContext.statusTracker(), 0
    time.sleep(1)  # for the listeners
    for stage in {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}:
        written += store.lastStageAttempt(stage).shuffleWriteBytes()
    assert 0 < written < 200_000


def test_a_sample_is_the_same_with_labels_apart(spark):
    rows = [(i, f"ab{i % 50} cd{i % 7}", i % 3 // 2) for i in range(300)] + [(7, "other", None), (None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = docs.where("doc_id IS NOT NULL").select("doc_id", "label").distinct()
    whole = docs.drop("label").join(labels, "doc_id")
    a, b = toxicity.sample(whole, most_rows=40), toxicity.sample(docs.drop("label"), most_rows=40, labels=labels)
    assert a[0] == b[0] and len(a[0]) == len(set(a[0])) and np.array_equal(a[1], b[1]) and 35 <= len(a[0]) <= 40 and 0 < a[1].sum() < len(a[1])
