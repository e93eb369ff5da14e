"""Fitting and scoring on DataFrames: held-out rows, odd input, empty tables."""

import numpy as np
from pyspark.sql import functions as F

from grovespark.llm import toxicity


def made_up(n=500):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        words = [f"{rng.choice(['ab', 'cd', 'ef'])}{rng.integers(60)}" for _ in range(rng.integers(8, 120))]
        if i % 4 == 0:
            words.insert(int(rng.integers(len(words))), str(rng.choice(["vile scum", "awful pest", "rotten fool"])))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_held_out_rows(spark):
    docs = spark.createDataFrame(made_up(), "doc_id long, text string, label int")
    net = toxicity.fit(docs.where(~toxicity.held_out(F.col("doc_id"))), trials=2)
    rest = docs.where(toxicity.held_out(F.col("doc_id"))).withColumn("score", F.lit("taken"))
    got = toxicity.score(rest, net).collect()
    right = sum((r["score"] >= 0.5) == bool(r["label"]) for r in got)
    assert len(got) > 60 and right >= 0.9 * len(got) and all(0 <= r["score"] <= 1 for r in got)


def test_the_same_rows_give_the_same_network(spark):
    docs = spark.createDataFrame(made_up(120), "doc_id long, text string, label int")
    a, b = (toxicity.fit(d, trials=2) for d in (docs.union(docs), docs.repartition(5)))
    assert all(np.array_equal(a.p[k], b.p[k]) for k in a.p)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "ab1 vile scum", 1), (2, "ab1 ab2", 0), (2, "ab1 ab2", 0), (3, None, 0), (4, "", 0), (None, "x", None), (5, "ab2 cd3", None)], "doc_id long, text string, label int")
    net = toxicity.fit(docs, trials=1)
    got = toxicity.score(docs, net).collect()
    assert len(got) == 7 and len({r["score"] for r in got if not r["text"]}) == 1 and len({r["score"] for r in got if r["doc_id"] == 2}) == 1
    empty = docs.where("false")
    assert toxicity.fit(empty) is None and toxicity.score(empty, net).count() == 0
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
