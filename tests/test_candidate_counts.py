"""Candidates counted without pairs against the pairs themselves, and a name with more pairs than could be made."""

import random

import pytest
from pyspark.sql import functions as F

from grovespark.model import taxonomy
from grovespark.operators import align
from grovespark.plans import join_queries
from test_align import forest


@pytest.mark.parametrize("seed", [5, 6])
def test_counts_are_those_of_the_pairs(spark, seed):
    rng = random.Random(seed)
    src, tgt = forest(spark, rng, "s", 70, ["Plantae"]), forest(spark, rng, "t", 90, ["Plantae", "Fungi"])
    want = {r["src"]: r["n"] for r in align.candidates(src, tgt).groupBy("src").agg(F.count("*").alias("n")).collect()}
    got = [tuple(r) for r in align.candidate_counts(src, tgt).collect()]
    assert dict(got) == want and len(got) == len(want) > 50


def test_a_name_of_many_nodes_makes_no_pairs(spark, monkeypatch):
    """A million sources and a million targets of one name: 10^12 pairs."""
    def many(spark, d, by_size=False):
        return taxonomy(spark.range(10**6).select(F.concat(F.lit("s" if by_size else "t"), "id").alias("uid"), F.lit(None).cast("string").alias("parent_uid"), F.lit("x").alias("name")))

    monkeypatch.setattr(join_queries, "catalogue", many)
    # Should pairs come back, they are cut off.
    spark.sparkContext.setJobGroup("pairs", "pairs", interruptOnCancel=True)
    import threading

    timer = threading.Timer(120, lambda: spark.sparkContext.cancelJobGroup("pairs"))
    timer.start()
    try:
        got = join_queries.j1_candidates(spark, "").agg(F.count("*").alias("k"), F.min("n").alias("low"), F.max("n").alias("high")).first()
    finally:
        timer.cancel()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tuple(got) == (10**6, 10**6, 10**6)
