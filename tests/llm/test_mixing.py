"""Budgets over several domains."""

from pyspark.sql import functions as F

from grovespark.llm import common, mixing


def test_a_short_domain_leaves_its_money_to_its_siblings(spark):
    rows = [("a", "en", "a0", 10), ("b", "en", "b0", 20), ("b", "de", "b1", 80), ("c", "en", "c0", 60), ("c", "en", "c1", 40)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, supply long")
    weight = {"domain": F.when(F.col("domain") == "b", 2.0).otherwise(1.0)}
    got = {r["source"]: r["allowed"] for r in mixing.split_budget(leaves, mixing.LEVELS, F.lit(120.0), weight, common.Workspace(spark, "t")).collect()}
    # a uses its 10 of 30; b and c share 110 two to one: 73.3 and 36.7. In b, en uses its 20 and de gets the rest.
    assert got == {"a0": 10, "b0": 20, "b1": 53, "c0": 18, "c1": 18}
