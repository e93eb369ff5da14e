"""Written tables are taken for what they are in memory."""

from pyspark.sql import functions as F

from grovespark.storage import Pile, settle


def test_a_large_table_in_a_small_file_is_not_broadcast(spark):
    """300,000 rows of paths, some 70 MB in memory and under the limit of a broadcast as a file."""
    spark.conf.unset("spark.sql.sources.fileCompressionFactor")
    uid = F.concat(F.lit("p"), F.col("id").cast("string"))
    rows = spark.range(300_000).select(uid.alias("uid"), F.array(F.lit("life"), F.concat(F.lit("b:"), (F.col("id") % 25).cast("string")), uid).alias("path"))
    a, b = settle(rows), settle(rows)
    assert int(str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).rstrip("b")) >= 10 << 20
    plan = a.join(b.withColumnRenamed("path", "other"), "uid")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    # A small one still is.
    small = settle(spark.range(10).select(F.col("id").cast("string").alias("uid")))
    assert "BroadcastHashJoin" in a.join(small, "uid")._jdf.queryExecution().executedPlan().toString()


def test_a_session_that_says_so_keeps_its_factor(spark):
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "3.0")
    try:
        settle(spark.range(3))
        assert spark.conf.get("spark.sql.sources.fileCompressionFactor") == "3.0"
    finally:
        spark.conf.unset("spark.sql.sources.fileCompressionFactor")


def test_parts_are_one_relation(spark):
    pile = Pile(spark, "pile")
    assert pile.all() is None
    for k in range(5):
        assert pile.add(spark.range(k, 2 * k)).count() == k
    assert sorted(r["id"] for r in pile.all().collect()) == [1, 2, 3, 3, 4, 4, 5, 5, 6, 7]
    assert pile.all()._jdf.queryExecution().analyzed().collectLeaves().size() == 1
