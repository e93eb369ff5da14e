"""Hierarchies over the star-schema tables, as DataFrames, and the same as SQL for comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.model import BIT, Taxonomy, taxonomy


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _rows(df: DataFrame, uid: Column, parent: Column, name: Column, rank: str, flags: Column | None = None, qid: Column | None = None) -> DataFrame:
    first = F.struct(F.lit("tpch").alias("prefix"), uid.alias("id"))
    ids = F.array(first) if qid is None else F.array(first, qid)
    return df.select(uid.alias("uid"), parent.alias("parent_uid"), name.alias("name"), F.lit(rank).alias("rank"), ids.alias("source_ids"), (F.lit(0) if flags is None else flags).alias("proper_flags"), F.lit(0).alias("inferred_flags"))


def _id(letter: str, col: str) -> Column:
    return F.concat(F.lit(letter), F.col(col).cast("string"))


def _life(spark: SparkSession) -> DataFrame:
    return _rows(spark.range(1), F.lit("life"), F.lit(None).cast("string"), F.lit("life"), "no rank")


def geography(spark: SparkSession, d: str) -> Taxonomy:
    """H1: life - region - nation - customer - order. Household customers are hidden, orders with status F extinct."""
    region = _rows(table(spark, d, "region"), _id("r", "r_regionkey"), F.lit("life"), F.col("r_name"), "phylum")
    nation = _rows(table(spark, d, "nation"), _id("n", "n_nationkey"), _id("r", "n_regionkey"), F.col("n_name"), "order")
    customer = _rows(table(spark, d, "customer"), _id("c", "c_custkey"), _id("n", "c_nationkey"), F.col("c_name"), "genus", F.when(F.col("c_mktsegment") == "HOUSEHOLD", BIT["hidden"]).otherwise(0))
    orders = _rows(table(spark, d, "orders"), _id("o", "o_orderkey"), _id("c", "o_custkey"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")), "species", F.when(F.col("o_orderstatus") == "F", BIT["extinct"]).otherwise(0))
    return taxonomy(_life(spark).union(region).union(nation).union(customer).union(orders), idspace="h1")


def catalogue(spark: SparkSession, d: str, by_size: bool = False, drop_tenth: bool = False) -> Taxonomy:
    """H2 (by type) or H3 (by size band): life - brand - group - part. ``drop_tenth``: without parts whose key ends in 0."""
    part = table(spark, d, "part")
    if drop_tenth:
        part = part.where("p_partkey % 10 <> 0")
    group = F.concat(F.lit("size "), F.floor(F.col("p_size") / 10).cast("string")) if by_size else F.col("p_type")
    gid = F.concat(F.lit("g:"), F.col("p_brand"), F.lit(":"), group)
    bid = F.concat(F.lit("b:"), F.col("p_brand"))
    brands = _rows(part.select("p_brand").distinct(), bid, F.lit("life"), F.col("p_brand"), "family")
    groups = _rows(part.select("p_brand", group.alias("grp")).distinct(), F.concat(F.lit("g:"), F.col("p_brand"), F.lit(":"), F.col("grp")), bid, F.concat_ws(" ", "p_brand", "grp"), "genus")
    qid = F.struct(F.col("p_brand").alias("prefix"), F.col("p_partkey").cast("string").alias("id"))
    parts = _rows(part, _id("p", "p_partkey"), gid, F.col("p_name"), "species", qid=qid)
    return taxonomy(_life(spark).union(brands).union(groups).union(parts), idspace="h3" if by_size else "h2")


def suppliers(spark: SparkSession, d: str) -> Taxonomy:
    """H4: life - nation - supplier."""
    nation = _rows(table(spark, d, "nation"), _id("n", "n_nationkey"), F.lit("life"), F.col("n_name"), "order")
    supplier = _rows(table(spark, d, "supplier"), _id("s", "s_suppkey"), _id("n", "s_nationkey"), F.col("s_name"), "species")
    return taxonomy(_life(spark).union(nation).union(supplier), idspace="h4")


#: SQL of H1: n(uid, parent_uid, name, rank, lvl, flags), then p with paths and depths.
H1_NODES = """n AS (
  SELECT 'life' AS uid, CAST(NULL AS VARCHAR) AS parent_uid, 'life' AS name, 'no rank' AS rank, -1 AS lvl, 0 AS flags
  UNION ALL SELECT 'r' || r_regionkey, 'life', r_name, 'phylum', 200, 0 FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name, 'order', 400, 0 FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name, 'genus', 600, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 65536 ELSE 0 END FROM customer
  UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, 'Order ' || o_orderkey, 'species', 700, CASE WHEN o_orderstatus = 'F' THEN 131072 ELSE 0 END FROM orders)"""
H2_NODES = """n AS (
  SELECT 'life' AS uid, CAST(NULL AS VARCHAR) AS parent_uid, 'life' AS name, 'no rank' AS rank, -1 AS lvl, 0 AS flags
  UNION ALL SELECT DISTINCT 'b:' || p_brand, 'life', p_brand, 'family', 500, 0 FROM part
  UNION ALL SELECT DISTINCT 'g:' || p_brand || ':' || p_type, 'b:' || p_brand, p_brand || ' ' || p_type, 'genus', 600, 0 FROM part
  UNION ALL SELECT 'p' || p_partkey, 'g:' || p_brand || ':' || p_type, p_name, 'species', 700, 0 FROM part)"""
H3_NODES = H2_NODES.replace("p_brand || ':' || p_type", "p_brand || ':size ' || CAST(floor(p_size / 10) AS BIGINT)").replace("p_brand || ' ' || p_type", "p_brand || ' size ' || CAST(floor(p_size / 10) AS BIGINT)")
PATHS = """p AS (SELECT uid, [uid] AS path FROM n WHERE parent_uid IS NULL
  UNION ALL SELECT n.uid, list_append(p.path, n.uid) FROM n JOIN p ON n.parent_uid = p.uid),
t AS (SELECT n.*, path, len(path) AS depth FROM n JOIN p USING (uid))"""
#: Beginnings of statements that define n and t (nodes with paths).
H1, H2, H3 = (f"WITH RECURSIVE {x}, {PATHS}" for x in (H1_NODES, H2_NODES, H3_NODES))
