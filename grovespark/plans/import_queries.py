"""Queries of whole imports: dumps are written as lines from the star tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.plans.star import table
from grovespark.sources import ncbi
from grovespark.storage import settle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _line(*fields: Column | str) -> Column:
    return F.concat(F.concat_ws("\t|\t", *(F.lit(f) if isinstance(f, str) else f for f in fields)), F.lit("\t|")).alias("value")


def ncbi_dump(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Lines of nodes, names, ids to skip and lines of merged ids: region - nation - customer - order.

    Even nations bear their region's name. Customers of FURNITURE bear their nation's, of BUILDING their region's; MACHINERY are families, others
    genera. Urgent finished orders bear their customer's name, or their region's under FURNITURE; open ones are samples. Customers in debt are skipped.
    """
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    n = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("nk"), "n_name", "r_regionkey", "r_name")
    segment = F.col("c_mktsegment")
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("nk")).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "nk", "n_name", "r_name")
    o = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    p = F.col("o_orderpriority")
    urgent = (F.col("o_orderstatus") == "F") & (p == "1-URGENT")
    order = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))
    o = o.select(
        F.concat(F.lit("o"), "o_orderkey").alias("uid"), F.concat(F.lit("c"), "c_custkey").alias("up"), F.lit("species").alias("rank"),
        F.when(F.col("o_orderstatus") == "P", "environmental samples").when(urgent, F.when(segment == "FURNITURE", F.col("r_name")).otherwise(F.col("c_name"))).otherwise(order).alias("name"),
        F.when((F.col("o_orderstatus") == "O") & (p == "5-LOW"), F.concat(order, F.lit(" <series>"))).otherwise("").alias("unique"), F.concat(F.lit("Old "), F.col("o_orderkey").cast("string")).alias("old"),
        F.when(p.isin("1-URGENT", "2-HIGH"), "synonym").when(p == "3-MEDIUM", "in-part").alias("class"), "o_orderkey", "o_orderstatus",
    )
    rows = (
        spark.range(1).select(F.lit("1"), F.lit("1"), F.lit("no rank"), F.lit("root"), F.lit(""))
        .union(region.select(F.concat(F.lit("r"), "r_regionkey"), F.lit("1"), F.lit("phylum"), "r_name", F.lit("")))
        .union(n.select(F.concat(F.lit("n"), "nk"), F.concat(F.lit("r"), "r_regionkey"), F.lit("order"), F.when(F.col("nk") % 2 == 0, F.col("r_name")).otherwise(F.col("n_name")), F.lit("")))
        .union(c.select(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "nk"), F.when(segment == "MACHINERY", "family").otherwise("genus"),
                        F.when(segment == "FURNITURE", F.col("n_name")).when(segment == "BUILDING", F.col("r_name")).otherwise(F.col("c_name")), F.lit("")))
        .union(o.select("uid", "up", "rank", "name", "unique")).toDF("uid", "up", "rank", "name", "unique")
    )
    rows = settle(rows)
    names = rows.select(_line(F.col("uid"), F.col("name"), F.col("unique"), "scientific name")).union(o.where("class IS NOT NULL").select(_line(F.col("uid"), F.col("old"), "", F.col("class"))))
    skip = c.where("c_acctbal < 0").select(F.concat(F.lit("c"), "c_custkey").alias("uid"))
    merged = o.where("o_orderstatus = 'F'").select(_line(F.concat(F.lit("x"), "o_orderkey"), F.col("uid")))
    return rows.select(_line(F.col("uid"), F.col("up"), F.col("rank"))), names, skip, merged


@query("""WITH n AS (SELECT n_nationkey AS nk, n_name, r_regionkey AS rk, r_name, n_nationkey % 2 = 0 AS even FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT *, CASE c_mktsegment WHEN 'FURNITURE' THEN n_name WHEN 'BUILDING' THEN r_name ELSE c_name END AS nm, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'family' ELSE 'genus' END AS rank,
    CASE WHEN even THEN 'r' || rk ELSE 'n' || nk END AS up, (c_mktsegment = 'FURNITURE' AND NOT even) OR (c_mktsegment = 'BUILDING' AND even) AS sunk
  FROM customer JOIN n ON c_nationkey = nk WHERE NOT c_acctbal < 0),
o AS (SELECT *, CASE WHEN sunk THEN up ELSE 'c' || c_custkey END AS home, CASE WHEN NOT sunk THEN nm WHEN even THEN r_name ELSE n_name END AS home_name, 'Order ' || o_orderkey AS own, o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS urgent FROM orders JOIN c ON o_custkey = c_custkey),
q AS (SELECT *, urgent AND c_mktsegment = 'MACHINERY' AS gone FROM o)
SELECT 'node' AS kind, '1' AS uid, CAST(NULL AS VARCHAR) AS other, 'life' AS name, 'no rank' AS rank
UNION ALL SELECT 'node', 'r' || r_regionkey, '1', r_name, 'phylum' FROM region
UNION ALL SELECT 'node', 'n' || nk, 'r' || rk, n_name, 'order' FROM n WHERE NOT even
UNION ALL SELECT 'node', 'c' || c_custkey, up, CASE WHEN c_mktsegment = 'BUILDING' THEN r_name || ' phylum ' || r_name || ' genus ' || n_name || ' order' ELSE nm END, rank FROM c WHERE NOT sunk
UNION ALL SELECT 'node', 'o' || o_orderkey, home, CASE WHEN o_orderstatus = 'P' THEN home_name || ' environmental samples'
    WHEN urgent AND c_mktsegment = 'FURNITURE' THEN r_name || ' phylum ' || r_name || ' species ' || n_name || CASE WHEN even THEN ' genus' ELSE ' order' END
    WHEN urgent AND c_mktsegment = 'BUILDING' THEN c_name WHEN urgent THEN c_name || ' species ' || c_name
    WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN own || ' series' ELSE own END, 'species' FROM q WHERE NOT gone
UNION ALL SELECT DISTINCT 'synonym', CASE WHEN gone THEN home ELSE 'o' || o_orderkey END, NULL, 'Old ' || o_orderkey, 'synonym' FROM q WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'alias', 'x' || o_orderkey, 'o' || o_orderkey, NULL, NULL FROM orders WHERE o_orderstatus = 'F'""")
def s16_ncbi(spark, d):
    """A dump written from the star tables, imported whole: nodes, synonyms and aliases."""
    got = ncbi.build(*ncbi_dump(spark, d)).taxonomy
    none = F.lit(None).cast("string")
    nodes = got.nodes.select(F.lit("node").alias("kind"), "uid", F.col("parent_uid").alias("other"), "name", "rank")
    return nodes.union(got.synonyms.select(F.lit("synonym"), "uid", none, "name", "type")).union(got.aliases.select(F.lit("alias"), "id", "replacement", none, none))
