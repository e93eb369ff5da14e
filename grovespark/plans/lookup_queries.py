"""Queries of lookups, selections and checks over the star hierarchies, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from grovespark.model import Taxonomy
from grovespark.operators import lookups, tree
from grovespark.plans.star import H1, H2, H2_NODES, catalogue, geography, suppliers, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


@query("""WITH c AS (SELECT p_name, count(*) AS k, min('p' || p_partkey) AS u FROM part GROUP BY p_name)
SELECT p_name AS designator, CASE WHEN k = 1 THEN u END AS uid FROM c UNION ALL SELECT 'p' || l_partkey, 'p' || l_partkey FROM (SELECT DISTINCT l_partkey FROM lineitem) UNION ALL SELECT DISTINCT 'none ' || p_brand, NULL FROM part""")
def p2_designators(spark, d):
    """Part names, ids of ordered parts, and names that no node has."""
    names = table(spark, d, "part").select(F.col("p_name").alias("designator")).distinct()
    ids = table(spark, d, "lineitem").select(F.concat(F.lit("p"), "l_partkey")).distinct()
    none = table(spark, d, "part").select(F.concat(F.lit("none "), "p_brand")).distinct()
    return lookups.by_designator(names.union(ids).union(none), catalogue(spark, d))


@query("""SELECT 'p' || p_partkey AS id, 'p' || p_partkey AS uid FROM part
UNION ALL SELECT 'old' || p_partkey, CASE WHEN p_size > 20 THEN 'p' || p_partkey END FROM part UNION ALL SELECT 'older' || p_partkey, CASE WHEN p_size > 20 THEN 'p' || p_partkey END FROM part""")
def p3_ids(spark, d):
    """Ids, aliases of the larger parts, and aliases of those."""
    part, h2 = table(spark, d, "part"), catalogue(spark, d)
    new, old, older = (F.concat(F.lit(x), "p_partkey") for x in ("p", "old", "older"))
    aliases = part.where("p_size > 20").select(F.inline(F.array(F.struct(old.alias("id"), new.alias("replacement")), F.struct(older.alias("id"), old.alias("replacement")))))
    return lookups.by_id(part.select(F.explode(F.array(new, old, older)).alias("id")), Taxonomy(h2.nodes, h2.synonyms, aliases, "h2"))


@query("SELECT 'o' || o_orderkey AS uid, 'r' || n_regionkey AS ancestor FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey WHERE n_regionkey = s_nationkey % 5 GROUP BY ALL")
def p6_filter_by_ancestor(spark, d):
    """Orders with the regions that their suppliers' nations stand for: those that the customer is in."""
    items, s = table(spark, d, "lineitem"), table(spark, d, "supplier")
    c = items.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.concat(F.lit("o"), "l_orderkey").alias("uid"), F.concat(F.lit("r"), (F.col("s_nationkey") % 5).cast("int")).alias("ancestor")).distinct()
    return lookups.filter_by_ancestor(c, tree.with_path(geography(spark, d).nodes))


@query("SELECT 'n' || s_nationkey AS uid, 'o' || o_orderkey AS descendant FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey = c_nationkey GROUP BY ALL")
def p6_filter_by_descendant(spark, d):
    """Nations of suppliers that an order's customer is in too."""
    items, s = table(spark, d, "lineitem"), table(spark, d, "supplier")
    c = items.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.concat(F.lit("n"), "s_nationkey").alias("uid"), F.concat(F.lit("o"), "l_orderkey").alias("descendant")).distinct()
    return lookups.filter_by_descendant(c, tree.with_path(geography(spark, d).nodes))


@query(H1 + " SELECT rank, count(*) AS n, min(uid) AS first FROM t GROUP BY rank")
def p14_ranks(spark, d):
    return lookups.ranks(geography(spark, d).nodes)


@query("SELECT 'c' || o_custkey AS uid, count(*) AS n, any_value(c_name) AS name FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey")
def p15_names(spark, d):
    ids = table(spark, d, "orders").groupBy(F.concat(F.lit("c"), "o_custkey").alias("uid")).agg(F.count("*").alias("n"))
    return lookups.with_names(ids, geography(spark, d).nodes)


@query("SELECT DISTINCT 'g:' || p_brand || ':' || p_type AS uid, p_brand || ' ' || p_type AS name FROM part JOIN lineitem ON l_partkey = p_partkey")
def p16_single_source(spark, d):
    """Groups (one id) of ordered parts (two ids)."""
    part = table(spark, d, "part").join(table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct(), "p_partkey", "left_semi")
    wanted = part.select(F.explode(F.array(F.concat(F.lit("g:"), "p_brand", F.lit(":"), "p_type"), F.concat(F.lit("p"), "p_partkey"))).alias("uid"))
    return lookups.single_source(catalogue(spark, d).nodes, "tpch", wanted)


@query("SELECT n_name AS name, 2 * count(*) AS n FROM nation GROUP BY n_name UNION ALL SELECT 'life', 2")
def p17_in_every_source(spark, d):
    return lookups.in_every_source({"h1": geography(spark, d), "h4": suppliers(spark, d)})


@query(f"""WITH {H2_NODES}, u AS (SELECT DISTINCT l_partkey AS k FROM lineitem)
SELECT 'tpch' AS prefix, (SELECT count(*) FROM u JOIN part ON k = p_partkey) AS n_used, count(*) AS n_all FROM n
UNION ALL SELECT p_brand, count(k), count(*) FROM part LEFT JOIN u ON k = p_partkey GROUP BY p_brand""")
def a20_coverage(spark, d):
    used = table(spark, d, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("uid"))
    return lookups.coverage(catalogue(spark, d).nodes, used)


@query("SELECT 's' || s_suppkey AS uid, 'unmapped' AS problem FROM supplier UNION ALL SELECT 'n' || n_nationkey, 'childless' FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)")
def a25_skeleton(spark, d):
    """Is the supplier hierarchy realised in the geography?"""
    h4, h1 = suppliers(spark, d), geography(spark, d)
    images = h4.nodes.select(F.col("uid").alias("src")).join(h1.nodes.select(F.col("uid").alias("tgt")), F.col("src") == F.col("tgt"))
    return lookups.skeleton_check(h4.nodes, images, h1.nodes)


@query("SELECT prefix, count(*) AS n FROM (SELECT c_mktsegment AS prefix FROM customer UNION ALL SELECT 'tpch' FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY prefix")
def m13_grafts(spark, d):
    """A geography whose customers come from a source for each segment: they are grafts, and so are their orders."""
    segment = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("uid"), "c_mktsegment")
    nodes = geography(spark, d).nodes.join(segment, "uid", "left")
    first = F.array(F.struct(F.col("c_mktsegment").alias("prefix"), F.col("uid").alias("id")))
    return lookups.graft_counts(nodes.withColumn("source_ids", F.when(F.col("c_mktsegment").isNotNull(), first).otherwise(F.col("source_ids"))))


@query(H2 + """, k AS (SELECT *, count(*) OVER (PARTITION BY name) AS k FROM t),
d AS (SELECT a.uid, max(list_count(list_filter(list_zip(a.path, b.path), lambda x: x[1] IS NOT DISTINCT FROM x[2]))) AS n FROM k a JOIN k b ON a.name = b.name AND a.uid <> b.uid GROUP BY a.uid)
SELECT k.uid, CASE WHEN k.k = 1 THEN '' WHEN d.n + 1 < len(k.path) THEN k.name || ' (' || k.rank || ' in ' || up.name || ')' ELSE k.name || ' (' || k.rank || ' tpch:' || k.uid || ')' END AS unique_name
FROM k LEFT JOIN d USING (uid) LEFT JOIN n up ON up.uid = k.path[d.n + 1]""")
def r8_unique_names(spark, d):
    return lookups.unique_names(tree.with_path(catalogue(spark, d).nodes))
