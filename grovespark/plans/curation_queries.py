"""Queries of curation operators and of the report on old ids, over the star hierarchies, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from grovespark.model import BIT, Taxonomy
from grovespark.operators import curation, deprecation, tree
from grovespark.plans.join_queries import RELEASES, _releases
from grovespark.plans.star import H1, H1_NODES, H2_NODES, catalogue, geography, suppliers, table
from grovespark.storage import settle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


@query(f"""WITH {H2_NODES}, g AS (SELECT * FROM n WHERE uid LIKE 'g:%')
SELECT uid, parent_uid, name FROM n UNION ALL SELECT 'e:' || uid, uid, name || ' subgenus ' || name FROM g WHERE parent_uid LIKE '%1'
UNION ALL SELECT 's:' || uid, uid, name || ' subgenus ' || name FROM g WHERE parent_uid NOT LIKE '%1'""")
def m17_subgenera(spark, d):
    """Every group with a subgenus of its name; those of brands that end in 1 with the proper name beside it."""
    h2 = catalogue(spark, d)
    groups = h2.nodes.where("rank = 'genus'")

    def below(letter, name):
        return groups.withColumns({"parent_uid": F.col("uid"), "uid": F.concat(F.lit(letter), "uid"), "name": name, "rank": F.lit("subgenus")})

    more = below("s:", F.col("name")).union(below("e:", F.concat("name", F.lit(" subgenus "), "name")).where("uid LIKE 'e:g:%1:%'"))
    return curation.name_subgenera(h2.with_nodes(h2.nodes.union(more))).nodes.select("uid", "parent_uid", "name")


def _by_segment(spark, d):
    """The geography with customers whose first source is their segment."""
    segment = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("uid"), "c_mktsegment", "c_acctbal")
    nodes = geography(spark, d).nodes.join(segment, "uid", "left")
    first = F.array(F.struct(F.col("c_mktsegment").alias("prefix"), F.col("uid").alias("id")))
    return nodes.withColumn("source_ids", F.when(F.col("c_mktsegment").isNotNull(), first).otherwise(F.col("source_ids")))


@query(f"WITH {H1_NODES} SELECT uid, flags | CASE WHEN uid IN (SELECT 'c' || c_custkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING') THEN 131072 ELSE 0 END AS proper_flags FROM n")
def m32_extinct(spark, d):
    """Customers with orders are listed; those of one source become extinct."""
    listed = table(spark, d, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("uid"))
    return curation.mark_extinct(_by_segment(spark, d), listed, prefix="BUILDING").select("uid", "proper_flags")


CLAIMED = "SELECT 'p' || l_partkey AS uid, p_name AS name, l_partkey % 2 = 0 AS whether, l_partkey = p_partkey AS fits FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN part ON l_suppkey = p_partkey"


@query(f"SELECT c.uid, c.name, whether, (c.name = own.p_name) = whether AS holds FROM (SELECT DISTINCT uid, name, whether FROM ({CLAIMED})) c JOIN part own ON c.uid = 'p' || own.p_partkey")
def m28_names(spark, d):
    """Has an ordered part the name of the part that its supplier's number stands for?"""
    return curation.has_name(catalogue(spark, d), _claims(spark, d))


def _claims(spark, d):
    pairs = table(spark, d, "lineitem").select("l_partkey", F.col("l_suppkey").alias("p_partkey")).distinct().join(table(spark, d, "part").select("p_partkey", "p_name"), "p_partkey")
    return pairs.select(F.concat(F.lit("p"), "l_partkey").alias("uid"), F.col("p_name").alias("name"), (F.col("l_partkey") % 2 == 0).alias("whether")).distinct()


@query("SELECT 'n' || n_nationkey AS src, 'n' || n_nationkey AS tgt, 'n' || n_nationkey AS division FROM nation WHERE n_nationkey % 5 <> 0")
def j15_divisions(spark, d):
    """Nations as divisions of the suppliers, who bear their nation's name as well; each fifth nation's name is its neighbour's too."""
    h4 = suppliers(spark, d)
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    lower = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("s"), "s_suppkey").alias("uid"), F.col("n_name").alias("name"))
    beside = nation.where("n_nationkey % 5 = 0").select(F.concat(F.lit("n"), (F.col("n_nationkey") + 1).cast("string")).alias("uid"), F.col("n_name").alias("name"))
    skeleton = nation.select(F.concat(F.lit("n"), "n_nationkey").alias("uid"), F.col("n_name").alias("name"))
    images = geography(spark, d).nodes.join(skeleton.select("uid"), "uid", "left_semi").select(F.col("uid").alias("src"), F.col("uid").alias("tgt"))
    return curation.divisions_by_name(tree.with_path(h4.nodes), lower.union(beside), skeleton, images, images.where("false"))


@query("""WITH k AS (SELECT 'c' || c_custkey AS uid, 'n' || c_nationkey AS up, c_mktsegment AS seg, c_acctbal AS bal, c_nationkey AS nk FROM customer),
s AS (SELECT n_nationkey AS nk, 1 + (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) + (SELECT count(*) FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey = n_nationkey) AS size FROM nation),
m AS (SELECT up, seg, count(*) AS n FROM k WHERE bal < 0 GROUP BY ALL)
SELECT k.uid, k.up AS mrca, size, coalesce(m.n, 0) AS n_unplaced, u.uid AS child FROM k JOIN s USING (nk) LEFT JOIN m USING (up, seg) LEFT JOIN (SELECT * FROM k WHERE bal < 0) u ON u.up = k.up AND u.seg = k.seg AND m.n < 30 WHERE k.bal > 9000""")
def c11_inconsistent(spark, d):
    """Customers with much money are inconsistent, those with debts are unplaced."""
    nodes = _by_segment(spark, d)
    bits = F.when(F.col("c_acctbal") > 9000, BIT["inconsistent"]).when(F.col("c_acctbal") < 0, BIT["unplaced"]).otherwise(0)
    nodes = settle(nodes.withColumn("proper_flags", bits).drop("c_acctbal", "c_mktsegment"))
    return curation.inconsistent_examples(nodes, tree.subtree_counts(tree.with_children(tree.with_path(nodes))).select("uid", "n_nodes"))


@query("""WITH y AS (SELECT DISTINCT p_partkey AS k, p_name AS name, split_part(p_name, ' ', 1) || ' ' || p_brand AS synonym, l_suppkey AS s FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT 'p' || k AS uid, name, synonym, 's' || s AS other_id FROM y WHERE left(name, greatest(0, least(length(name), length(synonym)) - 3)) <> left(synonym, greatest(0, least(length(name), length(synonym)) - 3))""")
def a22_redescriptions(spark, d):
    """Parts whose suppliers name them by first word and brand."""
    part = table(spark, d, "part")
    s = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey").distinct().join(part, "p_partkey")
    held = F.array(F.struct(F.lit("tpch").alias("prefix"), F.concat(F.lit("p"), "p_partkey").alias("id")), F.struct(F.lit("supplier").alias("prefix"), F.concat(F.lit("s"), "l_suppkey").alias("id")))
    synonyms = s.select(F.concat(F.lit("p"), "p_partkey").alias("uid"), F.concat(F.substring_index("p_name", " ", 1), F.lit(" "), "p_brand").alias("name"), held.alias("source_ids"))
    return curation.redescriptions(catalogue(spark, d).nodes, synonyms)


@query(H1 + ", c AS (SELECT * FROM t WHERE uid LIKE 'c%') SELECT uid, -row_number() OVER (ORDER BY (SELECT name FROM n WHERE n.uid = c.path[2]), (SELECT name FROM n WHERE n.uid = c.path[3]), name, uid) AS new_id FROM c")
def i6_dummy_ids(spark, d):
    """Customers have no id."""
    nodes = tree.with_path(geography(spark, d).nodes)
    return curation.dummy_ids(nodes.withColumn("id", F.when(~F.col("uid").startswith("c"), F.col("uid"))))


@query(RELEASES + """, b AS (SELECT o.*, CAST(substr(o.uid, 2) AS BIGINT) AS key FROM o WHERE o.uid LIKE 'p%'),
i AS (SELECT b.*, w.hid, w.uid IS NOT NULL AS here, CASE WHEN w.uid IS NULL OR b.key % 19 = 0 THEN NULL WHEN b.key % 17 = 0 THEN b.parent_uid ELSE b.uid END AS tgt FROM b LEFT JOIN w USING (uid)),
oc AS (SELECT name, count(*) AS old_k FROM o GROUP BY name), wc AS (SELECT name, count(*) AS new_k, min(uid) AS one FROM w GROUP BY name),
x AS (SELECT i.*, old_k, new_k, one, ow.parent_uid AS one_up, regexp_extract(i.parent_uid, '^g:([^:]*):', 1) AS brand, regexp_extract(ow.parent_uid, '^g:([^:]*):', 1) AS one_brand FROM i JOIN oc USING (name) LEFT JOIN wc USING (name) LEFT JOIN w ow ON ow.uid = one)
SELECT uid AS id, 1 AS size, x.name, CASE WHEN tgt <> uid THEN 'lumped' WHEN tgt = uid THEN 'newly-hidden[hidden]' WHEN here THEN 'id-used-differently' WHEN new_k IS NULL THEN 'id-retired/name-retired' WHEN new_k = 1 AND brand <> one_brand THEN 'id-retired/changed-divisions'
  WHEN new_k > old_k THEN 'id-retired/possible-splitting' WHEN old_k > new_k THEN 'id-retired/probable-lumping' WHEN new_k = 1 THEN 'id-retired/incompatible-use' ELSE 'id-retired/incompatible-uses' END AS reason,
 CASE WHEN tgt <> uid THEN '' WHEN tgt = uid THEN x.name_now WHEN here OR new_k IS NULL OR new_k <> 1 THEN '' WHEN brand <> one_brand THEN brand || '->' || one_brand WHEN old_k = 1 AND x.parent_uid <> one_up THEN (SELECT name FROM w WHERE uid = x.parent_uid) || '->' || (SELECT name FROM w WHERE uid = one_up) ELSE '' END AS witness,
 CASE WHEN tgt <> uid THEN tgt WHEN tgt = uid THEN '=' WHEN here THEN '*' WHEN new_k = 1 THEN '!' || one ELSE '*' END AS replacement, CASE WHEN key % 2 = 0 THEN 'synthesis' ELSE 'phylesystem' END AS status
FROM (SELECT x.*, (SELECT name FROM w WHERE w.uid = x.uid) AS name_now FROM x) x WHERE tgt IS NULL OR tgt <> uid OR hid""")
def a15_deprecated(spark, d):
    """All parts are in use; some are lumped into their group, some have no image, some are gone, some are hidden since."""
    old, new = _releases(spark, d)

    def ready(nodes):
        p = settle(tree.with_children(tree.with_path(nodes)))
        p = p.join(tree.subtree_counts(p).select("uid", "n_nodes"), "uid")
        return settle(p.withColumn("division", F.regexp_extract(F.get("path", F.lit(1)), "^b:(.*)$", 1)))

    o, w = ready(old), ready(new)
    key = F.when(F.col("uid").startswith("p"), F.substring("uid", 2, 20).cast("long"))
    both = old.join(new.select("uid"), "uid", "left_semi").where(key.isNull() | (key % 19 != 0))
    images = both.select(F.col("uid").alias("src"), F.when(key % 17 == 0, F.col("parent_uid")).otherwise(F.col("uid")).alias("tgt"))
    important = old.where(key.isNotNull()).select(F.col("uid").alias("id"), (key % 2 == 0).alias("in_synthesis"))
    h2 = catalogue(spark, d)
    return deprecation.deprecated_ids(o, h2.synonyms, Taxonomy(new, h2.synonyms, h2.aliases, "h2"), w, images, important)
