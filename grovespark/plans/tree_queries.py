"""Queries of tree, predicate and flag operators over the star hierarchies, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.functions import codecs
from grovespark.model import BIT, taxonomy
from grovespark.operators import flags, tree
from grovespark.plans.star import H1, H2, H2_NODES, H3_NODES, PATHS, catalogue, geography, table
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


def pathed1(spark: SparkSession, d: str) -> DataFrame:
    return tree.with_children(tree.with_path(geography(spark, d).nodes))


def pathed2(spark: SparkSession, d: str, by_size: bool = False) -> DataFrame:
    return tree.with_children(tree.with_path(catalogue(spark, d, by_size).nodes))


UP1 = H1 + ", up AS (SELECT uid, flags, rank, lvl, depth, unnest(path) AS anc, unnest(range(1, depth + 1)) AS nth FROM t), kids AS (SELECT parent_uid AS uid, count(*) AS n_children FROM n WHERE parent_uid IS NOT NULL GROUP BY 1)"


@query(UP1 + """, own AS (SELECT uid, bit_or(CASE WHEN nth < depth THEN f.flags | CASE WHEN f.rank = 'species' THEN 2097152 ELSE 0 END ELSE 0 END) AS inherited
  FROM up JOIN (SELECT uid AS anc, flags, rank FROM n) f USING (anc) GROUP BY uid)
SELECT anc AS uid, count(*) AS n_nodes, count(*) FILTER (up.uid NOT IN (SELECT uid FROM kids)) AS n_tips, any_value(inherited) AS inherited FROM up JOIN own ON own.uid = up.anc GROUP BY anc""")
def clade_summary(spark: SparkSession, d: str) -> DataFrame:
    """Nodes, tips and inherited flags of every clade."""
    p = settle(pathed1(spark, d))
    counts = p.select(F.explode("path").alias("anc"), F.when(F.col("n_children") == 0, 1).otherwise(0).alias("tip")).groupBy(F.col("anc").alias("uid")).agg(F.count("*").alias("n_nodes"), F.sum("tip").alias("n_tips"))
    return counts.join(flags.inherit(p).select("uid", F.col("inferred_flags").alias("inherited")), "uid")


@query(H1 + " SELECT uid, array_to_string(path, '/') AS path, depth FROM t")
def h3_paths(spark, d):
    return tree.with_path(geography(spark, d).nodes).select("uid", F.concat_ws("/", "path").alias("path"), "depth")


@query(H1 + " SELECT uid, depth FROM t WHERE list_contains(path, 'r1') AND uid <> 'r1'")
def h1_descendants(spark, d):
    return tree.descendants(pathed1(spark, d), "r1", include_self=False).select("uid", "depth")


@query(UP1 + " SELECT uid, depth - nth AS steps, anc AS ancestor FROM up")
def h2_lineage(spark, d):
    return tree.lineage(pathed1(spark, d)).select("uid", "steps", "ancestor")


LCP = "len(list_filter(list_zip({a}, {b}), lambda z: z[1] = z[2]))"
PAIRS = H1 + """, q AS (SELECT a.uid AS a, b.uid AS b, a.path AS pa, b.path AS pb FROM t a JOIN t b ON b.uid = 'c' || CAST(CAST(substr(a.uid, 2) AS BIGINT) * 7 % 100 AS BIGINT) WHERE a.uid LIKE 'o%'),
m AS (SELECT *, """ + LCP.format(a="pa", b="pb") + " AS k FROM q)"


def _pairs(p: DataFrame) -> DataFrame:
    return p.where("uid LIKE 'o%'").select(F.col("uid").alias("a"), F.concat(F.lit("c"), (F.substring("uid", 2, 20).cast("long") * 7 % 100).cast("string")).alias("b"))


@query(PAIRS + " SELECT a, b, pa[k] AS mrca, k AS mrca_depth FROM m")
def h6_pair_mrca(spark, d):
    p = settle(pathed1(spark, d))
    return tree.pair_mrca(_pairs(p), p).select("a", "b", "mrca", "mrca_depth")


@query(PAIRS + " SELECT a, b, pa[k + 1] AS left_side, pb[k + 1] AS right_side FROM m WHERE k < len(pa) AND k < len(pb)")
def h8_divergence(spark, d):
    p = settle(pathed1(spark, d))
    return tree.pair_mrca(_pairs(p), p).where("left IS NOT NULL").select("a", "b", F.col("left").alias("left_side"), F.col("right").alias("right_side"))


@query(H1 + """, s AS (SELECT l_suppkey AS k, min(path) AS lo, max(path) AS hi FROM lineitem JOIN t ON t.uid = 'o' || l_orderkey GROUP BY 1)
SELECT k, lo[""" + LCP.format(a="lo", b="hi") + "] AS mrca FROM s")
def h7_set_mrca(spark, d):
    """The common clade of the orders that each supplier served."""
    p = pathed1(spark, d)
    members = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("uid"))
    return tree.set_mrca(members, p, "k").select("k", "mrca")


@query(UP1 + " SELECT anc AS uid, count(*) AS n_nodes, count(*) FILTER (up.uid NOT IN (SELECT uid FROM kids)) AS n_tips, count(*) FILTER (rank = 'species') AS n_species, 0 AS n_binomials FROM up GROUP BY anc")
def h9_h10_counts(spark, d):
    c = tree.subtree_counts(settle(pathed1(spark, d)))
    return c.select("uid", "n_nodes", "n_tips", "n_species", "n_binomials")


@query(UP1 + " SELECT anc AS uid, count(*) AS n_tips FROM up WHERE rank = 'species' AND flags = 0 GROUP BY anc")
def h11_filtered_tips(spark, d):
    return tree.count_tips_where(pathed1(spark, d).where("rank = 'species'"), F.col("proper_flags") == 0)


@query(H1 + """ SELECT max(depth) AS max_depth, (SELECT max(c) FROM (SELECT count(*) AS c FROM n WHERE parent_uid IS NOT NULL GROUP BY parent_uid)) AS max_children,
 (SELECT count(*) FROM n WHERE parent_uid IS NOT NULL) / (SELECT count(DISTINCT parent_uid) FROM n) AS branching FROM t""")
def h12_shape(spark, d):
    p = pathed1(spark, d)
    return p.agg(F.max("depth").alias("max_depth"), F.max("n_children").alias("max_children"), (F.sum("n_children") / F.sum(F.when(F.col("n_children") > 0, 1))).alias("branching"))


@query(H1 + " SELECT uid, CASE WHEN depth >= 3 AND path[3] IN ('n1','n2','n3','n4','n5') THEN path[3] WHEN depth >= 2 THEN path[2] END AS division FROM t")
def h13_division(spark, d):
    p = settle(pathed1(spark, d))
    divisions = p.where("rank = 'phylum' OR uid IN ('n1','n2','n3','n4','n5')").select("uid")
    return tree.with_division(p, divisions).select("uid", "division")


@query(f"WITH RECURSIVE {H2_NODES}, {PATHS}, o AS (SELECT DISTINCT name FROM ({H3_NODES.partition('(')[2].rpartition(')')[0]}))" + """
, up AS (SELECT t.uid, t.name, t.depth, unnest(path) AS anc, unnest(range(1, depth + 1)) AS nth FROM t),
u AS (SELECT up.*, n.name AS anc_name FROM up JOIN n ON n.uid = anc WHERE nth < depth),
f AS (SELECT uid, max(nth) AS first FROM u WHERE NOT starts_with(name, anc_name) GROUP BY uid)
SELECT u.uid, arg_max(anc, nth) AS quasi FROM u JOIN f USING (uid) WHERE nth <= first AND anc_name IN (SELECT name FROM o) GROUP BY u.uid""")
def h14_quasi_parent(spark, d):
    p = settle(pathed2(spark, d))
    return tree.quasi_parent(p, catalogue(spark, d, by_size=True).nodes.select("name")).select("uid", "quasi")


@query(UP1 + ", s AS (SELECT uid AS anc, flags % 7 + length(name) AS score FROM n) SELECT uid, arg_max(anc, {'s': score, 'a': -nth}) AS popular FROM up JOIN s USING (anc) GROUP BY uid")
def h15_popular(spark, d):
    return tree.popular_ancestor(settle(pathed1(spark, d)), F.col("proper_flags") % 7 + F.length("name"))


@query(f"WITH RECURSIVE {H2_NODES}, " + PATHS.replace("FROM n WHERE parent_uid IS NULL", "FROM n WHERE parent_uid = 'life'") + """, s AS (SELECT path[1] AS uid, count(*) AS c FROM t GROUP BY 1), top AS (SELECT arg_max(uid, {'c': c, 'u': uid}) AS top FROM (SELECT uid, c FROM s WHERE c = (SELECT max(c) FROM s) ORDER BY uid LIMIT 1))
SELECT uid, CASE WHEN uid = top THEN NULL WHEN depth = 1 THEN top ELSE parent_uid END AS parent_uid, CASE WHEN depth = 1 AND uid <> top THEN 128 ELSE 0 END AS proper_flags FROM t, top""")
def h16_normalize_roots(spark, d):
    tax = catalogue(spark, d)
    tax = tax.with_nodes(tax.nodes.where("uid <> 'life'").withColumn("parent_uid", F.when(F.col("parent_uid") != "life", F.col("parent_uid"))))
    p = settle(tree.with_children(tree.with_path(tax.nodes)))
    return tree.normalize_roots(tax, tree.subtree_counts(p)).nodes.select("uid", "parent_uid", "proper_flags")


@query()
def h17_sample(spark, d):
    p = settle(pathed1(spark, d))
    return tree.sample_tree(p, settle(tree.subtree_counts(p)), "life", 200)


@query(UP1 + """, s AS (SELECT anc AS uid, count(*) AS n_nodes FROM up GROUP BY anc), f AS (SELECT uid, n_nodes FROM s WHERE n_nodes > 10 AND n_nodes <= 600)
SELECT uid, n_nodes FROM f WHERE uid NOT IN (SELECT u.uid FROM up u JOIN f a ON u.anc = a.uid WHERE u.nth < u.depth AND u.uid IN (SELECT uid FROM f))""")
def h18_chop(spark, d):
    p = settle(pathed1(spark, d))
    return tree.chop(p, settle(tree.subtree_counts(p)), 10, 600)


@query(UP1 + """, c AS (SELECT uid, path FROM t WHERE uid LIKE 'o%7'), st AS (SELECT unnest(path) AS anc, unnest(range(1, len(path) + 1)) AS nth, path FROM c),
b AS (SELECT anc FROM st WHERE nth < len(path) GROUP BY anc HAVING count(DISTINCT path[nth + 1]) > 1), k AS (SELECT anc AS uid FROM b UNION SELECT uid FROM c)
SELECT t.uid, list_last(list_filter(t.path[1:t.depth - 1], lambda x: x IN (SELECT uid FROM k))) AS parent_uid FROM t JOIN k USING (uid)""".replace("list_last(list_filter(t.path[1:t.depth - 1], lambda x: x IN (SELECT uid FROM k)))", "(SELECT arg_max(u.anc, u.nth) FROM up u WHERE u.uid = t.uid AND u.nth < u.depth AND u.anc IN (SELECT uid FROM k))"))
def h19_induced_tree(spark, d):
    p = settle(pathed1(spark, d))
    return tree.induced_tree(p, p.where("uid LIKE 'o%7'"))


@query(UP1 + ", o AS (SELECT uid, row_number() OVER (ORDER BY path) - 1 AS s FROM t), z AS (SELECT anc AS uid, count(*) AS c FROM up GROUP BY anc) SELECT uid, s AS start, s + c AS finish FROM o JOIN z USING (uid)")
def h20_brackets(spark, d):
    p = settle(pathed1(spark, d))
    return tree.brackets(p, settle(tree.subtree_counts(p)))




@query(f"""WITH {H2_NODES}, m AS (SELECT * FROM n WHERE uid NOT IN (SELECT 'g:' || p_brand || ':' || p_type FROM part WHERE p_brand = 'Brand#1')), g AS (SELECT DISTINCT p_type FROM part WHERE p_brand = 'Brand#1'), x AS (SELECT count(*) AS c FROM part WHERE p_brand = 'Brand#1')
SELECT 'missing parent' AS problem, c AS n FROM x UNION ALL SELECT 'repeated id', 0 UNION ALL SELECT 'no path to a root', c FROM x UNION ALL SELECT 'synonym without node', (SELECT count(*) FROM g)""")
def h21_integrity(spark, d):
    tax = catalogue(spark, d)
    lost = tax.nodes.where("rank = 'genus' AND parent_uid = 'b:Brand#1'")
    tax = taxonomy(tax.nodes.join(lost, "uid", "left_anti"), lost.select("uid", "name", F.lit("synonym").alias("type")))
    return tree.integrity(tax)


@query("WITH RECURSIVE a AS (SELECT 'a' || s_suppkey AS id, CASE WHEN s_suppkey % 16 = 15 THEN 'n' || s_nationkey ELSE 'a' || (s_suppkey + 1) END AS replacement FROM supplier), w AS (SELECT id, replacement FROM a UNION ALL SELECT w.id, a.replacement FROM w JOIN a ON w.replacement = a.id) SELECT id, replacement FROM w WHERE replacement NOT IN (SELECT id FROM a)")
def h22_alias_chains(spark, d):
    s = table(spark, d, "supplier")
    nxt = F.when(F.col("s_suppkey") % 16 == 15, F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).otherwise(F.concat(F.lit("a"), (F.col("s_suppkey") + 1).cast("string")))
    return tree.resolve_aliases(s.select(F.concat(F.lit("a"), F.col("s_suppkey").cast("string")).alias("id"), nxt.alias("replacement")))


@query(H1 + " SELECT uid, CASE WHEN uid = 'r2' THEN NULL ELSE parent_uid END AS parent_uid FROM t WHERE list_contains(path, 'r2') AND depth <= 4")
def p12_select_to_depth(spark, d):
    return tree.select_subtree(pathed1(spark, d), "r2", 2).select("uid", "parent_uid")


@query(UP1 + ", bad AS (SELECT DISTINCT up.uid FROM up JOIN n a ON a.uid = up.anc WHERE a.flags <> 0), seen AS (SELECT * FROM t WHERE uid NOT IN (SELECT uid FROM bad)), live AS (SELECT DISTINCT unnest(path) AS uid FROM seen WHERE uid NOT IN (SELECT uid FROM kids)) SELECT uid FROM seen WHERE uid IN (SELECT uid FROM live)")
def p12_select_visible(spark, d):
    return tree.select_visible(settle(pathed1(spark, d))).select("uid")


@query(H1 + " SELECT uid, 'in' AS side FROM t WHERE list_contains(path, 'n3') UNION ALL SELECT uid, 'rest' FROM t WHERE uid = 'n3' OR NOT list_contains(path, 'n3')")
def p13_split(spark, d):
    a, b = tree.split(settle(pathed1(spark, d)), "n3")
    return a.select("uid", F.lit("in").alias("side")).union(b.select("uid", F.lit("rest").alias("side")))


@query(UP1 + " SELECT n.uid, flags <> 0 AS hidden, flags & 131072 <> 0 AS extinct, parent_uid IS NULL AS is_root, coalesce(n_children, 0) > 0 AS has_children FROM n LEFT JOIN kids USING (uid)")
def p7_p8_predicates(spark, d):
    p = tree.with_children(geography(spark, d).nodes)
    return p.select("uid", tree.hidden().alias("hidden"), codecs.has(F.col("proper_flags"), BIT["extinct"]).alias("extinct"), F.col("parent_uid").isNull().alias("is_root"), (F.col("n_children") > 0).alias("has_children"))


# Flags

INHERIT = UP1 + """, inh AS (SELECT uid, bit_or(CASE WHEN nth < depth THEN f.flags | CASE WHEN f.rank = 'species' THEN 2097152 ELSE 0 END ELSE 0 END) AS inferred
  FROM up JOIN (SELECT uid AS anc, flags, rank FROM n) f USING (anc) GROUP BY uid)"""


@query(INHERIT + " SELECT uid, inferred AS inferred_flags FROM inh")
def f1_inherit(spark, d):
    return flags.inherit(settle(pathed1(spark, d))).select("uid", "inferred_flags")


@query(UP1 + ", live AS (SELECT DISTINCT anc AS uid FROM up WHERE lvl >= 700 AND flags = 0) SELECT t.uid, live.uid IS NULL AS barren FROM t LEFT JOIN live USING (uid) WHERE NOT (rank = 'species' AND flags <> 0)")
def f2_barren(spark, d):
    """After extinct orders are dropped, which clades hold no species?"""
    nodes = geography(spark, d).nodes.where("NOT (rank = 'species' AND proper_flags <> 0)")
    p = settle(tree.with_children(tree.with_path(nodes)))
    return flags.barren(p.withColumn("rank", F.when(F.col("rank") == "no rank", "domain").otherwise(F.col("rank")))).select("uid", codecs.has(F.col("inferred_flags"), BIT["barren"]).alias("barren"))


@query(UP1 + """, e AS (SELECT uid, CASE WHEN uid IN (SELECT DISTINCT u.uid FROM up u JOIN n a ON a.uid = u.anc WHERE a.flags & 65536 <> 0 AND nth < depth) THEN TRUE ELSE FALSE END AS inf FROM n),
lack AS (SELECT DISTINCT anc FROM up JOIN e USING (uid) WHERE NOT inf AND up.uid NOT IN (SELECT uid FROM kids))
SELECT e.uid, inf OR (e.uid IN (SELECT uid FROM kids) AND e.uid NOT IN (SELECT anc FROM lack)) AS extinct FROM e""")
def f3_extinct_up(spark, d):
    """Household customers count as extinct: their orders inherit it, and the customers are lifted."""
    p = pathed1(spark, d).withColumn("proper_flags", F.when(codecs.has(F.col("proper_flags"), BIT["hidden"]), BIT["extinct"]).otherwise(0))
    return flags.extinct_up(settle(flags.inherit(settle(p)))).select("uid", codecs.has(F.col("inferred_flags"), BIT["extinct"]).alias("extinct"))


@query(H1 + """, i AS (SELECT uid, parent_uid, flags AS pf, CASE WHEN rank = 'species' THEN 65536 + 4194304 ELSE 0 END AS inf FROM n), j AS (SELECT i.*, i.inf & ~(i.pf | a.pf | a.inf) & ~(8192 + 16384 + 2097152 + 4194304) AS wrong FROM i LEFT JOIN i a ON a.uid = i.parent_uid)
SELECT uid, pf | coalesce(wrong, 0) AS proper_flags, inf & ~coalesce(wrong, 0) AS inferred_flags FROM j""")
def f4_fix(spark, d):
    nodes = geography(spark, d).nodes.withColumn("inferred_flags", F.when(F.col("rank") == "species", BIT["hidden"] | BIT["barren"]).otherwise(0))
    return flags.fix(nodes).select("uid", "proper_flags", "inferred_flags")


RERANKED = H2 + ", r AS (SELECT uid, parent_uid, CASE WHEN rank = 'species' AND CAST(substr(uid, 2) AS BIGINT) % 50 = 0 THEN 'genus' WHEN rank = 'species' AND CAST(substr(uid, 2) AS BIGINT) % 50 = 1 THEN 'subspecies' ELSE rank END AS rank FROM n), l AS (SELECT *, CASE rank WHEN 'no rank' THEN -1 WHEN 'family' THEN 500 WHEN 'genus' THEN 600 WHEN 'species' THEN 700 ELSE 720 END AS lv FROM r), h AS (SELECT *, min(CASE WHEN lv >= 0 THEN lv END) OVER (PARTITION BY parent_uid) AS high FROM l)"


def _reranked(spark, d):
    key = F.when(F.col("rank") == "species", F.substring("uid", 2, 20).cast("long") % 50)
    return catalogue(spark, d).nodes.withColumn("rank", F.when(key == 0, "genus").when(key == 1, "subspecies").otherwise(F.col("rank")))


@query(RERANKED + " SELECT uid, CASE WHEN parent_uid IS NOT NULL AND lv > high THEN 8192 ELSE 0 END AS minor, CASE WHEN parent_uid IS NOT NULL AND lv >= 0 AND lv // 100 > high // 100 THEN 8 ELSE 0 END AS major FROM h")
def f5_sibling_ranks(spark, d):
    nodes = _reranked(spark, d)
    a = flags.sibling_ranks(nodes).select("uid", F.col("proper_flags").alias("minor"))
    return a.join(flags.sibling_ranks(nodes, major=True).select("uid", F.col("proper_flags").alias("major")), "uid")


@query(RERANKED.replace("THEN 'genus'", "THEN 'family'") + " SELECT l.uid, l.parent_uid, l.rank, a.rank AS parent_rank FROM l JOIN l a ON a.uid = l.parent_uid WHERE l.lv >= 0 AND a.lv >= 0 AND l.lv < a.lv")
def f6_rank_inversions(spark, d):
    nodes = _reranked(spark, d)
    return flags.rank_inversions(nodes.withColumn("rank", F.when((F.col("rank") == "genus") & F.col("uid").startswith("p"), "family").otherwise(F.col("rank"))))


