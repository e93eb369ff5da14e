"""Queries of divisions, homonym types, established names and dumps over the star tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.model import BIT
from grovespark.operators import align, divisions, establish, homonyms, merge, tree
from grovespark.plans.star import H2, H2_NODES, catalogue, suppliers, table
from grovespark.sources import dumps
from grovespark.storage import scratch, settle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def skeleton_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The root, the brands, and below them the groups of STANDARD types."""
    nodes = catalogue(spark, d).nodes
    return nodes.where("uid = 'life' OR uid LIKE 'b:%' OR (uid LIKE 'g:%' AND name LIKE '% STANDARD %')").select("uid", "parent_uid", "name", "rank")


#: Parts of H3 and the parts of H2 that are left (each tenth is not) with their name; standard ones lie in a division below their brand.
APART = """WITH p AS (SELECT p_brand AS b, p_name AS nm, p_partkey AS k, p_type LIKE 'STANDARD %' AS std FROM part), t AS (SELECT * FROM p WHERE k % 10 <> 0),
n AS (SELECT nm, count(*) AS c0 FROM t GROUP BY nm),
i AS (SELECT nm, b, count(*) AS c, count(*) FILTER (NOT std) AS plain, min(k) AS one, min(k) FILTER (NOT std) AS one_plain FROM t GROUP BY nm, b),
x AS (SELECT p.*, p.k % 10 <> 0 AS here, c0, coalesce(c, 0) AS c, coalesce(plain, 0) AS plain, one, one_plain FROM p JOIN n USING (nm) LEFT JOIN i USING (nm, b) WHERE p.k % 20 <> 0),
y AS (SELECT 'p' || k AS src, CASE
    WHEN c = 0 THEN ['-3', 'rejected', NULL] WHEN c0 = 1 THEN ['3', 'confirmed', 'p' || one] WHEN c = 1 THEN ['3', 'disjoint divisions', 'p' || one]
    WHEN plain = 0 THEN ['-1', 'rejected', NULL] WHEN plain = 1 AND c > 1 THEN ['3', 'same-division-weak', 'p' || one_plain]
    WHEN here AND NOT std THEN ['2', 'by source id', 'p' || k] ELSE ['0', 'ambiguous tip', NULL] END AS a FROM x)"""


@query(APART + """ SELECT src, a[3] AS tgt, CAST(a[1] AS INT) AS value, a[2] AS reason FROM y
UNION ALL SELECT 'p' || k, 'p' || (k - 1), 3, 'curated' FROM p WHERE k % 20 = 0 UNION ALL SELECT DISTINCT 'b:' || b, 'b:' || b, 3, 'by division name' FROM p UNION ALL SELECT 'life', 'life', 3, 'by division name'""")
def j15_align_in_divisions(spark, d):
    """H3 aligned to H2 without each tenth part, in divisions: brands keep homonyms apart, a division below the brand counts
    against a candidate, and each twentieth part has a curated answer."""
    src, tgt = catalogue(spark, d, by_size=True), catalogue(spark, d, drop_tenth=True)
    nodes = skeleton_nodes(spark, d)
    images = tgt.nodes.join(nodes.select("uid"), "uid", "left_semi").select(F.col("uid").alias("src"), F.col("uid").alias("tgt"))
    k = F.col("p_partkey")
    curated = table(spark, d, "part").where(k % 20 == 0).select(F.concat(F.lit("p"), k.cast("string")).alias("src"), F.concat(F.lit("p"), (k - 1).cast("string")).alias("tgt"))
    return align.align(src, tgt, curated=curated, skeleton=divisions.skeleton(nodes, images)).select("src", "tgt", "value", "reason")


@query(f"""WITH {H2_NODES}, s AS (SELECT uid FROM n WHERE uid = 'life' OR uid LIKE 'b:%' OR (uid LIKE 'g:%' AND name LIKE '% STANDARD %')),
d AS (SELECT n.uid, n.uid IN (SELECT uid FROM s) AS bare, CASE WHEN n.uid IN (SELECT uid FROM s) THEN n.uid WHEN n.parent_uid IN (SELECT uid FROM s) THEN n.parent_uid ELSE u.parent_uid END AS division FROM n LEFT JOIN n u ON n.parent_uid = u.uid)
SELECT division, CASE WHEN bare THEN 'skeleton' ELSE 'source' END AS made_by, count(*) AS n FROM d GROUP BY 1, 2""")
def m14_skeleton(spark, d):
    """H2 merged into a union that begins as its skeleton: the nodes of each division, and whether the skeleton or the source made them."""
    nodes, h2 = skeleton_nodes(spark, d), catalogue(spark, d)
    union, skel = divisions.set_skeleton(h2.with_nodes(h2.nodes.where("false")), nodes)
    merged = merge.merge(h2, union, align.align(h2, union, skeleton=skel))
    borne = divisions.of_side(skel, skel.images.select(F.col("tgt").alias("uid"), F.col("src").alias("division")))
    found = tree.with_division(tree.with_path(merged.union.nodes), borne).withColumnRenamed("division", "bearer").join(borne.select(F.col("uid").alias("bearer"), "division"), "bearer", "left")
    old = union.nodes.select("uid", F.lit("skeleton").alias("made_by"))
    return found.join(old, "uid", "left").groupBy("division", F.coalesce("made_by", F.lit("source")).alias("made_by")).agg(F.count("*").alias("n"))


#: H2 with each eleventh part hidden and each seventh part, and each group, under the name of the part or of a part before it as well.
TYPES = H2 + """, v AS (SELECT * FROM t WHERE NOT coalesce(uid LIKE 'p%' AND TRY_CAST(substr(uid, 2) AS BIGINT) % 11 = 0, false)),
c AS (SELECT x AS uid, count(*) AS cnt FROM (SELECT unnest(path) AS x FROM t) GROUP BY x),
s AS (SELECT 'p' || a.p_partkey AS uid, b.p_name AS name FROM part a JOIN part b ON b.p_partkey = a.p_partkey - 1 WHERE a.p_partkey % 7 = 0
  UNION SELECT 'g:' || p_brand || ':' || p_type, max(p_name) FROM part GROUP BY p_brand, p_type),
e AS (SELECT DISTINCT q.name, v.uid, v.name = q.name AS main, path, depth, cnt FROM (SELECT uid, name FROM n UNION SELECT * FROM s) q JOIN v USING (uid) JOIN c USING (uid)),
d AS (SELECT a.name, a.uid AS u1, b.uid AS u2, a.main AS m1, b.main AS m2, a.path AS p1, b.path AS p2, a.depth AS d1, b.depth AS d2, greatest(a.cnt, b.cnt) AS big,
    CASE WHEN a.depth >= 3 AND b.depth >= 3 AND a.path[3] = b.path[3] THEN 3 WHEN a.depth >= 2 AND b.depth >= 2 AND a.path[2] = b.path[2] THEN 2 ELSE 1 END AS common FROM e a JOIN e b ON a.name = b.name AND a.uid < b.uid),
w AS (SELECT d.*, x.cnt + y.cnt AS both_ FROM d LEFT JOIN c x ON x.uid = p1[common + 1] LEFT JOIN c y ON y.uid = p2[common + 1])"""


@query(TYPES + """ SELECT name, p1[common] AS mrca, CASE WHEN common < least(d1, d2) AND d1 = common + 1 AND d2 = common + 1 THEN 'siblings' WHEN NOT m1 AND NOT m2 THEN 'synonyms'
    WHEN common = 1 AND least(d1, d2) > 1 AND p1[2] < 'b:Brand#3' AND p2[2] < 'b:Brand#3' THEN 'divisions' WHEN common = least(d1, d2) THEN 'nested' WHEN d1 = common + 1 OR d2 = common + 1 THEN 'lineage' WHEN big > 2 THEN 'internal'
    WHEN NOT m1 OR NOT m2 THEN 'tip-synonym' WHEN both_ < 10 THEN 'tip-duplicate' WHEN both_ < 290 THEN 'tip-suspect' ELSE 'tip-true' END AS type, count(*) AS n FROM w GROUP BY 1, 2, 3""")
def a10_homonym_types(spark, d):
    """Types of the homonyms of H2, with synonyms, hidden parts, and brands that are divisions; limits of sizes fit the small clades of the catalogue."""
    h2 = catalogue(spark, d).nodes
    key = F.when(F.col("uid").startswith("p"), F.substring("uid", 2, 20).cast("long"))
    p = settle(tree.with_children(tree.with_path(h2.withColumn("proper_flags", F.when(key % 11 == 0, BIT["hidden"]).otherwise(F.col("proper_flags"))))))
    part = table(spark, d, "part")
    before = part.select((F.col("p_partkey") + 1).alias("k"), F.col("p_name").alias("name"))
    lower = part.where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("k")).join(before, "k").select(F.concat(F.lit("p"), F.col("k").cast("string")).alias("uid"), "name")
    groups = part.groupBy(F.concat(F.lit("g:"), "p_brand", F.lit(":"), "p_type").alias("uid")).agg(F.max("p_name").alias("name"))
    return homonyms.types(p, lower.union(groups), settle(tree.subtree_counts(p)), p.where("uid LIKE 'b:%' AND uid < 'b:Brand#3'"), suspect=10, true=290)


def establish_requests(spark: SparkSession, d: str) -> DataFrame:
    """REQUEST rows: customers in chains of up to ten, each below the one before; then each seventh again, by the root's name; each
    thirteenth under a parent that nobody knows, beside its nation; and suppliers by id, each fifth by the id of another."""
    c, n, s = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "supplier")
    none, k = F.lit(None).cast("string"), F.col("c_custkey").cast("long")
    named = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")
    before = c.select((F.col("c_custkey") + 1).alias("c_custkey"), F.col("c_name").alias("before"))
    first = named.join(before, "c_custkey", "left").select(k.alias("pos"), F.col("c_name").alias("name"), F.lit("genus").alias("rank"), F.when(k % 10 == 0, F.col("n_name")).otherwise(F.coalesce("before", "n_name")).alias("parent"), none.alias("ancestor"), none.alias("division"), none.alias("id"), F.struct(F.lit("tpch").alias("prefix"), k.cast("string").alias("id")).alias("source"))
    nothing = F.lit(None).cast("struct<prefix:string,id:string>")
    again = c.where(k % 7 == 0).select((k + 1_000_000_000).alias("pos"), "c_name", none, F.lit("nowhere"), F.lit("life"), none, none, nothing)
    beside = named.where(k % 13 == 0).select((k + 2_000_000_000).alias("pos"), F.concat(F.lit("beside "), "c_name"), none, F.lit("nowhere"), none, F.col("n_name"), none, nothing)
    key = F.col("s_suppkey").cast("long")
    known = s.select((key + 3_000_000_000).alias("pos"), "s_name", none, none, F.lit("life"), none, F.when(key % 5 == 0, F.concat(F.lit("s"), (key + 1).cast("string"))).otherwise(F.concat(F.lit("s"), key.cast("string"))), nothing)
    return first.union(again).union(beside).union(known)


@query("""WITH c AS (SELECT c_custkey AS k, c_nationkey AS nk, 'established-' AS e FROM customer),
r AS (SELECT k AS pos, 'created' AS outcome, e || k AS uid, CASE WHEN k % 10 = 0 OR k = (SELECT min(k) FROM c) THEN 'n' || nk ELSE e || (k - 1) END AS parent_uid, 0 AS proper_flags FROM c
UNION ALL SELECT k + 1000000000, 'found', e || k, CASE WHEN k % 10 = 0 OR k = (SELECT min(k) FROM c) THEN 'n' || nk ELSE e || (k - 1) END, 0 FROM c WHERE k % 7 = 0
UNION ALL SELECT k + 2000000000, 'created', e || (k + 2000000000), 'n' || nk, 64 FROM c WHERE k % 13 = 0
UNION ALL SELECT s_suppkey + 3000000000, CASE WHEN s_suppkey % 5 = 0 THEN 'conflict' ELSE 'found' END, CASE WHEN s_suppkey % 5 <> 0 THEN 's' || s_suppkey END, CASE WHEN s_suppkey % 5 <> 0 THEN 'n' || s_nationkey END, 0 FROM supplier)
SELECT * FROM r""")
def m25_establish(spark, d):
    """Requests against the suppliers' tree, with the node of each and where it lies."""
    got = establish.establish(suppliers(spark, d), establish_requests(spark, d))
    where = got.tax.nodes.select("uid", "parent_uid", "proper_flags")
    return got.outcomes.join(where, "uid", "left").select("pos", "outcome", "uid", "parent_uid", F.coalesce("proper_flags", F.lit(0)).alias("proper_flags"))


def dump_lines(spark: SparkSession, d: str) -> DataFrame:
    """Parts as lines of a dump: each has one or two ids; some are of another class and some are cut off."""
    k = F.col("p_partkey")
    key = k.cast("string")

    def claim(value):
        return F.concat(F.lit('{"mainsnak":{"datavalue":{"value":'), value, F.lit("}}}"))

    def text(value):
        return claim(F.concat(F.lit('"'), value, F.lit('"')))

    taxon = claim(F.lit('{"entity-type":"item","numeric-id":16521}'))
    classes = F.when(k % 4 == 1, F.concat(F.lit('"P31":['), claim(F.lit('{"numeric-id":5}')), F.lit('],"P9":['), taxon, F.lit("]"))).otherwise(F.concat(F.lit('"P31":[{"mainsnak":{}},'), taxon, F.lit("]")))
    numbers = F.when(k % 22 == 0, F.concat_ws(",", text(key), text((k + 1).cast("string")))).when(k % 2 == 0, text(key)).otherwise("")
    page = F.when(k % 6 == 0, F.concat(F.lit(',"P830":['), text(F.concat(F.lit("E"), key)), F.lit("]"))).otherwise("")
    site = F.when(k % 5 == 0, F.concat(F.lit(',"sitelinks":{"enwiki":{"title":"'), F.col("p_name"), F.lit('"}}'))).otherwise("")
    line = F.concat(F.lit('{"type":"item","id":"Q'), key, F.lit('","claims":{'), classes, F.lit(',"P685":['), numbers, F.lit('],"P846":['), text(F.concat(F.lit("x"), key)), F.lit("]"), page, F.lit("}"), site, F.lit("},"))
    return table(spark, d, "part").select(F.when(k % 50 == 0, F.regexp_replace(line, "..$", "")).otherwise(line).alias("line"))


@query("""WITH k AS (SELECT p_partkey AS k, p_name, 'Q' || p_partkey AS item, CASE WHEN p_partkey % 6 = 0 THEN 'E' || p_partkey END AS page, CASE WHEN p_partkey % 5 = 0 THEN p_name END AS title_enwiki FROM part WHERE p_partkey % 50 <> 0 AND p_partkey % 4 <> 1)
SELECT 'p' || k AS uid, item, page, title_enwiki FROM k WHERE k % 2 = 0 OR k % 7 = 0
UNION ALL SELECT 'p' || (k + 1), item, page, title_enwiki FROM k WHERE k % 22 = 0 AND k + 1 IN (SELECT p_partkey FROM part)""")
def s28_dump(spark, d):
    """A dump written from the parts and read as text, against their nodes: every part has a number, each third by way of silva, each seventh another id."""
    folder = scratch(spark, "dump")
    dump_lines(spark, d).write.text(folder)
    k = F.substring("uid", 2, 20).try_cast("long")

    def qid(prefix: str, value):
        return F.struct(F.lit(prefix).alias("prefix"), value.alias("id"))

    own = F.concat(F.array(qid("ncbi", k.cast("string"))), F.when(k % 3 == 0, F.array(qid("silva", F.concat(F.lit("S"), k.cast("string"))))).otherwise(F.array()), F.when(k % 7 == 0, F.array(qid("gbif", F.concat(F.lit("x"), k.cast("string"))))).otherwise(F.array()))
    nodes = catalogue(spark, d).nodes.where("uid LIKE 'p%'").withColumn("source_ids", own)
    return dumps.scan(spark.read.text(folder).withColumnRenamed("value", "line"), nodes, ["enwiki"]).links
