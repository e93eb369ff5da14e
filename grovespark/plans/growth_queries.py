"""Queries of additions, study trees, conflicts and evidence over the star tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.functions import codecs
from grovespark.operators import additions, conflict, homonyms, lookups, tree
from grovespark.plans.star import H2, catalogue, geography, suppliers, table
from grovespark.sources import studies
from grovespark.storage import scratch, settle
from grovespark.streaming import additions as stream

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def requests(spark: SparkSession, d: str) -> DataFrame:
    """A document for each customer: the customer under its nation (keys up to 25) or under the customer of half its
    key, and under it its orders, named by their days. Each tenth document comes from the old release's own hand; orders of status P
    have a parent that nobody knows."""
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    text, none = "string", F.lit(None).cast("string")
    key = F.col("c_custkey").cast(text)
    up = F.when(F.col("c_custkey") <= 25, F.concat(F.lit("n"), F.col("c_nationkey").cast(text))).otherwise(F.concat(F.lit("c"), F.floor(F.col("c_custkey") / 2).cast(text)))
    sources = F.array(F.struct(F.lit("tpch").alias("source")))
    first = c.select("c_custkey", F.struct(F.lit("c").alias("tag"), F.concat(F.lit("c"), key).alias("ott_id"), F.col("c_name").alias("name"), up.alias("parent"), none.alias("parent_tag"), F.lit("genus").alias("rank"), sources.alias("sources")).alias("t"))
    lost = F.col("o_orderstatus") == "P"
    row = F.struct(F.concat(F.lit("o"), F.col("o_orderkey").cast(text)).alias("tag"), F.concat(F.lit("o"), F.col("o_orderkey").cast(text)).alias("ott_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("name"), F.when(lost, "nobody").alias("parent"), F.when(~lost, "c").alias("parent_tag"), F.lit("species").alias("rank"), sources.alias("sources"))
    rest = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sort_array(F.collect_list(F.struct("o_orderkey", row.alias("t")))).alias("rest"))
    taxa = F.concat(F.array("t"), F.coalesce(F.col("rest.t"), F.array().cast("array<struct<tag:string,ott_id:string,name:string,parent:string,parent_tag:string,rank:string,sources:array<struct<source:string>>>>")))
    agent = F.when(F.col("c_custkey") % 10 == 0, additions.ORIGINAL).otherwise("curator")
    return first.join(rest, "c_custkey", "left").select(F.concat(F.lit("additions-"), key).alias("id"), agent.alias("user_agent"), taxa.alias("taxa"))


#: Customers whose line of halves has none of the old release; each with its nation. Then the rows as the log has them.
ADDED = """WITH RECURSIVE kept AS (SELECT c_custkey AS k, c_nationkey AS division FROM customer WHERE c_custkey <= 25 AND c_custkey % 10 <> 0
  UNION ALL SELECT c.c_custkey, p.division FROM customer c JOIN kept p ON p.k = c.c_custkey // 2 WHERE c.c_custkey > 25 AND c.c_custkey % 10 <> 0),
o AS (SELECT o_custkey AS k, o_orderkey AS ok, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS status, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos FROM orders),
named AS (SELECT *, arg_min(ok, (k, pos)) OVER (PARTITION BY day, division) AS first FROM o JOIN kept USING (k) WHERE status <> 'P')
SELECT 'additions-' || k AS doc, pos, 'o' || ok AS tag, CASE WHEN ok = first THEN 'added' ELSE 'matched' END AS outcome, 'o' || first AS target FROM named
UNION ALL SELECT 'additions-' || k, pos, 'o' || ok, 'parent not found', NULL FROM o WHERE ok NOT IN (SELECT ok FROM named)
UNION ALL SELECT 'additions-' || c_custkey, 0, 'c', CASE WHEN kept.k IS NOT NULL THEN 'added' WHEN c_custkey % 10 = 0 AND (c_custkey <= 25 OR c_custkey // 2 IN (SELECT k FROM kept)) THEN 'deprecated' ELSE 'parent not found' END, CASE WHEN kept.k IS NOT NULL THEN 'c' || c_custkey END FROM customer LEFT JOIN kept ON kept.k = c_custkey"""


def _known(spark: SparkSession, d: str) -> additions.Known:
    tax = suppliers(spark, d)
    return additions.known(tax, tax.nodes.where("rank = 'order'").select("uid"))


@query(ADDED)
def i7_additions(spark, d):
    """All requests at once, as if one after another."""
    return additions.apply(additions.log_rows(requests(spark, d)), _known(spark, d)).outcomes


@query(ADDED)
def i7_additions_stream(spark, d):
    """The same as JSON files that arrive in the wrong order: those on which all others hang come last."""
    folder = scratch(spark, "additions")
    docs = requests(spark, d).withColumn("key", F.substring_index("id", "-", -1).cast("int"))

    def run(some: DataFrame) -> None:
        some.drop("key").write.mode("append").json(f"{folder}/in")
        stream.add_documents(stream.read_documents(spark, f"{folder}/in"), have, f"{folder}/state", f"{folder}/log").awaitTermination()

    have = _known(spark, d)
    run(docs.where("key > 25"))
    run(docs.where("key <= 25"))
    waiting = stream.state(spark, f"{folder}/state", "waiting")
    # Those that still wait when the stream ends wait for nobody.
    never = waiting.select(F.col("at.doc").alias("doc"), F.col("at.pos").alias("pos"), "tag", F.lit("parent not found").alias("outcome"), F.lit(None).cast("string").alias("target"))
    return stream.state(spark, f"{folder}/state", "outcomes").union(never)


def study_documents(spark: SparkSession, d: str) -> DataFrame:
    """(study, json) written as text, a line each: for each customer a tree of its orders by priority. Household customers have no root,
    orders of status P no label, those of status F are no exemplars."""
    o = table(spark, d, "orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("study"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("tip"), F.concat(F.lit("p"), "o_orderpriority").alias("inner"), "o_orderkey", "o_orderstatus", "o_orderdate")
    tip = F.struct(F.col("tip").alias("@otu"), F.when(F.col("o_orderstatus") == "F", False).alias("^ot:isTaxonExemplar"))
    none = F.struct(F.lit(None).cast("string").alias("@otu"), F.lit(None).cast("boolean").alias("^ot:isTaxonExemplar"))
    label = F.struct(F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("^ot:originalLabel"), F.col("o_orderkey").alias("^ot:ottId"))

    def edge(a, b):
        return F.struct(a.alias("@source"), b.alias("@target"))

    def entry(key, value):
        return F.struct(key.alias("key"), value.alias("value"))

    def keyed(key, value):
        return F.map_from_entries(F.collect_list(entry(key, value)))

    def flat(entries):
        return F.flatten(F.collect_list(F.map_entries(entries)))

    inner = o.groupBy("study", "inner").agg(keyed(F.col("tip"), tip).alias("nodes"), keyed(F.col("tip"), label).alias("otus"), keyed(F.concat(F.lit("e"), "tip"), edge(F.col("inner"), F.col("tip"))).alias("edges"))
    whole = inner.groupBy("study").agg(
        F.map_concat(F.map_from_entries(flat("nodes")), keyed(F.col("inner"), none), F.create_map(F.lit("r"), none)).alias("nodes"), F.map_from_entries(flat("otus")).alias("otus"),
        F.map_concat(keyed(F.col("inner"), F.col("edges")), F.create_map(F.lit("r"), keyed(F.concat(F.lit("e"), "inner"), edge(F.lit("r"), F.col("inner"))))).alias("edges"),
    )
    root = table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("study"), F.when(F.col("c_mktsegment") == "HOUSEHOLD", "").otherwise("r").alias("root"))
    one = F.struct(F.col("nodes").alias("nodeById"), F.col("edges").alias("edgeBySourceId"), F.col("root").alias("^ot:rootNodeId"), F.lit("r").alias("^ot:inGroupClade"))
    nexml = F.struct(F.create_map(F.lit("g"), F.struct(F.col("otus").alias("otuById"))).alias("otusById"), F.create_map(F.lit("ts"), F.struct(F.create_map(F.lit("t"), one).alias("treeById"))).alias("treesById"))
    path = scratch(spark, "studies")
    whole.join(root, "study").select(F.concat("study", F.lit("\t"), F.to_json(F.struct(nexml.alias("nexml"))))).write.text(path)
    line = spark.read.text(path)
    return line.select(F.substring_index("value", "\t", 1).alias("study"), F.expr("substr(value, instr(value, '\t') + 1)").alias("json"))


STUDIES = """WITH o AS (SELECT 'c' || o_custkey AS study, * FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'HOUSEHOLD')"""


@query(STUDIES + """ SELECT DISTINCT study || '/t/r' AS uid, CAST(NULL AS VARCHAR) AS parent_uid, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS qid FROM o
UNION ALL SELECT DISTINCT study || '/t/p' || o_orderpriority, study || '/t/r', NULL, NULL FROM o
UNION ALL SELECT study || '/t/o' || o_orderkey, study || '/t/p' || o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END, CASE WHEN o_orderstatus <> 'F' THEN 'ott:' || o_orderkey END FROM o""")
def s10_study_trees(spark, d):
    """Nested study documents, written and read again: nodes with labels and mapped ids."""
    got = studies.read(study_documents(spark, d)).nodes
    return got.select("uid", "parent_uid", "name", codecs.print_qid(F.get("source_ids", F.lit(0))).alias("qid"))


@query("""SELECT 'tip without label' AS problem, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'HOUSEHOLD' AND o_orderstatus = 'P' HAVING count(*) > 0
UNION ALL SELECT 'no root', count(DISTINCT o_custkey) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'HOUSEHOLD' HAVING count(*) > 0""")
def r13_study_problems(spark, d):
    """What the reader finds wrong in the same documents."""
    return studies.read(study_documents(spark, d)).problems.groupBy("problem").agg(F.count("*").alias("n"))


#: Homonymous parts of H2 by the two clades below their common one: a pair's smaller side (then smaller uid) loses.
PARTED = H2 + """, s AS (SELECT u AS uid, count(*) AS n FROM (SELECT unnest(path) AS u FROM t) GROUP BY u),
y AS (SELECT a.name, CASE WHEN a.path[2] <> b.path[2] THEN 2 WHEN a.path[3] <> b.path[3] THEN 3 ELSE 4 END AS i, a.path AS pa, b.path AS pb FROM t a JOIN t b ON a.name = b.name AND a.uid < b.uid),
z AS (SELECT name, pa[i - 1] AS mrca, least({'n': x.n, 'u': pa[i]}, {'n': w.n, 'u': pb[i]}) AS small, greatest({'n': x.n, 'u': pa[i]}, {'n': w.n, 'u': pb[i]}) AS big FROM y JOIN s x ON x.uid = pa[i] JOIN s w ON w.uid = pb[i]),
r AS (SELECT z.name, mrca, small.u AS loser, small.n AS low, h.n AS high, max(max(big)) OVER (PARTITION BY z.name, mrca) AS larger, count(*) AS pairs FROM z JOIN s h ON h.uid = mrca GROUP BY ALL)"""


def _parted(spark, d):
    tax = catalogue(spark, d)
    pathed = settle(tree.with_children(tree.with_path(tax.nodes)))
    counts = settle(tree.subtree_counts(pathed))
    return homonyms.partings(pathed, tax.synonyms, counts), counts


@query(PARTED.replace("h.n AS high, max(max(big)) OVER (PARTITION BY z.name, mrca) AS larger, count(*) AS pairs FROM z JOIN s h ON h.uid = mrca GROUP BY ALL)", "h.n AS high, count(*) AS pairs FROM z JOIN s h ON h.uid = mrca GROUP BY ALL), g AS (SELECT name, mrca, max(big).u AS larger FROM z GROUP BY ALL)")
       + """, w AS (SELECT CAST(ceil(count(*) / 100.0) AS BIGINT) AS width FROM t), f AS (SELECT (low - 1) // width AS bucket, sum(pairs) AS pairs, min({'name': name, 'larger': larger}) AS first FROM r JOIN g USING (name, mrca), w GROUP BY 1)
SELECT b AS bucket, b * width AS start, CAST(coalesce(pairs, 0) AS BIGINT) AS primary, CAST(coalesce(pairs, 0) AS BIGINT) AS pairs, CAST(coalesce(pairs, 0) AS BIGINT) AS tips, first.name AS sample, first.larger AS division FROM range(50) q(b) JOIN w ON true LEFT JOIN f ON f.bucket = b""")
def a8_homonym_density(spark, d):
    """Homonym pairs of H2 by the size of the smaller side: half of 100 buckets."""
    return homonyms.density(*_parted(spark, d))


@query(PARTED.replace(", max(max(big)) OVER (PARTITION BY z.name, mrca) AS larger", "") + """, k AS (SELECT low, high, sum(pairs) AS p FROM r GROUP BY ALL),
u AS (SELECT low, high, coalesce(sum(p) OVER (ORDER BY -low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + coalesce(sum(p) OVER (ORDER BY high, -low ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS doubt FROM k)
SELECT name, low, high, loser, mrca, pairs, CAST(doubt AS BIGINT) AS doubt FROM r JOIN u USING (low, high)""")
def a9_homonym_uncertainty(spark, d):
    """Where the homonyms of H2 part, by how hard it is to tell them apart."""
    return homonyms.uncertainty(_parted(spark, d)[0])


def brand_trees(spark: SparkSession, d: str) -> DataFrame:
    """A tree for each brand of H2 and one of H3, as ``conflict.compare_pairs`` wants them."""
    def cut(kind: str, by_size: bool) -> DataFrame:
        n = catalogue(spark, d, by_size=by_size).nodes.where("uid <> 'life'")
        up = n.where("rank = 'genus'").select(F.col("uid").alias("parent_uid"), F.col("parent_uid").alias("top"))
        top = F.when(F.col("rank") == "family", F.col("uid")).when(F.col("rank") == "genus", F.col("parent_uid")).otherwise(F.col("top"))
        parent = F.when(F.col("rank") != "family", F.col("parent_uid"))
        return n.join(up, "parent_uid", "left").select(F.concat(F.lit(f"{kind}/"), top).alias("tree"), "uid", parent.alias("parent_uid"), "name", F.when(F.col("rank") == "species", F.col("uid")).alias("key"), F.lit(False).alias("ingroup"))

    return cut("h2", False).union(cut("h3", True))


#: One side of a brand's pair: parts by their own group and the other tree's, with the sizes of both.
_SIDE = """SELECT '{kind}' AS kind, 'b:' || p_brand AS root, p_brand AS brand, 'p' || p_partkey AS k, p_name AS nm, 'g:' || p_brand || ':' || {own} AS g, 'g:' || p_brand || ':' || {other} AS o, p_brand || ' ' || {other} AS o_name FROM part"""
_TYPE, _SIZE = "p_type", "'size ' || CAST(floor(p_size / 10) AS BIGINT)"


@query(f"""WITH e AS ({_SIDE.format(kind='h2', own=_TYPE, other=_SIZE)} UNION ALL {_SIDE.format(kind='h3', own=_SIZE, other=_TYPE)}),
x AS (SELECT *, count(*) OVER (PARTITION BY kind, g) AS ng, count(*) OVER (PARTITION BY kind, o) AS no, count(*) OVER (PARTITION BY kind, g, o) AS n2 FROM e),
z AS (SELECT kind, root, count(DISTINCT g) AS mine, count(DISTINCT o) AS theirs FROM e GROUP BY ALL),
q AS (SELECT kind, root, k AS uid, CASE WHEN ng = 1 THEN 'partial_path_of' ELSE 'supported_by' END AS status, CASE WHEN no = 1 THEN o ELSE k END AS witness, CASE WHEN no = 1 THEN o_name ELSE nm END AS witness_name FROM x
  UNION ALL SELECT kind, root, root, 'supported_by', root, brand FROM x GROUP BY ALL
  UNION ALL SELECT kind, root, g, CASE WHEN count(*) = 1 THEN 'partial_path_of' WHEN count(DISTINCT o) > 1 AND bool_or(n2 < no) THEN 'conflicts_with' WHEN count(DISTINCT o) = 1 AND min(no) = count(*) THEN 'supported_by' ELSE 'resolves' END,
    CASE WHEN count(*) = 1 THEN CASE WHEN min(no) = 1 THEN min(o) ELSE min(k) END WHEN count(DISTINCT o) = 1 THEN min(o) WHEN bool_or(n2 < no) THEN min(o) FILTER (n2 < no) ELSE root END,
    CASE WHEN count(*) = 1 THEN CASE WHEN min(no) = 1 THEN min(o_name) ELSE min(nm) END WHEN count(DISTINCT o) = 1 THEN min(o_name) WHEN bool_or(n2 < no) THEN min(o_name) FILTER (n2 < no) ELSE any_value(brand) END FROM x GROUP BY kind, root, g)
SELECT kind || '/' || root AS pair, uid, theirs < mine AS flipped, '{{"status":"' || status || '","witness":"' || witness || '","witness_name":"' || witness_name || '"}}' AS info FROM q JOIN z USING (kind, root)""")
def c8_compare_pairs(spark, d):
    """Each brand's tree of H2 against that of H3 and the other way round, in one plan."""
    trees = brand_trees(spark, d)
    tops = trees.where("parent_uid IS NULL").select("uid").distinct()
    two = [tops.select(F.concat(F.lit(f"{x}/"), "uid").alias("pair"), F.concat(F.lit(f"{x}/"), "uid").alias("first"), F.concat(F.lit(f"{y}/"), "uid").alias("second")) for x, y in (("h2", "h3"), ("h3", "h2"))]
    return conflict.compare_pairs(two[0].union(two[1]), trees)


@query("""WITH s AS (SELECT c_custkey AS k, c_mktsegment || ' ' || c_nationkey AS prefix, bool_or(o_orderstatus <> 'F') AS meets FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT 'c' || k AS uid, prefix, CASE WHEN meets THEN 'resolution' ELSE 'graft' END AS kind FROM s
UNION ALL SELECT 'o' || o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'tpch' END, CASE WHEN o_orderstatus = 'F' THEN 'graft' ELSE 'resolution' END FROM orders""")
def u4_grafts(spark, d):
    """A geography whose customers come from a source for each segment and nation (125), and finished orders from one for each priority."""
    nodes = geography(spark, d).nodes
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("uid"), F.concat_ws(" ", "c_mktsegment", "c_nationkey").alias("own"))
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("o"), "o_orderkey").alias("uid"), F.col("o_orderpriority").alias("own"))
    first = F.array(F.struct(F.col("own").alias("prefix"), F.col("uid").alias("id")))
    mixed = nodes.join(c.union(o), "uid", "left").withColumn("source_ids", F.when(F.col("own").isNotNull(), first).otherwise(F.col("source_ids")))
    return lookups.grafts(settle(tree.with_path(mixed)))
