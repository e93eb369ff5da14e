"""Study trees: nested JSON documents of OTUs and trees, read as variants and exploded map by map (S-10, R-13).

The keys of the documents, ``^ot:`` ones included, are fixed values of the format.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.model import SOURCE_IDS
from grovespark.operators import tree
from grovespark.storage import settle


@dataclass(frozen=True)
class Studies:
    #: (study, tree, node, uid, parent_uid, name, rank, source_ids) of all nodes under the trees' roots; uid is study/tree/node.
    nodes: DataFrame
    #: (study, tree, root, ingroup): uids.
    trees: DataFrame
    #: (study, tree, node, problem).
    problems: DataFrame


def parsed(docs: DataFrame) -> DataFrame:
    """(study, v): ``docs`` (study, json) as variants; null where the text is no JSON."""
    return docs.select("study", F.try_parse_json("json").alias("v"))


def otus(docs: DataFrame) -> DataFrame:
    """(study, otu, label, mapped) of all groups of OTUs in ``docs`` (study, v); of one that stands in several groups the last counts."""
    found = docs.sparkSession.sql("""
        SELECT study, g.key AS grp, o.key AS otu, try_variant_get(o.value, "$['^ot:originalLabel']", 'string') AS label, try_variant_get(o.value, "$['^ot:ottId']", 'string') AS mapped
        FROM {docs}, LATERAL variant_explode(variant_get(v, '$.nexml.otusById')) g, LATERAL variant_explode(variant_get(g.value, '$.otuById')) o""", docs=docs)  # fmt: skip
    return found.groupBy("study", "otu").agg(F.max_by(F.struct("label", "mapped"), "grp").alias("o")).select("study", "otu", "o.*")


def trees(docs: DataFrame) -> DataFrame:
    """(study, tree, t): every tree of every group as JSON; of one that stands in several groups the last counts."""
    return docs.sparkSession.sql("""
        SELECT study, t.key AS tree, max_by(CAST(to_json(t.value) AS STRING), g.key) AS t
        FROM {docs}, LATERAL variant_explode(variant_get(v, '$.nexml.treesById')) g, LATERAL variant_explode(variant_get(g.value, '$.treeById')) t
        GROUP BY study, t.key""", docs=docs)  # fmt: skip


def read(docs: DataFrame, idspace: str = "ott") -> Studies:
    """All trees of ``docs`` (study, json), each study once.

    Tips take their OTU's label as name and its mapped id as source id of ``idspace``, unless they are marked as no exemplar of their taxon.
    Nodes that the root does not reach are no part of a tree, nor is anything of a tree without root. Where a node has several
    edges to it, the one from the smallest node counts.
    """
    spark = docs.sparkSession
    v = parsed(docs)
    all_trees = settle(trees(v)).withColumn("t", F.parse_json("t"))
    heads = spark.sql("""SELECT study, tree, nullif(try_variant_get(t, "$['^ot:rootNodeId']", 'string'), '') AS root, try_variant_get(t, "$['^ot:specifiedRoot']", 'string') AS specified,
        nullif(try_variant_get(t, "$['^ot:inGroupClade']", 'string'), '') AS ingroup FROM {t}""", t=all_trees)  # fmt: skip
    rows = spark.sql("""SELECT study, tree, n.key AS node, try_variant_get(n.value, "$['@otu']", 'string') AS otu, coalesce(try_variant_get(n.value, "$['^ot:isTaxonExemplar']", 'boolean'), true) AS exemplar
        FROM {t}, LATERAL variant_explode(variant_get(t, '$.nodeById')) n""", t=all_trees)  # fmt: skip
    edges = spark.sql("""SELECT study, tree, try_variant_get(e.value, "$['@target']", 'string') AS node, min(s.key) AS parent
        FROM {t}, LATERAL variant_explode(variant_get(t, '$.edgeBySourceId')) s, LATERAL variant_explode(s.value) e GROUP BY study, tree, 3""", t=all_trees)  # fmt: skip
    keys = ["study", "tree"]

    def uid(node: str):
        return F.when(F.col(node).isNotNull(), F.concat_ws("/", *keys, node))

    heads = settle(heads)
    linked = rows.join(edges, [*keys, "node"], "left").join(heads.select(*keys, "root"), keys)
    linked = linked.withColumn("parent", F.when(F.col("node") != F.col("root"), F.col("parent")))
    linked = settle(linked.select(*keys, "node", "otu", "exemplar", uid("node").alias("uid"), uid("parent").alias("parent_uid"), uid("root").alias("root_uid")))
    pathed = tree.with_children(tree.with_path(linked)).where(F.get("path", F.lit(0)) == F.col("root_uid"))
    labels = otus(v).withColumn("known", F.lit(True))
    tips = settle(pathed.join(labels, ["study", "otu"], "left").withColumn("tip", F.col("n_children") == 0))
    mapped = F.array(F.struct(F.lit(idspace).alias("prefix"), F.col("mapped").alias("id")))
    nodes = tips.select(*keys, "node", "uid", "parent_uid", F.when(F.col("tip"), F.col("label")).alias("name"), F.lit("no rank").alias("rank"), F.when(F.col("tip") & F.col("exemplar") & F.col("mapped").isNotNull(), mapped).otherwise(F.array()).cast(SOURCE_IDS).alias("source_ids"))

    wrong = F.when(F.col("tip") & F.col("otu").isNull(), "tip without OTU").when(F.col("tip") & F.col("known").isNull(), "OTU not found").when(F.col("tip") & F.col("label").isNull(), "tip without label")
    there = tips.select(*keys, F.col("node").alias("root"), F.lit(True).alias("there")).join(heads.select(*keys, "root"), [*keys, "root"], "left_semi")
    at = tips.select(*keys, F.col("node").alias("ingroup"), F.col("path").alias("in_path"))
    seen = heads.join(there, [*keys, "root"], "left").join(at, [*keys, "ingroup"], "left").withColumn("spec_uid", uid("specified"))
    other_root = F.col("there") & (F.coalesce("specified", "root") != F.col("root"))
    bad = F.array_compact(F.array(
        F.when(F.col("root").isNull(), "no root").when(F.col("there").isNull(), "root not found"), F.when(other_root, "specified root is not the root"),
        F.when(other_root & F.col("in_path").isNotNull() & ~F.array_contains("in_path", F.col("spec_uid")), "ingroup not under the specified root"),
    ))
    none = F.lit(None).cast("string")
    problems = tips.where(wrong.isNotNull()).select(*keys, "node", wrong.alias("problem")).union(seen.select(*keys, none, F.explode(bad))).union(v.where("v IS NULL").select("study", none, none, F.lit("no JSON")))
    found = seen.where("there").select(*keys, uid("root").alias("root"), F.when(F.col("in_path").isNotNull(), uid("ingroup")).alias("ingroup"))
    return Studies(nodes, found, problems)
