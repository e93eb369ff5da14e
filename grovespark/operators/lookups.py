"""Lookups by name and id, selections of nodes, and small checks over a taxonomy (P-*, A-20, A-25, R-8, I-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.functions import paths
from grovespark.model import Taxonomy
from grovespark.operators import tree


def by_id(ids: DataFrame, tax: Taxonomy) -> DataFrame:
    """(id, uid) of ``ids`` (id): the node of that id, or the one its alias leads to; null if there is none (P-3)."""
    nodes = tax.nodes.select("uid")
    aliases = tree.resolve_aliases(tax.aliases).select("id", F.col("replacement").alias("uid")).join(nodes, "uid", "left_semi")
    known = nodes.select(F.col("uid").alias("id"), "uid").union(aliases.select("id", "uid").join(nodes.select(F.col("uid").alias("id")), "id", "left_anti"))
    return ids.join(known, "id", "left").select("id", "uid")


def by_designator(wanted: DataFrame, tax: Taxonomy) -> DataFrame:
    """(designator, uid): the node of that name if exactly one has it, null if several do; an id only if no node has the name (P-2).

    Names are counted before they are joined, so a name with many nodes is one row.
    """
    names = tax.nodes.select("name", "uid").union(tax.synonyms.select("name", "uid")).where("name IS NOT NULL").distinct()
    one = names.groupBy("name").agg(F.count("*").alias("k"), F.min("uid").alias("named")).withColumnRenamed("name", "designator")
    found = by_id(wanted.select(F.col("designator").alias("id")).distinct(), tax).select(F.col("id").alias("designator"), F.col("uid").alias("own"))
    j = wanted.join(one, "designator", "left").join(found, "designator", "left")
    return j.select("designator", F.when(F.col("k") == 1, F.col("named")).when(F.col("k").isNull(), F.col("own")).alias("uid"))


def filter_by_ancestor(candidates: DataFrame, pathed: DataFrame) -> DataFrame:
    """The rows of ``candidates`` (uid, ancestor) whose node lies below the ancestor (P-6)."""
    below = pathed.select("uid", "path")
    return candidates.join(below, "uid").where((F.col("uid") != F.col("ancestor")) & F.array_contains("path", F.col("ancestor"))).drop("path")


def filter_by_descendant(candidates: DataFrame, pathed: DataFrame) -> DataFrame:
    """The rows of ``candidates`` (uid, descendant) whose node lies above the descendant (P-6)."""
    line = pathed.select(F.col("uid").alias("descendant"), "path")
    return candidates.join(line, "descendant").where((F.col("uid") != F.col("descendant")) & F.array_contains("path", F.col("uid"))).drop("path")


def ranks(nodes: DataFrame) -> DataFrame:
    """(rank, n, first) of every rank, with its smallest id (P-14)."""
    return nodes.groupBy("rank").agg(F.count("*").alias("n"), F.min("uid").alias("first"))


def with_names(ids: DataFrame, nodes: DataFrame) -> DataFrame:
    """``ids`` (uid, ...) with the node's name, null where there is none (P-15)."""
    return ids.join(nodes.select("uid", "name"), "uid", "left")


def single_source(nodes: DataFrame, prefix: str, wanted: DataFrame) -> DataFrame:
    """(uid, name) of the nodes that only ``prefix`` has and that are in ``wanted`` (uid) (P-16)."""
    only = nodes.where((F.size("source_ids") == 1) & (F.get("source_ids", F.lit(0))["prefix"] == prefix))
    return only.join(wanted.select("uid").distinct(), "uid", "left_semi").select("uid", "name")


def in_every_source(sources: dict[str, Taxonomy]) -> DataFrame:
    """(name, n) of the names, synonyms included, that every source has, and how many nodes have them (P-17)."""
    every = None
    for label, tax in sources.items():
        names = tax.nodes.select("name", "uid").union(tax.synonyms.select("name", "uid")).where("name IS NOT NULL").withColumn("source", F.lit(label))
        every = names if every is None else every.union(names)
    return every.groupBy("name").agg(F.count_distinct("source").alias("k"), F.count_distinct("source", "uid").alias("n")).where(F.col("k") == len(sources)).select("name", "n")


def coverage(nodes: DataFrame, used: DataFrame) -> DataFrame:
    """(prefix, n_used, n_all): of each source's ids, those of used nodes and all (A-20)."""
    ids = nodes.join(used.select("uid").distinct().withColumn("used", F.lit(1)), "uid", "left").select(F.explode("source_ids").alias("q"), "used")
    return ids.groupBy(F.col("q.prefix").alias("prefix")).agg(F.count("used").alias("n_used"), F.count("*").alias("n_all"))


def skeleton_check(skeleton: DataFrame, images: DataFrame, target: DataFrame) -> DataFrame:
    """(uid, problem) of skeleton nodes without an image (src, tgt), or whose image has no child (A-25)."""
    parents = target.select(F.col("parent_uid").alias("tgt")).where("tgt IS NOT NULL").distinct().withColumn("filled", F.lit(True))
    j = skeleton.select("uid").join(images.select(F.col("src").alias("uid"), "tgt"), "uid", "left").join(parents, "tgt", "left")
    problem = F.when(F.col("tgt").isNull(), "unmapped").when(F.col("filled").isNull(), "childless")
    return j.select("uid", problem.alias("problem")).where("problem IS NOT NULL")


def graft_counts(nodes: DataFrame) -> DataFrame:
    """(prefix, n): nodes whose first id is of a source that their parent's first id is not of: where each source was grafted on (M-13)."""
    origin = F.get("source_ids", F.lit(0))["prefix"]
    up = nodes.select(F.col("uid").alias("parent_uid"), origin.alias("above"))
    j = nodes.select("uid", "parent_uid", origin.alias("prefix")).join(up, "parent_uid").where("prefix IS NOT NULL AND NOT prefix <=> above")
    return j.groupBy("prefix").agg(F.count("*").alias("n"))


def space_sets(pathed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(under, above), each (uid, word, bits): the sources of a node's subtree, and those of its proper ancestors (U-4).

    A source is a bit: its number in the order of names, 63 to a word, so any number of sources fit. A set has a row for each word with a
    bit, and sets unite by ``bit_or``. A node's source is the prefix of its first id; without one it adds none. The sources' names, a row each, are
    numbered on the driver.
    """
    spark = pathed.sparkSession
    own = pathed.select("uid", "path", F.get("source_ids", F.lit(0))["prefix"].alias("prefix"))
    every = sorted(r["prefix"] for r in own.where("prefix IS NOT NULL").select("prefix").distinct().collect())
    bits = spark.createDataFrame([(p, i // 63, 1 << i % 63) for i, p in enumerate(every)], "prefix string, word int, bits bigint")
    set_ = own.join(F.broadcast(bits), "prefix")
    under = set_.select(F.explode("path").alias("uid"), "word", "bits").groupBy("uid", "word").agg(F.bit_or("bits").alias("bits"))
    up = own.select("uid", F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("anc"))
    above = up.join(set_.select(F.col("uid").alias("anc"), "word", "bits"), "anc").groupBy("uid", "word").agg(F.bit_or("bits").alias("bits"))
    return under, above


def grafts(pathed: DataFrame) -> DataFrame:
    """(uid, prefix, kind): nodes of another source than their parent's, each a ``graft``, or a ``resolution`` if a source of its
    subtree is also one of the parent's own ancestors (U-4)."""
    under, above = space_sets(pathed)
    origin = F.get("source_ids", F.lit(0))["prefix"]
    up = pathed.select(F.col("uid").alias("parent_uid"), origin.alias("up"))
    moved = pathed.select("uid", "parent_uid", origin.alias("prefix")).join(up, "parent_uid").where("NOT prefix <=> up")
    both = moved.join(under, "uid").join(above.select(F.col("uid").alias("parent_uid"), "word", F.col("bits").alias("seen")), ["parent_uid", "word"])
    meets = both.where(F.col("bits").bitwiseAND(F.col("seen")) != 0).select("uid").distinct().withColumn("meets", F.lit(True))
    return moved.join(meets, "uid", "left").select("uid", "prefix", F.when(F.col("meets"), "resolution").otherwise("graft").alias("kind"))


def unique_names(pathed: DataFrame) -> DataFrame:
    """(uid, unique_name): empty where no other node has the name; else the name with its rank and the ancestor that tells it apart (R-8).

    That is the deepest ancestor that no other node of the name has. In the order of paths the node that shares most of
    a path is next to it, so no pairs are made. Where that is the node itself, or one of the two lies above the other,
    the node's first id stands there. A node without a name has none.
    """
    many = pathed.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name")
    own = pathed.join(many, "name", "left_semi").select("uid", "name", "rank", "source_ids", "path")
    w = Window.partitionBy("name").orderBy("path")
    own = own.withColumns({"before": F.lag("path").over(w), "after": F.lead("path").over(w)})

    def shared(other: str) -> Column:
        return F.when(F.col(other).isNotNull(), paths.common_length("path", other)).otherwise(0)

    own = own.withColumn("n", F.greatest(shared("before"), shared("after"))).withColumn("ancestor", F.when(F.col("n") + 1 < F.size("path"), F.get("path", F.col("n"))))
    own = own.join(pathed.select(F.col("uid").alias("ancestor"), F.col("name").alias("ancestor_name")), "ancestor", "left")
    rank = F.when(F.col("rank") == "no rank", "").otherwise(F.concat("rank", F.lit(" ")))
    first = F.get("source_ids", F.lit(0))
    origin = F.coalesce(F.concat(first["prefix"], F.lit(":"), first["id"]), F.col("uid"))
    told = F.concat("name", F.lit(" ("), rank, F.when(F.col("ancestor").isNotNull(), F.concat(F.lit("in "), F.coalesce("ancestor_name", "ancestor"))).otherwise(origin), F.lit(")"))
    return pathed.select("uid").join(own.select("uid", told.alias("told")), "uid", "left").select("uid", F.coalesce("told", F.lit("")).alias("unique_name"))
