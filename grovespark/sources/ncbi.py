"""A whole import of nodes, names and merged ids in bar-separated dumps (S-16)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.model import Taxonomy, taxonomy
from grovespark.operators import tree
from grovespark.sources.importers import dump_fields
from grovespark.storage import settle

#: Fixed values of the format: the class of a node's name, the one that isn't read, the root's name, and the name told apart by the parent's.
SCIENTIFIC, IN_PART, ROOT, SAMPLES = "scientific name", "in-part", "root", "environmental samples"


@dataclass(frozen=True)
class Imported:
    taxonomy: Taxonomy
    #: (uid, problem) of what the taxonomy leaves out: nodes on or below a ``cycle``, nodes with ``no scientific name``, and ids of names with ``no node``.
    problems: DataFrame


def load(spark: SparkSession, folder: str, skip: DataFrame, merged: bool = True) -> Imported:
    """The dump in ``folder``: ``nodes.dmp``, ``names.dmp`` and, if ``merged``, ``merged.dmp``; ``skip`` (uid)."""
    nodes, names = spark.read.text(f"{folder}/nodes.dmp"), spark.read.text(f"{folder}/names.dmp")
    return build(nodes, names, skip, spark.read.text(f"{folder}/merged.dmp") if merged else nodes.limit(0))


def _nodes(lines: DataFrame) -> DataFrame:
    """(uid, parent_uid, rank), each id once (of several rows the least). A parent without a row, or that is the node itself, is none."""
    rows = dump_fields(lines, "uid", "parent_uid", "rank").where("uid <> ''")
    once = rows.groupBy("uid").agg(F.min(F.struct("parent_uid", "rank")).alias("m")).select("uid", "m.*")
    there = once.select(F.col("uid").alias("parent_uid"), F.lit(True).alias("there"))
    up = F.when(F.col("there") & (F.col("parent_uid") != F.col("uid")), F.col("parent_uid"))
    return once.join(there, "parent_uid", "left").select("uid", up.alias("parent_uid"), F.coalesce("rank", F.lit("no rank")).alias("rank"))


def _homes(state: DataFrame) -> DataFrame:
    """(uid, home) of the nodes that don't stand: the nearest ancestor that does, null if there is none.

    Each such node points to its parent and no other node points anywhere, so a path's first node is the home; the paths
    are as long as chains of such nodes.
    """
    lost = state.where("fate IN ('sunk', 'nameless')").select("uid", "parent_uid")
    tops = lost.select(F.col("parent_uid").alias("uid")).where("uid IS NOT NULL").distinct().join(lost.select("uid"), "uid", "left_anti")
    found = tree.with_path(lost.union(tops.withColumn("parent_uid", F.lit(None).cast("string"))))
    first = found.join(lost.select("uid"), "uid", "left_semi").select("uid", F.get("path", F.lit(0)).alias("home"))
    bare = lost.where("parent_uid IS NULL").select(F.col("uid").alias("home"), F.lit(True).alias("bare"))
    return first.join(bare, "home", "left").select("uid", F.when(F.col("bare").isNull(), F.col("home")).alias("home"))


def _lineage_names(state: DataFrame) -> DataFrame:
    """(uid, told) of nodes with an ancestor, not the parent, of their name: the name, that ancestor's rank, then name and rank of each node from here up to it.

    The ancestor is the topmost below the last one that was renamed for its genus. Only nodes with such an ancestor meet all of their line.
    """
    stands = state.where("fate IN ('kept', 'renamed')")
    # A written table of names is joined by itself, so that a name with many nodes is split where it is skewed.
    several = settle(stands.groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name"))
    own = stands.where("fate = 'kept'").join(several, "name", "left_semi").select("uid", "name", "rank", F.slice("path", F.lit(1), F.size("path") - 1).alias("line"))
    above = stands.join(several, "name", "left_semi").select(F.col("uid").alias("anc"), "name")
    met = own.select("uid", "name", F.explode("line").alias("anc")).join(above, ["anc", "name"]).select("uid").distinct()
    line = own.join(met, "uid", "left_semi").select("uid", "name", "rank", F.posexplode("line").alias("nth", "anc"))
    info = stands.select(F.col("uid").alias("anc"), F.struct("name", "rank", "fate").alias("at"))
    g = line.join(info, "anc").groupBy("uid", "name", "rank").agg(F.array_sort(F.collect_list(F.struct("nth", "at"))).alias("l"))  # a line is as long as the tree is deep
    back = F.array_position(F.reverse(F.transform("l", lambda x: x["at"]["fate"])), "renamed")
    tail = g.select("uid", "name", "rank", F.when(back == 0, F.col("l")).otherwise(F.slice("l", F.size("l") - back.cast("int") + 2, F.size("l"))).alias("l"))
    at = tail.withColumn("i", F.array_position(F.transform("l", lambda x: x["at"]["name"]), F.col("name")).cast("int")).where("i > 0")
    between = F.transform(F.reverse(F.slice("l", F.col("i") + 1, F.size("l"))), lambda x: F.concat_ws(" ", x["at"]["name"], x["at"]["rank"]))
    top = F.element_at("l", F.col("i"))["at"]["rank"]
    return at.select("uid", F.concat_ws(" ", "name", top, "name", "rank", between).alias("told"))


def build(nodes: DataFrame, names: DataFrame, skip: DataFrame, merged: DataFrame) -> Imported:
    """The taxonomy of the lines (value) of ``nodes``, ``names`` and ``merged``, without ``skip`` (uid) and all below them.

    A name whose unique name says ``<series>`` gets that word; one of a ``subgroup <`` is its unique name. Of several scientific
    names of a node the greatest counts. Other names are synonyms with their class as type, as they are written, but for ``in-part``.
    A child with its parent's name becomes ``X rank X`` below a genus; elsewhere it sinks: its children and synonyms go to the nearest
    ancestor that stands (so do those of a node without a scientific name). Both are decided on the parents of the dump, so the order
    of rows doesn't matter. A node that has an ancestor's name further up spells out the line to it. ``root`` becomes ``life``,
    ``environmental samples`` begin with their parent's name. Merged ids are aliases, repeated rows count once. Empty tables
    give empty ones.
    """
    pathed = settle(tree.with_path(_nodes(nodes)))
    own = dump_fields(names, "uid", "name", "unique_name", "class").where("uid <> ''").distinct()
    gone = pathed.select("uid", F.explode("path").alias("anc")).join(skip.select(F.trim("uid").alias("anc")).distinct(), "anc", "left_semi").select("uid").distinct()
    series = F.coalesce(F.contains("unique_name", F.lit("<series>")), F.lit(False))
    subgroup = F.coalesce(F.contains("unique_name", F.lit("subgroup <")), F.lit(False))
    name = F.when(subgroup, F.translate("unique_name", "<>", "")).when(series, F.concat("name", F.lit(" series"))).otherwise(F.col("name"))
    main = own.where((F.col("class") == SCIENTIFIC) & (F.col("name") != "")).groupBy("uid").agg(F.max(name).alias("name"))
    left = settle(pathed.join(gone, "uid", "left_anti").join(main, "uid", "left"))
    up = left.select(F.col("uid").alias("parent_uid"), F.col("name").alias("up_name"), F.col("rank").alias("up_rank"))
    same = F.coalesce(F.col("name") == F.col("up_name"), F.lit(False)) & (F.col("name") != ROOT)
    fate = F.when(F.col("name").isNull(), "nameless").when(same & (F.col("up_rank") == "genus"), "renamed").when(same, "sunk").otherwise("kept")
    state = settle(left.where("path IS NOT NULL").join(up, "parent_uid", "left").select("uid", "parent_uid", "name", "rank", "path", fate.alias("fate")))

    homes = settle(_homes(state))
    stands = state.where("fate IN ('kept', 'renamed')")
    moved = stands.join(homes.select(F.col("uid").alias("parent_uid"), "home", F.lit(True).alias("moved")), "parent_uid", "left")
    moved = moved.withColumn("parent_uid", F.when(F.col("moved"), F.col("home")).otherwise(F.col("parent_uid"))).join(_lineage_names(state), "uid", "left")
    over = stands.select(F.col("uid").alias("parent_uid"), F.col("name").alias("over"))
    final = F.when(F.col("fate") == "renamed", F.concat_ws(" ", "name", "rank", "name")).otherwise(F.coalesce("told", "name"))
    final = F.when(final == ROOT, "life").when((final == SAMPLES) & F.col("over").isNotNull(), F.concat_ws(" ", "over", F.lit(SAMPLES))).otherwise(final)
    out = moved.join(over, "parent_uid", "left").select("uid", F.when(final != "life", F.col("parent_uid")).alias("parent_uid"), final.alias("name"), "rank")

    others = own.where(~F.col("class").isin(SCIENTIFIC, IN_PART) & (F.col("name") != ""))
    placed = others.join(homes.withColumn("moved", F.lit(True)), "uid", "left").withColumn("uid", F.when(F.col("moved"), F.col("home")).otherwise(F.col("uid")))
    synonyms = placed.join(stands.select("uid"), "uid", "left_semi").select("uid", "name", F.col("class").alias("type")).distinct()
    aliases = dump_fields(merged, "id", "replacement").where("id <> '' AND replacement <> ''").distinct()
    problems = (
        left.where("path IS NULL").select("uid", F.lit("cycle").alias("problem")).union(state.where("fate = 'nameless'").select("uid", F.lit("no scientific name")))
        .union(own.select("uid").distinct().join(pathed, "uid", "left_anti").select("uid", F.lit("no node")))
    )
    return Imported(taxonomy(settle(out), synonyms, aliases, idspace="ncbi"), problems)
