"""The skeleton of separated clades: an initial union with divisions, and the divisions of every source (M-14, J-15)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.model import SOURCE_IDS, Taxonomy
from grovespark.operators import curation, tree
from grovespark.storage import settle

#: The reason of an answer that a division's name gives.
BY_DIVISION = "by division name"


@dataclass(frozen=True)
class Skeleton:
    #: (uid, name, path) of the divisions; their paths tell which of them are disjoint.
    nodes: DataFrame
    #: (src, tgt): the union's node for each division.
    images: DataFrame


def skeleton(nodes: DataFrame, images: DataFrame | None = None) -> Skeleton:
    """A skeleton of ``nodes`` (uid, parent_uid, name); without ``images`` (src, tgt) the union has its uids.

    Divisions without a name separate nothing and are left out; those on a cycle or under a missing parent, too.
    """
    pathed = settle(tree.with_path(nodes.select("uid", "parent_uid", "name")).where("name IS NOT NULL AND path IS NOT NULL").select("uid", "name", "path"))
    return Skeleton(pathed, images if images is not None else pathed.select(F.col("uid").alias("src"), F.col("uid").alias("tgt")))


def set_skeleton(union: Taxonomy, nodes: DataFrame) -> tuple[Taxonomy, Skeleton]:
    """``union`` with the skeleton ``nodes`` (uid, parent_uid, name, ...) in it, and its divisions (M-14).

    An empty union becomes the skeleton, with its uids; the nodes name no source. To another one it is aligned and merged.
    """
    from grovespark.operators import merge

    bare = nodes.select("uid", "parent_uid", "name", *(["rank"] if "rank" in nodes.columns else [])).withColumn("source_ids", F.array().cast(SOURCE_IDS))
    if union.nodes.isEmpty():
        own = union.with_nodes(settle(bare.select(*(F.col(c) if c in bare.columns else d.alias(c) for c, d in _defaults(union).items()))))
        return own, skeleton(nodes)
    skel = Taxonomy(settle(bare.select(*(F.col(c) if c in bare.columns else d.alias(c) for c, d in _defaults(union).items()))), union.synonyms.where("false"), union.aliases.where("false"), "skeleton")
    merged = merge.absorb(skel, union)
    # What the union knows of its nodes' sources does not change.
    had = union.nodes.select("uid", F.col("source_ids").alias("had"))
    out = merged.union.nodes.join(had, "uid", "left").withColumn("source_ids", F.coalesce("had", F.array().cast(SOURCE_IDS))).select(*union.nodes.columns)
    return merged.union.with_nodes(settle(out)), skeleton(nodes, merged.alignment.select("src", "tgt"))


def _defaults(union: Taxonomy) -> dict:
    plain = {"rank": F.lit("no rank"), "proper_flags": F.lit(0), "inferred_flags": F.lit(0)}
    return {c: plain.get(c, F.lit(None)) for c in union.nodes.columns}


def set_division(images: DataFrame, nodes: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Divisions by hand (M-14): ``images`` (src, tgt) with those of ``asked`` (uid, name), and (uid, name, problem) of the others.

    A name that no division of ``nodes`` (uid, name, ...) or that several bear is ``unrecognized``; a node that has another division is a ``conflict``, as is
    one that is asked for under several names.
    """
    unique = nodes.groupBy("name").agg(F.min("uid").alias("src"), F.count("*").alias("k")).where("k = 1").select("name", "src")
    named = asked.select("uid", "name").distinct().join(unique, "name", "left").join(images.groupBy(F.col("tgt").alias("uid")).agg(F.collect_set("src").alias("has")), "uid", "left")
    several = named.where("src IS NOT NULL").groupBy("uid").agg(F.count("*").alias("k"))
    named = settle(named.join(several, "uid", "left"))
    clash = (F.col("k") > 1) | F.coalesce(~F.array_contains("has", F.col("src")), F.lit(False))
    problems = named.withColumn("problem", F.when(F.col("src").isNull(), "unrecognized").when(clash, "conflict")).where("problem IS NOT NULL").select("uid", "name", "problem")
    return images.select("src", "tgt").union(named.where(F.col("src").isNotNull() & ~clash).select("src", F.col("uid").alias("tgt"))).distinct(), problems


def marked(pathed: DataFrame, synonyms: DataFrame, skel: Skeleton, target: DataFrame, aligned: DataFrame) -> DataFrame:
    """(src, tgt, division): the nodes of a source that are divisions by their names (J-15), and their images in the union.

    Images that are no longer among the nodes ``target`` (uid) count as none. ``aligned`` (src, tgt) comes before a name.
    """
    images = skel.images.join(target.select(F.col("uid").alias("tgt")), "tgt", "left_semi").groupBy("src").agg(F.min("tgt").alias("tgt"))
    return settle(curation.divisions_by_name(pathed, synonyms, skel.nodes.select("uid", "name"), images, aligned))


def of_side(skel: Skeleton, nodes: DataFrame) -> DataFrame:
    """(uid, division, path) of ``nodes`` (uid, division); a node with several has the first by uid."""
    one = nodes.groupBy("uid").agg(F.min("division").alias("division"))
    return one.join(skel.nodes.select(F.col("uid").alias("division"), "path"), "division").select("uid", "division", "path")
