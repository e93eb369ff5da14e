"""Curation by tables: subgenera, extinct lists, names, divisions, and finders of cases to look at (M-17, M-28, M-32, J-15, C-11, A-22, I-6, O-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.functions import codecs
from grovespark.model import BIT, Taxonomy
from grovespark.operators import edits, ids


def origin(field: str = "prefix") -> Column:
    """The prefix, or id, of a node's first source id."""
    return F.get("source_ids", F.lit(0))[field]


def name_subgenera(tax: Taxonomy) -> Taxonomy:
    """A subgenus with its parent's name gets the name ``X subgenus X``, or goes into the sibling that alone has that name (M-17).

    Decided on the names of the input. The old name is not kept, but where nodes are joined it becomes a synonym.
    """
    up = tax.nodes.select(F.col("uid").alias("parent_uid"), F.col("name").alias("parent_name"))
    twins = tax.nodes.where("rank = 'subgenus'").join(up, "parent_uid").where("name = parent_name")
    twins = twins.select("uid", "parent_uid", F.concat("name", F.lit(" subgenus "), "name").alias("new_name"))
    names = tax.nodes.select("name", "uid").union(tax.synonyms.select("name", "uid")).join(twins.select(F.col("new_name").alias("name")).distinct(), "name", "left_semi").distinct()
    alone = names.groupBy(F.col("name").alias("new_name")).agg(F.count("*").alias("k"), F.min("uid").alias("into")).where("k = 1")
    beside = alone.join(tax.nodes.select(F.col("uid").alias("into"), F.col("parent_uid").alias("into_parent")), "into")
    known = twins.join(beside, "new_name", "left").withColumn("into", F.when(F.col("into_parent") == F.col("parent_uid"), F.col("into")))
    renamed = known.where("into IS NULL").select("uid", "new_name")
    nodes = tax.nodes.join(renamed, "uid", "left").withColumn("name", F.coalesce("new_name", "name")).select(*tax.nodes.columns)
    return edits.absorb(tax.with_nodes(nodes), known.where("into IS NOT NULL").select("uid", "into"))


def mark_extinct(nodes: DataFrame, listed: DataFrame, prefix: str = "gbif") -> DataFrame:
    """``nodes`` with those of ``listed`` (uid) extinct whose first id is of ``prefix`` (M-32)."""
    known = nodes.where(origin() == prefix).select("uid").join(listed.select("uid"), "uid", "left_semi")
    return edits.add_flags(nodes, known.withColumn("bits", F.lit(BIT["extinct"])))


def has_name(tax: Taxonomy, claims: DataFrame) -> DataFrame:
    """(uid, name, whether, holds) of ``claims`` (uid, name, whether): does the node have, or not have, the name? (M-28)

    Synonyms are names; a node that is not there has none.
    """
    names = tax.nodes.select("uid", "name").union(tax.synonyms.select("uid", "name")).distinct().withColumn("found", F.lit(True))
    j = claims.join(names, ["uid", "name"], "left")
    return j.select("uid", "name", "whether", (F.coalesce("found", F.lit(False)) == F.col("whether")).alias("holds"))


def enforce_names(tax: Taxonomy, claims: DataFrame) -> Taxonomy:
    """The taxonomy in which ``claims`` (uid, name, whether) on its nodes hold (M-28).

    A name that is asked for becomes a synonym, or the name of a node without one (the smallest, if there are several);
    a synonym that is not wanted goes, and a name that is not wanted gets `` NOT`` at its end.
    """
    broken = has_name(tax, claims).where("NOT holds").select("uid", "name", "whether").distinct()
    unnamed = tax.nodes.where("name IS NULL").select("uid")
    first = broken.where("whether").join(unnamed, "uid", "left_semi").groupBy("uid").agg(F.min("name").alias("first"))
    denied = broken.where("NOT whether").select("uid", "name", F.lit(True).alias("denied"))
    nodes = tax.nodes.join(denied, ["uid", "name"], "left").join(first, "uid", "left")
    nodes = nodes.withColumn("name", F.when(F.col("denied"), F.concat("name", F.lit(" NOT"))).otherwise(F.coalesce("name", "first"))).select(*tax.nodes.columns)
    more = broken.where("whether").join(tax.nodes.select("uid"), "uid", "left_semi").join(first.withColumnRenamed("first", "name"), ["uid", "name"], "left_anti")
    synonyms = tax.synonyms.select("uid", "name", "type").join(denied, ["uid", "name"], "left_anti").union(more.select("uid", "name", F.lit("synonym")))
    return Taxonomy(nodes, synonyms, tax.aliases, tax.idspace)


def divisions_by_name(pathed: DataFrame, synonyms: DataFrame, skeleton: DataFrame, images: DataFrame, aligned: DataFrame) -> DataFrame:
    """(src, tgt, division): the source's node for each name of the ``skeleton`` (uid, name) (J-15).

    It is the least deep node of the name, synonyms included, that is no genus; there is none if two are equally deep, if
    the division has no image (src, tgt) in the target, if another division takes the node by its own name, or if
    ``aligned`` (src, tgt) maps the node elsewhere.
    """
    own = skeleton.groupBy("name").agg(F.count("*").alias("k"), F.min("uid").alias("division")).where("k = 1").select("name", "division")
    names = pathed.select("name", "uid").union(synonyms.select("name", "uid")).join(own, "name").distinct()
    depth = names.join(pathed.where("NOT rank <=> 'genus' AND depth IS NOT NULL").select("uid", "depth"), "uid")
    least = depth.groupBy("name", "division").agg(F.min("depth").alias("depth"))
    top = depth.join(least, ["name", "division", "depth"]).groupBy("division").agg(F.count("*").alias("k"), F.min("uid").alias("src")).where("k = 1").select("division", "src")
    once = top.groupBy("src").agg(F.min("division").alias("division"))
    found = once.join(images.select(F.col("src").alias("division"), "tgt"), "division").join(aligned.select("src", F.col("tgt").alias("other")), "src", "left")
    return found.where("other IS NULL OR other = tgt").select("src", "tgt", "division")


def inconsistent_examples(nodes: DataFrame, counts: DataFrame, largest: int = 500_000, shown: int = 30) -> DataFrame:
    """(uid, mrca, size, n_unplaced, child) of inconsistent nodes under parents of at most ``largest`` nodes (C-11).

    ``n_unplaced`` counts the parent's unplaced children of the same first source; where they are fewer than ``shown``
    there is a row for each, else one with a null child. ``counts``: (uid, n_nodes).
    """
    marked = nodes.select("uid", "parent_uid", origin().alias("prefix"), "proper_flags").where("parent_uid IS NOT NULL")
    cases = marked.where(codecs.has(F.col("proper_flags"), BIT["inconsistent"])).select("uid", "parent_uid", "prefix")
    cases = cases.join(counts.where(F.col("n_nodes") <= largest).select(F.col("uid").alias("parent_uid"), F.col("n_nodes").alias("size")), "parent_uid")
    loose = marked.where(codecs.has(F.col("proper_flags"), BIT["unplaced"])).select("parent_uid", "prefix", F.col("uid").alias("child"))
    many = loose.groupBy("parent_uid", "prefix").agg(F.count("*").alias("n"))
    few = loose.join(many.where(F.col("n") < shown).select("parent_uid", "prefix"), ["parent_uid", "prefix"], "left_semi")
    j = cases.join(many, ["parent_uid", "prefix"], "left").join(few, ["parent_uid", "prefix"], "left")
    return j.select("uid", F.col("parent_uid").alias("mrca"), "size", F.coalesce("n", F.lit(0)).alias("n_unplaced"), "child")


def redescriptions(nodes: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(uid, name, synonym, other_id): species one of whose synonyms (uid, name, source_ids) is a node of its own in a source (A-22).

    The synonym has the species' first id and another, the same first word, and another ending: the names differ before
    the last three characters of the shorter one.
    """
    x = nodes.where("rank = 'species'").select("uid", "name", origin("id").alias("own"))
    y = synonyms.select("uid", F.col("name").alias("synonym"), F.transform("source_ids", lambda q: q["id"]).alias("held"))
    j = x.join(y, "uid").where(F.array_contains("held", F.col("own")) & (F.substring_index("name", " ", 1) == F.substring_index("synonym", " ", 1)))
    j = j.where("left(name, greatest(0, least(length(name), length(synonym)) - 3)) <> left(synonym, greatest(0, least(length(name), length(synonym)) - 3))")
    return j.select("uid", "name", "synonym", "own", F.explode("held").alias("other_id")).where("other_id <> own").drop("own")


def dummy_ids(pathed: DataFrame) -> DataFrame:
    """(uid, new_id) of nodes without an id: -1, -2, ... in preorder (I-6)."""
    return ids.mint(pathed, 1).select("uid", (-F.col("new_id")).alias("new_id"))


def purge_dummies(nodes: DataFrame) -> DataFrame:
    """``nodes`` without their negative ids (I-6)."""
    return nodes.withColumn("id", F.when(~F.col("id").startswith("-"), F.col("id")))


def node_order() -> list[Column]:
    """The order of nodes (O-1): id, first source's id, name, number of children; what is missing counts as ``zzzzz``."""
    return [F.coalesce(x, F.lit("zzzzz")) for x in (F.col("uid"), origin("id"), F.col("name"))] + [F.coalesce("n_children", F.lit(0))]
