"""Surgery and curated edits on the node table: every operator takes a table of arguments and returns new nodes (M-16 to M-34)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.functions import codecs
from grovespark.model import BIT, FORMER_CONTAINER, UNPLACED_ANY, Taxonomy


def add_flags(nodes: DataFrame, marks: DataFrame) -> DataFrame:
    """Proper flags by ``marks`` (uid, bits) (M-24)."""
    m = marks.groupBy("uid").agg(F.bit_or("bits").alias("bits"))
    return nodes.join(m, "uid", "left").withColumn("proper_flags", F.col("proper_flags").bitwiseOR(F.coalesce("bits", F.lit(0)))).select(*nodes.columns)


def clear_flags(nodes: DataFrame, marks: DataFrame) -> DataFrame:
    m = marks.groupBy("uid").agg(F.bit_or("bits").alias("bits"))
    return nodes.join(m, "uid", "left").withColumn("proper_flags", F.col("proper_flags").bitwiseAND(F.bitwise_not(F.coalesce("bits", F.lit(0))))).select(*nodes.columns)


def hide_descendants(pathed: DataFrame, roots: DataFrame) -> DataFrame:
    """Everything below ``roots`` (uid) hidden (M-24)."""
    below = pathed.select("uid", F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("anc")).join(roots.select(F.col("uid").alias("anc")), "anc", "left_semi")
    return add_flags(pathed, below.select("uid", F.lit(BIT["hidden"]).alias("bits")))


def move(nodes: DataFrame, moves: DataFrame) -> DataFrame:
    """New parents by ``moves`` (uid, parent), placed there; under a former container: its parent, unplaced unless merged (M-20)."""
    p = nodes.select(F.col("uid").alias("parent"), F.col("parent_uid").alias("grand"), F.col("proper_flags").alias("pf"))
    m = moves.select("uid", "parent").dropDuplicates(["uid"]).join(p, "parent", "left")
    former = codecs.has(F.coalesce("pf", F.lit(0)), FORMER_CONTAINER) & F.col("grand").isNotNull()
    m = m.select("uid", F.when(former, F.col("grand")).otherwise(F.col("parent")).alias("to"), F.when(former & ~codecs.has(F.col("pf"), BIT["merged"]), BIT["unplaced"]).otherwise(0).alias("more"))
    j = nodes.join(m, "uid", "left")
    return j.withColumns({"parent_uid": F.coalesce("to", "parent_uid"), "proper_flags": F.when(F.col("to").isNull(), F.col("proper_flags")).otherwise(F.col("proper_flags").bitwiseAND(~UNPLACED_ANY).bitwiseOR(F.col("more")))}).select(*nodes.columns)


def move_if(nodes: DataFrame, moves: DataFrame) -> DataFrame:
    """``moves`` (uid, only_from, parent): only where the parent is ``only_from`` (M-30)."""
    fits = moves.join(nodes.select("uid", "parent_uid"), "uid").where("parent_uid = only_from")
    return move(nodes, fits.select("uid", "parent"))


def prune(pathed: DataFrame, roots: DataFrame, keep_root: bool = False) -> DataFrame:
    """Without the subtrees of ``roots`` (uid); ``keep_root``: without what is below them (M-21)."""
    gone = pathed.select("uid", F.explode("path").alias("anc")).join(roots.select(F.col("uid").alias("anc")), "anc", "left_semi")
    gone = gone.where("uid <> anc") if keep_root else gone
    return pathed.join(gone.select("uid").distinct(), "uid", "left_anti")


def absorb(tax: Taxonomy, pairs: DataFrame) -> Taxonomy:
    """Nodes merged into others by ``pairs`` (uid, into): names become synonyms, ids aliases, children move (M-22)."""
    from grovespark.operators.tree import resolve_aliases

    to = resolve_aliases(pairs.select(F.col("uid").alias("id"), F.col("into").alias("replacement"))).select(F.col("id").alias("uid"), F.col("replacement").alias("into"))
    kept = tax.nodes.join(to, "uid", "left_anti")
    kept = kept.join(to.select(F.col("uid").alias("parent_uid"), "into"), "parent_uid", "left").withColumn("parent_uid", F.coalesce("into", "parent_uid")).select(*tax.nodes.columns)
    lost = tax.nodes.join(to, "uid").select(F.col("into").alias("uid"), "name", F.lit("synonym").alias("type"))
    moved = tax.synonyms.join(to, "uid", "left").select(F.coalesce("into", "uid").alias("uid"), "name", "type")
    synonyms = moved.union(lost).where("name IS NOT NULL").join(kept.select("uid", "name"), ["uid", "name"], "left_anti").dropDuplicates(["uid", "name"])
    return Taxonomy(kept, synonyms, tax.aliases.union(to.select(F.col("uid").alias("id"), F.col("into").alias("replacement"))), tax.idspace)


def rename(tax: Taxonomy, names: DataFrame, kind: str = "synonym") -> Taxonomy:
    """New primary names by ``names`` (uid, new_name); the old ones become synonyms (M-23)."""
    j = tax.nodes.join(names.dropDuplicates(["uid"]), "uid", "left")
    nodes = j.withColumn("name", F.coalesce("new_name", "name")).select(*tax.nodes.columns)
    old = j.where("new_name IS NOT NULL AND name IS NOT NULL AND new_name <> name").select("uid", "name", F.lit(kind).alias("type"))
    synonyms = tax.synonyms.select("uid", "name", "type").union(old).join(nodes.select("uid", "name"), ["uid", "name"], "left_anti").dropDuplicates(["uid", "name"])
    return Taxonomy(nodes, synonyms, tax.aliases, tax.idspace)


def normalize(tax: Taxonomy) -> Taxonomy:
    """Primary names without diacritics, unless the plain name is taken; the old name becomes a spelling variant (M-19)."""
    plain = codecs.normalize_names(tax.nodes.select("uid", "name")).where("normal <> name")
    free = plain.join(tax.nodes.select(F.col("name").alias("normal")), "normal", "left_anti")
    return rename(tax, free.select("uid", F.col("normal").alias("new_name")), "spelling variant")


def elide_containers(pathed: DataFrame) -> DataFrame:
    """Children of containers (by name) go up to the nearest other ancestor with a flag; the container stays, emptied (M-16).

    The only child of a container gets no flag.
    """
    flag = codecs.container_flag(F.col("name"))
    boxes = pathed.where((flag != 0) & F.col("parent_uid").isNotNull()).select(F.col("uid").alias("box"), flag.alias("bits"))
    up = pathed.select("uid", F.posexplode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("nth", "anc")).join(boxes.withColumnRenamed("box", "anc"), "anc", "left")
    place = up.groupBy("uid").agg(F.max_by("anc", F.struct(F.col("bits").isNull(), "nth")).alias("to"))
    only = pathed.groupBy(F.col("parent_uid").alias("box")).agg(F.count("*").alias("k"))
    mine = pathed.join(boxes.withColumnRenamed("box", "parent_uid"), "parent_uid").join(only.withColumnRenamed("box", "parent_uid"), "parent_uid")
    mine = mine.select("uid", F.when(F.col("k") > 1, F.col("bits")).otherwise(0).alias("more")).join(place, "uid")
    j = pathed.join(mine, "uid", "left").join(boxes.select(F.col("box").alias("uid"), F.lit(BIT["was_container"]).alias("was")), "uid", "left")
    flags = F.col("proper_flags").bitwiseOR(F.coalesce("more", F.lit(0))).bitwiseOR(F.coalesce("was", F.lit(0)))
    return j.withColumns({"parent_uid": F.coalesce("to", "parent_uid"), "proper_flags": flags}).select(*pathed.columns)


def smush(tax: Taxonomy) -> Taxonomy:
    """Siblings of one name become the one with the smallest id; ids of the others become aliases (M-18)."""
    w = Window.partitionBy("parent_uid", "name")
    twins = tax.nodes.where("name IS NOT NULL AND parent_uid IS NOT NULL").withColumn("into", F.min("uid").over(w)).where("into <> uid")
    return absorb(tax, twins.select("uid", "into"))


def best_synonyms(synonyms: DataFrame, priority: Column) -> DataFrame:
    """One row per (name, uid): the one of the best source (M-31)."""
    w = Window.partitionBy("name", "uid").orderBy(priority, "source")
    return synonyms.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def hide_unlisted(nodes: DataFrame, prefix: str, whitelist: DataFrame) -> DataFrame:
    """Nodes whose first id is of ``prefix`` hidden, but for those in ``whitelist`` (uid) (M-33)."""
    own = nodes.where(F.get("source_ids", F.lit(0))["prefix"] == prefix).join(whitelist.select("uid"), "uid", "left_anti")
    return add_flags(nodes, own.select("uid", F.lit(BIT["hidden"]).alias("bits")))


def apply_edits(tax: Taxonomy, edits: DataFrame) -> Taxonomy:
    """A table of edits (command, name, rank, parent, uid): add, synonym, flag, incertae_sedis, prune, move, fold (M-26).

    Names are looked up among primary names; ambiguous ones are left alone. Independent edits of a kind go together, in
    the order add, move, synonym, flag, fold, prune.
    """
    from grovespark.operators.tree import with_path

    one = tax.nodes.groupBy("name").agg(F.min("uid").alias("u"), F.count("*").alias("k")).where("k = 1").select("name", "u")
    e = edits.join(one, "name", "left").join(one.select(F.col("name").alias("parent"), F.col("u").alias("p")), "parent", "left")
    add = e.where("command = 'add' AND u IS NULL AND p IS NOT NULL")
    defaults = {c: F.lit(None).cast(tax.nodes.schema[c].dataType) for c in tax.nodes.columns} | {"uid": F.col("uid"), "parent_uid": F.col("p"), "name": F.col("name"), "rank": F.coalesce("rank", F.lit("no rank")), "source_ids": F.array().cast(tax.nodes.schema["source_ids"].dataType), "proper_flags": F.lit(BIT["edited"]), "inferred_flags": F.lit(0)}
    nodes = tax.nodes.union(add.select(*(defaults[c].alias(c) for c in tax.nodes.columns)))
    nodes = move(nodes, e.where("command = 'move' AND u IS NOT NULL AND p IS NOT NULL").select(F.col("u").alias("uid"), F.col("p").alias("parent")))
    bits = F.when(F.col("command") == "incertae_sedis", BIT["incertae_sedis"]).otherwise(BIT["hidden"])
    nodes = add_flags(nodes, e.where("command IN ('flag', 'incertae_sedis') AND u IS NOT NULL").select(F.col("u").alias("uid"), bits.alias("bits")))
    more = e.where("command = 'synonym' AND p IS NOT NULL").select(F.col("p").alias("uid"), "name", F.lit("synonym").alias("type"))
    out = absorb(Taxonomy(nodes, tax.synonyms.select("uid", "name", "type").union(more), tax.aliases, tax.idspace), e.where("command = 'fold' AND u IS NOT NULL AND p IS NOT NULL").select(F.col("u").alias("uid"), F.col("p").alias("into")))
    kept = prune(with_path(out.nodes), e.where("command = 'prune' AND u IS NOT NULL").select(F.col("u").alias("uid"))).select(*tax.nodes.columns)
    return Taxonomy(kept, out.synonyms.join(kept, "uid", "left_semi"), out.aliases, tax.idspace)


def proclaim(nodes: DataFrame, claims: DataFrame) -> DataFrame:
    """(uid, kind, value, holds) of ``claims`` (uid, kind, value): has_parent, has_rank, is_extinct, is_extant (M-27); null if unknown."""
    j = claims.join(nodes.select("uid", "parent_uid", "rank", "proper_flags"), "uid", "left")
    extinct = codecs.has(F.col("proper_flags"), BIT["extinct"])
    holds = F.when(F.col("kind") == "has_parent", F.col("parent_uid") == F.col("value")).when(F.col("kind") == "has_rank", F.col("rank") == F.col("value")).when(F.col("kind") == "is_extinct", extinct).when(F.col("kind") == "is_extant", ~extinct)
    return j.select("uid", "kind", "value", holds.alias("holds"))


