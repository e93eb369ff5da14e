"""Reports over one release or two: homonyms, differences, metrics (A-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.functions import codecs
from grovespark.model import BIT
from grovespark.operators import tree


def first_of_each(events: DataFrame, kind: str, order: str, n: int = 10) -> DataFrame:
    """Counts per kind, and the first ``n`` rows of each (A-1, O-5)."""
    total = events.groupBy(kind).agg(F.count("*").alias("total"))
    first = events.withColumn("nth", F.row_number().over(Window.partitionBy(kind).orderBy(order))).where(F.col("nth") <= n)  # tasks keep n rows a kind
    return first.join(total, first[kind].eqNullSafe(total[kind])).drop(total[kind])


def counts_with_total(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts by keys with subtotals and the grand total, as ``total`` rows (A-3, A-18)."""
    r = rows.rollup(*keys).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    n = len(keys)
    return r.select(*(F.when((F.shiftright("g", n - 1 - i) % 2) == 1, "total").otherwise(F.col(k)).alias(k) for i, k in enumerate(keys)), "n")


def name_overlap(src: DataFrame, tgt_names: DataFrame, answers: DataFrame) -> DataFrame:
    """(n, in_common, matched, blocked): source nodes with a name the target has, and their fate (A-5)."""
    common = src.join(tgt_names.select("name").distinct(), "name", "left_semi").select(F.col("uid").alias("src"), F.lit(True).alias("common"))
    j = src.select(F.col("uid").alias("src")).join(common, "src", "left").join(answers.select("src", "value"), "src", "left")
    return j.agg(F.count("*").alias("n"), F.count("common").alias("in_common"), F.count(F.when(F.col("value") > 0, 1)).alias("matched"), F.count(F.when(F.col("common") & ~F.coalesce(F.col("value") > 0, F.lit(False)), 1)).alias("blocked"))


def homonym_groups(pathed: DataFrame) -> DataFrame:
    """(name, kind, clade, n_nodes, first, last): nodes of one name under one parent (``sibling``) or, in several of its children, under one grandparent (``cousin``) (J-25, A-6).

    A row stands for all pairs of its nodes, but for those of cousins that are siblings; ``first`` and ``last`` are its least and greatest uid.
    """
    many = pathed.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name")
    own = pathed.join(many, "name", "left_semi").select("name", "uid", "parent_uid", F.get("path", F.size("path") - 3).alias("grand"))
    ends = [F.count("*").alias("n_nodes"), F.min("uid").alias("first"), F.max("uid").alias("last")]
    siblings = own.groupBy("name", F.lit("sibling").alias("kind"), F.col("parent_uid").alias("clade")).agg(*ends).where("n_nodes > 1")
    cousins = own.where("grand IS NOT NULL").groupBy("name", F.lit("cousin").alias("kind"), F.col("grand").alias("clade")).agg(*ends, F.min("parent_uid").alias("low"), F.max("parent_uid").alias("high")).where("low < high")
    return siblings.union(cousins.drop("low", "high"))


def homonym_kinds(pathed: DataFrame) -> DataFrame:
    """(name, kind, n): how many pairs of nodes of one name are siblings, parent and child, aunt and niece, cousins, or other (J-25, A-6).

    Pairs are counted from the sizes of groups and never made: a name with k nodes gives at most 6 k rows. Nodes without a
    parent count as siblings; a node without a name has no homonyms.
    """
    many = pathed.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("k")).where("k > 1")
    own = pathed.join(many.select("name"), "name", "left_semi").select("name", "uid", "parent_uid", F.get("path", F.size("path") - 3).alias("grand"))
    by_parent = own.groupBy("name", "parent_uid", "grand").agg(F.count("*").alias("m"))
    pairs = F.expr("m * (m - 1) div 2")
    siblings = by_parent.select("name", F.lit("sibling").alias("kind"), pairs.alias("n"))
    # A parent of the name has one row for each child of the name.
    below = own.select("name", "uid").join(by_parent.select("name", F.col("parent_uid").alias("uid"), "m"), ["name", "uid"])
    children = below.select("name", F.lit("parent/child").alias("kind"), F.col("m").alias("n"))
    # Children of the grandparent, without the parent itself, if it has the name.
    by_clade = own.groupBy("name", "parent_uid").agg(F.count("*").alias("c"))
    nieces = by_parent.join(by_clade.select("name", F.col("parent_uid").alias("grand"), "c"), ["name", "grand"]).select("name", F.lit("aunt/niece").alias("kind"), F.expr("m * c").alias("n"))
    own_parent = below.join(own.where("parent_uid IS NOT NULL").select("name", "uid"), ["name", "uid"], "left_semi").select("name", F.lit("aunt/niece").alias("kind"), F.expr("-m").alias("n"))
    by_grand = by_parent.where("grand IS NOT NULL").groupBy("name", "grand").agg(F.sum("m").alias("m"), F.sum(pairs).alias("near"))
    cousins = by_grand.select("name", F.lit("cousin").alias("kind"), (pairs - F.col("near")).alias("n"))
    told = siblings.union(children).union(nieces).union(own_parent).union(cousins).groupBy("name", "kind").agg(F.sum("n").alias("n"))
    rest = many.join(told.groupBy("name").agg(F.sum("n").alias("told")), "name").select("name", F.lit("other").alias("kind"), F.expr("k * (k - 1) div 2 - told").alias("n"))
    return told.union(rest).where("n > 0")


def homonym_report(pathed: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, mrca, n, sizes): how many pairs of nodes of one name meet at ``mrca``, above both, and the sum of both sizes over these pairs (A-7).

    Nodes are counted by clade and child, so a name with k nodes gives at most k times depth rows. Nodes of different trees don't meet.
    """
    many = pathed.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name")
    own = pathed.join(many, "name", "left_semi").join(counts.select("uid", F.col("n_nodes").alias("size")), "uid")
    steps = own.select("name", "size", F.col("path").alias("p"), F.posexplode("path").alias("at", "child")).where("at > 0").select("name", "size", "child", F.get("p", F.col("at") - 1).alias("mrca"))
    by_child = steps.groupBy("name", "mrca", "child").agg(F.count("*").alias("k"), F.sum("size").alias("s"))
    met = by_child.groupBy("name", "mrca").agg(F.sum("k").alias("k"), F.expr("sum(k * k)").alias("same"), F.sum("s").alias("s"), F.expr("sum(s * k)").alias("own"))
    return met.where("k * k > same").select("name", "mrca", F.expr("(k * k - same) div 2").alias("n"), F.expr("s * k - own").alias("sizes"))


def spelling_variants(nodes: DataFrame) -> DataFrame:
    """(uid, name, other): names that differ in -ae and -ea (A-12)."""
    variant = nodes.select("uid", "name", codecs.ae_variant(F.col("name")).alias("v")).where("v IS NOT NULL")
    return variant.join(nodes.select(F.col("uid").alias("other"), F.col("name").alias("v")), "v").select("uid", "name", "other")


def parent_child_homonyms(nodes: DataFrame) -> DataFrame:
    up = nodes.select(F.col("uid").alias("parent_uid"), F.col("name").alias("parent_name"))
    return nodes.join(up, "parent_uid").where("name = parent_name").select("uid", "parent_uid", "name")


def representatives(pathed: DataFrame, divisions: DataFrame) -> DataFrame:
    """(division, uid): per division the species with most sources, then the shortest name (A-11)."""
    d = tree.with_division(pathed.where("rank = 'species'"), divisions).where("division IS NOT NULL")
    return d.groupBy("division").agg(F.max_by("uid", F.struct(F.size("source_ids"), -F.length("name"), "uid")).alias("uid"))


def release_diff(old: DataFrame, new: DataFrame, new_synonyms: DataFrame) -> DataFrame:
    """(uid, what) of all differences between two releases (A-13); a node may have several.

    Both: uid, parent_uid, name, proper_flags, inferred_flags. Synonyms of the new release: uid, name.
    """
    names = new.select("name", F.col("uid").alias("n_uid"), F.lit(True).alias("primary")).union(new_synonyms.select("name", "uid", F.lit(False)))
    by_name = names.groupBy("name").agg(F.count("*").alias("k"), F.min("n_uid").alias("n_uid"), F.bool_or("primary").alias("primary"))
    o = old.select("uid", F.col("parent_uid").alias("op"), F.col("name").alias("on"), tree.hidden().alias("oh"))
    n = new.select("uid", F.col("parent_uid").alias("np"), F.col("name").alias("nn"), tree.hidden().alias("nh"), F.lit(True).alias("here"))
    j = o.join(n, "uid", "left").join(by_name.select(F.col("name").alias("on"), "k", "n_uid", "primary"), "on", "left")
    gone = F.when(F.col("k").isNull(), "removed").when(F.col("k") != 1, "multiple-replacements").when(F.col("primary"), "changed-id-?").otherwise("synonymized")
    renamed = F.when(F.col("nn") != F.col("on"), F.when((F.col("k") == 1) & (F.col("n_uid") == F.col("uid")), "renamed-keeping-synonym").otherwise("renamed"))
    moved = F.when(F.col("np").isNull() & F.col("op").isNotNull(), "raised-to-root").when(F.col("np").isNotNull() & F.col("op").isNull(), "no-longer-root").when(F.col("np") != F.col("op"), "moved")
    seen = F.when(F.col("nh") & ~F.col("oh"), "hidden").when(~F.col("nh") & F.col("oh"), "exposed")
    whats = F.when(F.col("here").isNull(), F.array(gone)).otherwise(F.array_compact(F.array(renamed, moved, seen)))
    first = j.select("uid", F.explode(whats).alias("what"))
    old_names = old.select("name").distinct().withColumn("was", F.lit(True))
    fresh = new.join(old.select("uid"), "uid", "left_anti").select("uid", "name").join(old_names, "name", "left").join(by_name.select("name", "k"), "name", "left")
    added = fresh.select("uid", F.when(F.col("was"), "changed-id?").when(F.col("k") > 1, "added-homonym").otherwise("added").alias("what"))
    return first.union(added)


def status_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(change, n) between two releases, each id counted once (A-14)."""
    o, n = old.select("uid", F.col("name").alias("a"), F.col("parent_uid").alias("pa"), tree.hidden().alias("ha")), new.select("uid", F.col("name").alias("b"), F.col("parent_uid").alias("pb"), tree.hidden().alias("hb"))
    change = (
        F.when(F.col("b").isNull(), "retired").when(F.col("a").isNull(), "new").when(F.col("ha") != F.col("hb"), "visibility").when(F.col("a") != F.col("b"), "renamed")
        .when(~F.col("pa").eqNullSafe(F.col("pb")), "moved").otherwise("same")
    )
    return o.join(n, "uid", "full").groupBy(change.alias("change")).agg(F.count("*").alias("n"))


def metrics(pathed: DataFrame, synonyms: DataFrame) -> DataFrame:
    """One row of counts (A-16, A-26)."""
    one = pathed.agg(
        F.count("*").alias("n_nodes"), F.count(F.when(F.col("n_children") == 0, 1)).alias("n_tips"), F.count(F.when(F.col("n_children") > 0, 1)).alias("n_internal"),
        F.count(F.when(F.col("rank") == "species", 1)).alias("n_species"), F.count(F.when(tree.hidden(), 1)).alias("n_hidden"), F.count(F.when(codecs.has(F.col("proper_flags"), BIT["extinct"]), 1)).alias("n_extinct"),
        F.max("depth").alias("max_depth"), F.max("n_children").alias("max_children"), F.count_distinct("name").alias("n_names"),
    )
    return one.join(synonyms.agg(F.count("*").alias("n_synonyms")))  # one row each


def contributions(nodes: DataFrame) -> DataFrame:
    """(prefix, copied, aligned) with a total: nodes whose first id, or a later id, is of the source (A-17)."""
    ids = nodes.select("uid", F.posexplode("source_ids").alias("nth", "q")).select("nth", F.col("q.prefix").alias("prefix"))
    r = ids.rollup("prefix").agg(F.count(F.when(F.col("nth") == 0, 1)).alias("copied"), F.count(F.when(F.col("nth") > 0, 1)).alias("aligned"), F.grouping("prefix").alias("g"))
    return r.select(F.when(F.col("g") == 1, "total").otherwise(F.col("prefix")).alias("prefix"), "copied", "aligned")


def flag_counts(nodes: DataFrame) -> DataFrame:
    """(flag, n) over the text form of the flags (A-19)."""
    text = codecs.print_flags(F.col("proper_flags"), F.col("inferred_flags"))
    return nodes.select(F.explode(F.split(text, ",")).alias("flag")).where("flag <> ''").groupBy("flag").agg(F.count("*").alias("n"))


def inclusions(tests: DataFrame, pathed: DataFrame) -> DataFrame:
    """(taxon, clade, id, status): is the named taxon, with that id if one is given, in the named clade? (A-24, P-5)"""
    named = pathed.select("uid", "name", "path")
    clades = named.select(F.col("name").alias("clade"), F.col("uid").alias("clade_uid"))
    hits = tests.join(named.select(F.col("name").alias("taxon"), "uid", "path"), "taxon", "left").join(clades, "clade", "left")
    inside = F.coalesce(F.array_contains("path", F.col("clade_uid")), F.lit(False)) & F.coalesce(F.col("id") == F.col("uid"), F.col("id").isNull())
    g = hits.groupBy("taxon", "clade", "id").agg(F.bool_or(inside).alias("ok"), F.count("uid").alias("k"))
    return g.select("taxon", "clade", "id", F.when(F.col("ok"), "ok").when(F.col("k") == 0, "unknown name").otherwise("not in clade").alias("status"))


def extant_under_extinct(nodes: DataFrame) -> DataFrame:
    """Extant nodes whose parent is extinct (A-27)."""
    up = nodes.where(codecs.has(F.col("proper_flags"), BIT["extinct"])).select(F.col("uid").alias("parent_uid"))
    return nodes.where(~codecs.has(F.col("proper_flags"), BIT["extinct"])).join(up, "parent_uid", "left_semi").select("uid", "parent_uid")
