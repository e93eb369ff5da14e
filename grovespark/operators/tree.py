"""Paths and everything that follows from them: ancestry, common ancestors, sizes, selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.functions import codecs, paths
from grovespark.model import BIT, SPECIES, SUPPRESSED, Taxonomy
from grovespark.storage import settle


def with_path(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``path`` (root first, the node last) and ``depth`` (H-3, H-4).

    Pointer doubling: each round joins every node with the node its path has reached, so a tree of depth d takes
    log2(d) joins, however deep it is. Nodes on a cycle or under a missing parent get a null path.
    """
    first = settle(nodes.select("uid", F.col("parent_uid").alias("up"), F.array("uid").alias("path")))
    done, open_ = first.where("up IS NULL"), first.where("up IS NOT NULL")
    while not open_.isEmpty():
        above = done.union(open_).select(F.col("uid").alias("u"), F.col("up").alias("upper"), F.col("path").alias("head"))
        going = open_.join(above, F.col("up") == F.col("u")).select("uid", F.col("upper").alias("up"), F.concat("head", "path").alias("path"))
        # A path that leads back into itself has no root; without it, a path doubles until it reaches one.
        going = settle(going.where("up IS NULL OR NOT array_contains(path, up)"))
        # A finished path is written once.
        done, open_ = done.union(going.where("up IS NULL")), going.where("up IS NOT NULL")
    return nodes.join(done.select("uid", "path", F.size("path").alias("depth")), "uid", "left")


def with_children(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the number of children."""
    counts = nodes.where("parent_uid IS NOT NULL").groupBy(F.col("parent_uid").alias("uid")).agg(F.count("*").alias("n_children"))
    return nodes.join(counts, "uid", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def subtree_counts(pathed: DataFrame) -> DataFrame:
    """(uid, n_nodes, n_tips, n_species, n_binomials) of every subtree (H-9, H-10).

    Species and binomials count only where no node above them counts. Needs path, rank, name, n_children.
    """
    species, binomial = codecs.rank_level("rank") == SPECIES, codecs.is_binomial(F.col("name"))
    marked = pathed.select("uid", "path", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("tip"), F.coalesce(species, F.lit(False)).alias("sp"), F.coalesce(binomial, F.lit(False)).alias("bi"))
    up = marked.select("uid", F.posexplode("path").alias("at", "anc"), F.size("path").alias("depth"), "tip", "sp", "bi")
    sizes = up.groupBy("anc").agg(F.count("*").alias("n_nodes"), F.sum("tip").alias("n_tips"))

    def topmost(flag: str, out: str) -> DataFrame:
        """From every ancestor, the counted nodes without a counted node between (the ancestor included)."""
        hits = marked.where(flag).select("uid", "path")
        # A counted node hides itself from those above its nearest counted proper ancestor.
        above = hits.select("uid", F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("a"), F.size("path").alias("d")).join(hits.select(F.col("uid").alias("a"), F.size("path").alias("da")), "a").groupBy("uid").agg(F.max("da").alias("from"))
        seen = hits.join(above, "uid", "left").select(F.explode(F.expr("slice(path, coalesce(from, 0) + 1, size(path))")).alias("anc"))
        own = hits.select(F.col("uid").alias("anc"), F.lit(1).alias("self"))
        return seen.groupBy("anc").agg(F.count("*").alias(out)).join(own, "anc", "left").select("anc", F.when(F.col("self") == 1, 1).otherwise(F.col(out)).alias(out))

    joined = sizes.join(topmost("sp", "n_species"), "anc", "left").join(topmost("bi", "n_binomials"), "anc", "left")
    return joined.select(F.col("anc").alias("uid"), "n_nodes", "n_tips", F.coalesce("n_species", F.lit(0)).alias("n_species"), F.coalesce("n_binomials", F.lit(0)).alias("n_binomials"))


def count_tips_where(pathed: DataFrame, keep: Column) -> DataFrame:
    """(uid, n_tips) of tips that meet ``keep`` (H-11, X-3)."""
    return pathed.where((F.col("n_children") == 0) & keep).select(F.explode("path").alias("uid")).groupBy("uid").agg(F.count("*").alias("n_tips"))


def lineage(pathed: DataFrame) -> DataFrame:
    """(uid, steps, ancestor): every ancestor-or-self, nearest first (H-2)."""
    return pathed.select("uid", F.posexplode(F.reverse("path")).alias("steps", "ancestor"))


def descendants(pathed: DataFrame, uid: str, include_self: bool = True) -> DataFrame:
    """The subtree of ``uid`` (H-1)."""
    own = pathed.where(F.array_contains("path", uid))
    return own if include_self else own.where(F.col("uid") != uid)


def pair_mrca(pairs: DataFrame, pathed: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with mrca, its depth, and the sibling ancestors below it (H-6, H-8)."""
    p = pathed.select("uid", "path")
    both = pairs.join(p.select(F.col("uid").alias("a"), F.col("path").alias("pa")), "a").join(p.select(F.col("uid").alias("b"), F.col("path").alias("pb")), "b")
    d = paths.divergence("pa", "pb")
    return both.select(*pairs.columns, paths.mrca("pa", "pb").alias("mrca"), paths.common_length("pa", "pb").alias("mrca_depth"), d["left"].alias("left"), d["right"].alias("right"))


def set_mrca(members: DataFrame, pathed: DataFrame, *keys: str) -> DataFrame:
    """(keys, mrca, path) of the sets of uids in ``members`` (H-7, X-5)."""
    joined = members.join(pathed.select("uid", "path"), "uid")
    return joined.groupBy(*keys).agg(paths.set_mrca_path("path").alias("mrca_path")).select(*keys, F.get("mrca_path", F.size("mrca_path") - 1).alias("mrca"), "mrca_path")


def with_division(pathed: DataFrame, divisions: DataFrame) -> DataFrame:
    """``pathed`` with ``division``: the nearest ancestor-or-self among ``divisions`` (uid) (H-13).

    The table of divisions is joined by id, however large it is.
    """
    up = pathed.select("uid", F.posexplode("path").alias("at", "anc")).join(divisions.select(F.col("uid").alias("anc")).distinct(), "anc")
    return pathed.join(up.groupBy("uid").agg(F.max_by("anc", "at").alias("division")), "uid", "left")


def quasi_parent(pathed: DataFrame, other_names: DataFrame) -> DataFrame:
    """(uid, quasi): the nearest ancestor whose name is no prefix of the node's and is known to the other tree (H-14).

    Ancestors whose names are prefixes are skipped only up to the first that is none.
    """
    names = pathed.select(F.col("uid").alias("anc"), F.col("name").alias("anc_name"))
    up = pathed.select("uid", "name", F.posexplode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("at", "anc")).join(names, "anc").where("anc_name IS NOT NULL")
    stop = up.where(~F.col("name").startswith(F.col("anc_name"))).groupBy("uid").agg(F.max("at").alias("first"))
    known = up.join(stop, "uid").where("at <= first").join(other_names.select(F.col("name").alias("anc_name")).distinct(), "anc_name", "left_semi")
    return known.groupBy("uid").agg(F.max_by("anc", "at").alias("quasi"), F.max_by("anc_name", "at").alias("quasi_name"))


def popular_ancestor(pathed: DataFrame, score: Column) -> DataFrame:
    """(uid, popular): the ancestor-or-self nearest to the root with the highest ``score`` (H-15)."""
    scores = pathed.select(F.col("uid").alias("anc"), score.alias("score"))
    up = pathed.select("uid", F.posexplode("path").alias("at", "anc")).join(scores, "anc")
    return up.groupBy("uid").agg(F.max_by("anc", F.struct("score", -F.col("at"))).alias("popular"))


def normalize_roots(tax: Taxonomy, counts: DataFrame) -> Taxonomy:
    """The largest root (``life`` first) stays; the others go under it as unplaced (H-16)."""
    roots = tax.nodes.where("parent_uid IS NULL").join(counts.select("uid", "n_nodes"), "uid")
    top = roots.orderBy(F.coalesce(F.col("name") == "life", F.lit(False)).desc(), F.desc("n_nodes"), "uid").limit(1).select(F.col("uid").alias("top"))
    nodes = tax.nodes.join(F.broadcast(top))  # one row
    moved = F.col("parent_uid").isNull() & (F.col("uid") != F.col("top"))
    return tax.with_nodes(nodes.withColumn("proper_flags", F.when(moved, F.col("proper_flags").bitwiseOR(BIT["unplaced"])).otherwise(F.col("proper_flags"))).withColumn("parent_uid", F.when(moved, F.col("top")).otherwise(F.col("parent_uid"))).drop("top"))


def hidden() -> Column:
    """Whether a node is hidden: a suppressing flag, proper or inferred, and not forced visible (P-7)."""
    both = F.col("proper_flags").bitwiseOR(F.col("inferred_flags"))
    return codecs.has(both, SUPPRESSED) & ~codecs.has(both, BIT["forced_visible"])


def select_subtree(pathed: DataFrame, uid: str, max_depth: int | None = None) -> DataFrame:
    """The subtree under ``uid`` as a tree of its own, optionally cut below some depth (P-12)."""
    own = descendants(pathed, uid)
    if max_depth is not None:
        own = own.where(F.size("path") - F.array_position("path", uid) <= max_depth)
    return own.withColumn("parent_uid", F.when(F.col("uid") == uid, F.lit(None).cast("string")).otherwise(F.col("parent_uid")))


def select_visible(pathed: DataFrame) -> DataFrame:
    """Nodes without a hidden node on their path that still lead to a tip (P-12)."""
    bad = pathed.where(hidden()).select(F.col("uid").alias("anc"))
    gone = pathed.select("uid", F.explode("path").alias("anc")).join(bad, "anc", "left_semi").select("uid").distinct()
    seen = pathed.join(gone, "uid", "left_anti")
    live = seen.where("n_children = 0").select(F.explode("path").alias("uid")).distinct()
    return seen.join(live, "uid", "left_semi")


def split(pathed: DataFrame, uid: str) -> tuple[DataFrame, DataFrame]:
    """(the subtree, the rest with the subtree's root as a tip) (P-13)."""
    return select_subtree(pathed, uid), pathed.where(~F.array_contains("path", uid) | (F.col("uid") == uid))


def chop(pathed: DataFrame, counts: DataFrame, least: int, most: int) -> DataFrame:
    """(uid, n_nodes): the maximal subtrees with least < size <= most (H-18)."""
    sized = pathed.join(counts.select("uid", "n_nodes"), "uid")
    fits = sized.where((F.col("n_nodes") > least) & (F.col("n_nodes") <= most))
    above = fits.select("uid", F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("anc")).join(fits.select(F.col("uid").alias("anc")), "anc", "left_semi").select("uid").distinct()
    return fits.join(above, "uid", "left_anti").select("uid", "n_nodes")


def sample_tree(pathed: DataFrame, counts: DataFrame, root: str, k: int) -> DataFrame:
    """(uid, quota): a deterministic sample of about ``k`` tips below ``root``, handed down by size (H-17).

    Each node hands its quota to its children, smallest first: a child gets what is due to the children so far in
    proportion to their sizes, less what they got.
    """
    sized = descendants(pathed, root).join(counts.select("uid", "n_nodes"), "uid")
    quota = settle(sized.where(F.col("uid") == root).select("uid", F.least(F.lit(k), F.col("n_nodes")).cast("double").alias("quota")))
    out, order = quota, Window.partitionBy("parent_uid").orderBy(hidden(), "n_nodes", "uid")
    whole = Window.partitionBy("parent_uid")
    ranked = settle(sized.where(F.col("uid") != root).withColumn("upto", F.sum("n_nodes").over(order)).withColumn("all", F.sum("n_nodes").over(whole)).select("uid", "parent_uid", "n_nodes", "upto", "all"))
    while True:
        nxt = ranked.join(quota.select(F.col("uid").alias("parent_uid"), "quota"), "parent_uid")
        due = F.floor(F.col("quota") * F.col("upto") / F.col("all"))
        was = F.floor(F.col("quota") * (F.col("upto") - F.col("n_nodes")) / F.col("all"))
        quota = settle(nxt.select("uid", F.least(due - was, F.col("n_nodes")).cast("double").alias("quota")).where("quota > 0"))
        if quota.isEmpty():
            return out.withColumn("quota", F.col("quota").cast("long"))
        out = out.union(quota)


def induced_tree(pathed: DataFrame, chosen: DataFrame) -> DataFrame:
    """(uid, parent_uid): chosen nodes and the branching ancestors among them, reparented (H-19)."""
    own = pathed.join(chosen.select("uid").distinct(), "uid", "left_semi").select("uid", "path")
    steps = own.select("uid", F.posexplode("path").alias("at", "anc"), "path").withColumn("below", F.get("path", F.col("at") + 1))
    branching = steps.where("below IS NOT NULL").groupBy("anc").agg(F.count_distinct("below").alias("n")).where("n > 1").select("anc")
    kept = branching.union(own.select("uid")).distinct().select(F.col("anc").alias("uid"))
    full = pathed.join(kept, "uid", "left_semi").select("uid", "path")
    up = full.select("uid", F.posexplode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("at", "anc")).join(kept.select(F.col("uid").alias("anc")), "anc", "left_semi")
    return full.select("uid").join(up.groupBy("uid").agg(F.max_by("anc", "at").alias("parent_uid")), "uid", "left")


def brackets(pathed: DataFrame, counts: DataFrame) -> DataFrame:
    """(uid, start, finish): preorder numbers, so that containment is a range (H-20)."""
    # The number of nodes before a node: those of its ancestors, and the subtrees of earlier siblings on its path.
    sized = pathed.join(counts.select("uid", "n_nodes"), "uid").select("uid", "parent_uid", "path", "n_nodes")
    before = Window.partitionBy("parent_uid").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    step = sized.select(F.col("uid").alias("anc"), (F.coalesce(F.sum("n_nodes").over(before), F.lit(0)) + F.when(F.col("parent_uid").isNull(), 0).otherwise(1)).alias("step"))
    start = sized.select("uid", F.explode("path").alias("anc")).join(step, "anc").groupBy("uid").agg(F.sum("step").alias("start"))
    return start.join(sized.select("uid", "n_nodes"), "uid").select("uid", "start", (F.col("start") + F.col("n_nodes")).alias("finish"))


def integrity(tax: Taxonomy) -> DataFrame:
    """(problem, n): missing parents, repeated ids, nodes without a path to a root, synonyms of nothing (H-21)."""
    nodes = tax.nodes
    ids = nodes.select(F.col("uid").alias("parent_uid")).distinct()
    missing = nodes.where("parent_uid IS NOT NULL").join(ids, "parent_uid", "left_anti").agg(F.lit("missing parent").alias("problem"), F.count("*").alias("n"))
    repeated = nodes.groupBy("uid").agg(F.count("*").alias("c")).where("c > 1").agg(F.lit("repeated id").alias("problem"), F.count("*").alias("n"))
    stray = with_path(nodes).where("path IS NULL").agg(F.lit("no path to a root").alias("problem"), F.count("*").alias("n"))
    lost = tax.synonyms.join(nodes, "uid", "left_anti").agg(F.lit("synonym without node").alias("problem"), F.count("*").alias("n"))
    return missing.union(repeated).union(stray).union(lost)


def resolve_aliases(aliases: DataFrame) -> DataFrame:
    """Chains of aliases followed to their ends by pointer doubling; those on cycles are dropped (H-22)."""
    t = settle(aliases.select("id", F.col("replacement").alias("to")).where("id <> to").dropDuplicates(["id"]))
    before = None
    while True:
        nxt = t.join(t.select(F.col("id").alias("to"), F.col("to").alias("end")), "to", "left")
        # While a chain goes on, each round reaches the end of one more at least; what never does is on a cycle.
        going = nxt.where("end IS NOT NULL").count()
        if going in (0, before):
            break
        before = going
        t = settle(nxt.select("id", F.coalesce("end", "to").alias("to")))
    ends = t.select(F.col("id").alias("to"))
    return t.join(ends, "to", "left_anti").select("id", F.col("to").alias("replacement"))
