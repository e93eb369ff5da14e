"""Comparing trees node by node, any number of pairs at once (C-*). All frames are keyed by ``pair``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.functions import paths
from grovespark.operators import tree
from grovespark.storage import settle


def tip_map(inputs: DataFrame, matches: DataFrame) -> DataFrame:
    """(pair, tip, ref): the matched nodes of ``inputs`` without a matched descendant; the smallest input per ref (C-1, C-2).

    ``inputs``: (pair, uid, path); ``matches``: (pair, tip, ref).
    """
    m = matches.join(inputs.select("pair", F.col("uid").alias("tip"), "path"), ["pair", "tip"])
    covered = m.select("pair", F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("tip")).distinct()
    low = m.join(covered, ["pair", "tip"], "left_anti")
    return low.groupBy("pair", "ref").agg(F.min("tip").alias("tip")).select("pair", "tip", "ref")


def induce(own: DataFrame, other: DataFrame, tips: DataFrame, a: str, b: str) -> DataFrame:
    """(pair, uid, image): each node's common clade in the other tree, over its mapped tips (C-3)."""
    at = tips.select("pair", F.col(a).alias("uid"), F.col(b).alias("o")).join(own.select("pair", "uid", "path"), ["pair", "uid"])
    up = at.select("pair", "o", F.explode("path").alias("uid")).join(other.select("pair", F.col("uid").alias("o"), F.col("path").alias("op")), ["pair", "o"])
    return up.groupBy("pair", "uid").agg(paths.set_mrca_path("op").alias("m")).select("pair", "uid", F.element_at("m", -1).alias("image"))


def articulations(inputs: DataFrame, refs: DataFrame, matches: DataFrame) -> DataFrame:
    """(pair, uid, status, witness) of every input node with mapped tips (C-4, C-5, C-6)."""
    tips = settle(tip_map(inputs, matches))
    return articulate(inputs, induced(refs, tips), tips)


def induced(refs: DataFrame, tips: DataFrame) -> DataFrame:
    """The reference nodes under the common clade of their mapped tips, with paths that begin there (C-3)."""
    at = tips.select("pair", F.col("ref").alias("uid")).join(refs.select("pair", "uid", "path"), ["pair", "uid"])
    top = at.groupBy("pair").agg(F.element_at(paths.set_mrca_path("path"), -1).alias("_top"))
    return refs.join(top, "pair").where(F.array_contains("path", F.col("_top"))).withColumn("path", F.expr("slice(path, array_position(path, _top), size(path))")).drop("_top")


def articulate(own: DataFrame, others: DataFrame, tips: DataFrame) -> DataFrame:
    """(pair, uid, status, witness) of every node of ``own`` above ``tips`` (pair, tip, ref), by the nodes of ``others``."""
    a, b = settle(own.select("pair", "uid", "path")), settle(others.select("pair", "uid", "path"))
    tips = settle(tips.select("pair", "tip", "ref"))
    there, back = settle(induce(a, b, tips, "tip", "ref")), settle(induce(b, a, tips, "ref", "tip"))
    n = there.join(a, ["pair", "uid"]).join(back.select("pair", F.col("uid").alias("image"), F.col("image").alias("bounce")), ["pair", "image"])
    n = n.join(a.select("pair", F.col("uid").alias("bounce"), F.col("path").alias("bounce_path")), ["pair", "bounce"])
    n = n.withColumn("fits", F.array_contains("bounce_path", F.col("uid")))
    n = settle(n.withColumn("bounce_parent", F.get("bounce_path", F.size("bounce_path") - 2)))

    same = n.where("fits").join(there.select("pair", F.col("uid").alias("bounce_parent"), F.col("image").alias("parent_image")), ["pair", "bounce_parent"], "left")
    # The witness: the image's highest ancestor with the same image back.
    line = same.select("pair", "uid", "image", "bounce").join(b.select("pair", F.col("uid").alias("image"), F.col("path").alias("ip")), ["pair", "image"]).select("pair", "uid", "bounce", F.posexplode("ip").alias("nth", "anc"))
    line = line.join(back.select("pair", F.col("uid").alias("anc"), F.col("image").alias("anc_back")), ["pair", "anc"]).where("anc_back = bounce")
    widest = line.groupBy("pair", "uid").agg(F.min_by("anc", "nth").alias("witness"))
    status = F.when(F.col("parent_image") == F.col("image"), "partial_path_of").otherwise("supported_by")
    supported = same.select("pair", "uid", status.alias("status")).join(widest, ["pair", "uid"])

    # The others resolve the image unless one of its children is neither included nor excluded.
    rest = n.where("NOT fits").select("pair", "uid", "path", "image")
    kids = b.select("pair", F.get("path", F.size("path") - 2).alias("image"), F.col("uid").alias("kid"))
    counts = tips.join(a.select("pair", F.col("uid").alias("tip"), F.col("path").alias("tp")), ["pair", "tip"]).join(b.select("pair", F.col("uid").alias("ref"), F.col("path").alias("rp")), ["pair", "ref"])
    each = counts.select("pair", F.explode("tp").alias("uid"), "rp").join(rest.select("pair", "uid", "image"), ["pair", "uid"])
    kid_of = each.select("pair", "uid", "image", F.get("rp", F.array_position("rp", F.col("image")).cast("int")).alias("kid")).where("kid IS NOT NULL").groupBy("pair", "uid", "kid").agg(F.count("*").alias("inside"))
    size = counts.select("pair", F.explode("rp").alias("kid")).groupBy("pair", "kid").agg(F.count("*").alias("size"))
    clash = kid_of.join(kids.select("pair", "kid"), ["pair", "kid"]).join(size, ["pair", "kid"]).where("inside < size").groupBy("pair", "uid").agg(F.min("kid").alias("clash"))
    others = rest.join(clash, ["pair", "uid"], "left").select("pair", "uid", F.when(F.col("clash").isNull(), "resolves").otherwise("conflicts_with").alias("status"), F.coalesce("clash", "image").alias("witness"))
    return supported.select("pair", "uid", "status", "witness").union(others)


def compare_pairs(pairs: DataFrame, trees: DataFrame) -> DataFrame:
    """(pair, uid, flipped, info) of ``pairs`` (pair, first, second) of trees, all in one plan (C-8).

    ``trees``: (tree, uid, parent_uid, name, key), and whether a node is the ``ingroup``; tips with one ``key`` are the same. The smaller tree is the
    input, the first if they are of one size: of several of its tips with one partner the smallest is mapped. What is told is always of the first tree: how its nodes fare
    against the second, ``info`` being a JSON object with status, witness and the witness's name. Where the first is the input, nodes of its ingroup are told
    (all, if it has none), else those under the common clade of its mapped tips. A node with several children counts as inner, and only keys of tips map.
    """
    keyed = trees.select("tree", "uid", "parent_uid", "name", "key", "ingroup")
    # Trees are joined by their own ids: a tree's nodes get paths once, however many pairs it is in.
    one = F.concat_ws("\x1f", "tree", "uid")
    up = F.when(F.col("parent_uid").isNotNull(), F.concat_ws("\x1f", "tree", "parent_uid"))
    whole = keyed.select("tree", F.col("uid").alias("node"), "name", "key", "ingroup", one.alias("uid"), up.alias("parent_uid"))
    nodes = settle(tree.with_children(tree.with_path(whole)).where("path IS NOT NULL"))
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("size"))
    p = pairs.join(sizes.select(F.col("tree").alias("first"), F.col("size").alias("n1")), "first").join(sizes.select(F.col("tree").alias("second"), F.col("size").alias("n2")), "second")
    p = settle(p.select("pair", "first", "second", (F.col("n2") < F.col("n1")).alias("flipped")))

    def side(which: str) -> DataFrame:
        return p.select("pair", "flipped", F.col(which).alias("tree")).join(nodes, "tree")

    a, b = settle(side("first")), settle(side("second"))
    small, large = (a.where("NOT flipped").unionByName(b.where("flipped")), b.where("NOT flipped").unionByName(a.where("flipped")))
    tip = small.where("n_children = 0 AND key IS NOT NULL").select("pair", F.col("uid").alias("tip"), "key")
    ref = large.where("n_children = 0 AND key IS NOT NULL").groupBy("pair", "key").agg(F.min("uid").alias("ref"))
    mapped = settle(tip_map(small, tip.join(ref, ["pair", "key"])).join(p.select("pair", "flipped"), "pair"))
    whole_ref = induced(large, mapped)
    a, b = a.where("NOT flipped").unionByName(whole_ref.where("flipped")), whole_ref.where("NOT flipped").unionByName(b.where("flipped"))
    a, b = settle(a), settle(b)
    tips = settle(mapped.select("pair", F.when(F.col("flipped"), F.col("ref")).otherwise(F.col("tip")).alias("tip"), F.when(F.col("flipped"), F.col("tip")).otherwise(F.col("ref")).alias("ref")))
    found = articulate(a, b, tips)
    group = a.where("NOT flipped AND ingroup").groupBy("pair").agg(F.min("uid").alias("start"))
    found = found.join(a.select("pair", "uid", "node", "flipped", "path"), ["pair", "uid"]).join(group, "pair", "left").where("start IS NULL OR array_contains(path, start)")
    found = found.join(b.select("pair", F.col("uid").alias("witness"), F.col("node").alias("w"), F.col("name").alias("w_name")), ["pair", "witness"], "left")
    info = F.to_json(F.struct("status", F.col("w").alias("witness"), F.col("w_name").alias("witness_name")))
    return found.select("pair", F.col("node").alias("uid"), "flipped", info.alias("info"))


def ratios(found: DataFrame, inputs: DataFrame, tips: DataFrame) -> DataFrame:
    """(pair, n_tips, n_mapped, n_conflicts, conflictivity, unmappedness) (C-6, C-9)."""
    t = inputs.where("n_children = 0").groupBy("pair").agg(F.count("*").alias("n_tips"))
    m = tips.groupBy("pair").agg(F.count("*").alias("n_mapped"))
    c = found.groupBy("pair").agg(F.count(F.when(F.col("status") == "conflicts_with", 1)).alias("n_conflicts"), F.count("*").alias("n"))
    j = t.join(m, "pair", "left").join(c, "pair", "left").fillna(0)
    return j.select("pair", "n_tips", "n_mapped", "n_conflicts", (F.col("n_conflicts") / F.greatest("n", F.lit(1))).alias("conflictivity"), ((F.col("n_tips") - F.col("n_mapped")) / F.greatest("n_tips", F.lit(1))).alias("unmappedness"))


def coverage(otus: DataFrame, least: int = 3, share: float = 0.5) -> DataFrame:
    """(study, n, n_mapped, accepted) of ``otus`` (study, otu, mapped_id) (C-12)."""
    c = otus.groupBy("study").agg(F.count("*").alias("n"), F.count("mapped_id").alias("n_mapped"))
    return c.withColumn("accepted", (F.col("n") >= least) & (F.col("n_mapped") >= F.col("n") * share))


def outliers(tips: DataFrame, focal: DataFrame) -> DataFrame:
    """(study, tip): mapped tips outside the study's focal clade (C-10). ``tips``: (study, tip, path); ``focal``: (study, clade)."""
    return tips.join(focal, "study").where(~F.array_contains("path", F.col("clade"))).select("study", "tip")


def transfer_names(inputs: DataFrame, there: DataFrame, back: DataFrame, names: DataFrame) -> DataFrame:
    """(pair, uid, name): the names of reference nodes for input nodes that are each other's images (C-7)."""
    both = there.join(back.select("pair", F.col("uid").alias("image"), F.col("image").alias("uid")), ["pair", "uid", "image"])
    return inputs.select("pair", "uid").join(both, ["pair", "uid"]).join(names.select(F.col("uid").alias("image"), "name"), "image").select("pair", "uid", "name")
