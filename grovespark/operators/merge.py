"""Merging an aligned source into a union, level by level from the source's tips up (M-*)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.functions import codecs, paths
from grovespark.model import BIT, COLUMNS, FORMER_CONTAINER, SOURCE_IDS, SUPPRESSED, UNPLACED_ANY, Taxonomy, mask
from grovespark.operators import align, tree
from grovespark.storage import settle


@dataclass(frozen=True)
class Merged:
    union: Taxonomy
    #: (src, fate) of every source node.
    fates: DataFrame
    #: (src, tgt) after the merge.
    alignment: DataFrame
    #: A row for every inconsistent source node (M-12), as ``conflict_rows`` says.
    conflicts: DataFrame


CLASHES = "src string, alice string, alice_target string, bob string, bob_target string, sink string, proper_flags int"


def heights(pathed: DataFrame) -> DataFrame:
    """(uid, height): 0 for tips, else one more than the highest child."""
    up = pathed.select(F.posexplode("path").alias("nth", "uid"), F.size("path").alias("d"))
    return up.groupBy("uid").agg(F.max(F.col("d") - F.col("nth") - 1).alias("height"))


def _placed(flags: str):
    return ~codecs.has(F.col(flags), UNPLACED_ANY)


def merge(source: Taxonomy, union: Taxonomy, answers: DataFrame) -> Merged:
    """The union with the source's unaligned nodes added.

    Nodes of one height decide on the union as it was before that height and then apply their changes together, in a
    fixed order. ``answers``: (src, tgt, value, ...); where two sources have one target, both count as images.
    """
    sp = settle(tree.with_children(tree.with_path(source.nodes)))
    up = tree.with_path(union.nodes)
    yes = settle(answers.where("value > 0").select("src", "tgt"))
    lubs = align.target_mrcas(source.nodes, up, answers)
    line = sp.select(F.col("uid").alias("src"), F.posexplode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("nth", "anc"))
    sinks = line.join(yes.select(F.col("src").alias("anc"), "tgt"), "anc").groupBy("src").agg(F.max_by("tgt", "nth").alias("sink"))
    plan = sp.join(heights(sp), "uid").withColumnRenamed("uid", "src").join(sinks, "src", "left").join(lubs, "src", "left").join(answers.select("src", "value"), "src", "left")
    plan = settle(plan.select("src", "parent_uid", "name", "rank", "source_ids", "proper_flags", "n_children", "height", "sink", "lub", "value"))
    top = plan.agg(F.max("height")).first()[0] or 0

    witness = F.struct(F.coalesce("k_parent", F.lit("")).alias("p"), "kid", "k")
    own_qid = F.array(F.struct(F.lit(source.idspace).alias("prefix"), F.col("src").alias("id"))).cast(SOURCE_IDS)
    new_uid = F.concat(F.lit(f"{source.idspace}:"), F.col("src"))

    def copies(rows: DataFrame, parent, flag, detached: bool) -> DataFrame:
        return rows.select(new_uid.alias("uid"), parent.alias("parent_uid"), "name", "rank", own_qid.alias("source_ids"), F.col("proper_flags").bitwiseOR(flag).alias("proper_flags"), F.lit(0).alias("inferred_flags"), F.lit(detached).alias("detached"))

    # Tips.
    tips = plan.where("n_children = 0").join(yes, "src", "left")
    fate = F.when(F.col("tgt").isNotNull(), "mapped/tip").when(F.col("value").isNull(), "new/tip").when(F.col("value") <= -3, "new/polysemy").otherwise("ambiguous/redundant")
    tips = settle(tips.withColumn("fate", fate))
    fates = tips.select("src", "fate")
    fresh = tips.where("fate LIKE 'new/%'")
    nodes = settle(union.nodes.select(*COLUMNS).withColumn("detached", F.lit(False)).union(copies(fresh, F.lit(None).cast("string"), F.lit(0), True)))
    images = settle(yes.union(fresh.select("src", new_uid.alias("tgt"))))
    clashes = []

    for h in range(1, top + 1):
        level = plan.where(F.col("height") == h).join(yes, "src", "left").select("src", "name", "rank", "proper_flags", "sink", "lub", F.col("tgt").alias("image"))
        pathed = settle(tree.with_path(nodes).select("uid", "parent_uid", "path", "proper_flags", "detached"))
        kids = plan.select(F.col("src").alias("kid"), F.col("parent_uid").alias("src"), F.col("proper_flags").alias("kid_flags"), F.col("n_children").alias("_")).drop("_").join(level.select("src"), "src")
        kids = kids.join(images.select(F.col("src").alias("kid"), F.col("tgt").alias("k")), "kid").join(pathed.select(F.col("uid").alias("k"), F.col("parent_uid").alias("k_parent"), F.col("path").alias("k_path"), F.col("proper_flags").alias("k_flags"), F.col("detached").alias("k_detached")), "k")
        kids = settle(kids)
        settled = kids.where(_placed("kid_flags") & ~F.col("k_detached") & _placed("k_flags"))
        seen = settled.groupBy("src").agg(F.count("*").alias("n"), F.min(F.coalesce("k_parent", F.lit(""))).alias("low"), F.max(F.coalesce("k_parent", F.lit(""))).alias("high"), F.min(witness).alias("alice"), F.max(witness).alias("bob"))
        # Whether every placed child of a node is the image of some source node.
        stray = pathed.where(~F.col("detached") & _placed("proper_flags")).join(images.select(F.col("tgt").alias("uid")), "uid", "left_anti").select(F.coalesce("parent_uid", F.lit("")).alias("sink_key")).distinct().withColumn("stray", F.lit(True))
        where = pathed.select(F.col("uid").alias("_u"), F.col("path").alias("_p"))
        d = level.join(seen, "src", "left").withColumn("sink_key", F.coalesce("sink", F.lit(""))).join(stray, "sink_key", "left")
        d = d.join(where.select(F.col("_u").alias("low"), F.col("_p").alias("low_path")), "low", "left").join(where.select(F.col("_u").alias("lub"), F.col("_p").alias("lub_path")), "lub", "left")
        under = F.col("sink").isNull() | F.coalesce(F.array_contains("low_path", F.col("sink")), F.lit(False))
        fate = (
            F.when(F.col("image").isNotNull(), "mapped/internal").when(F.col("n").isNull(), "new/graft").when(F.col("low") != F.col("high"), "reject/inconsistent")
            .when(~under, "reject/overtaken").when(F.col("stray").isNull() & ~codecs.has(F.col("proper_flags"), BIT["hidden"]), "new/refinement").otherwise("reject/absorbed")
        )
        point = F.when(F.col("lub").isNotNull() & (F.col("sink").isNull() | F.coalesce(F.array_contains("lub_path", F.col("sink")), F.lit(False))), F.col("lub")).otherwise(F.col("sink"))
        d = d.withColumn("fate", fate)
        target = F.when(F.col("fate") == "mapped/internal", F.col("image")).when(F.col("fate").startswith("new/"), new_uid).when(F.col("fate").isin("reject/inconsistent", "reject/overtaken"), point).otherwise(F.when(F.col("low") != "", F.col("low")))
        d = settle(d.withColumns({"target": target, "adds": F.when(F.col("fate").isin("reject/inconsistent", "reject/overtaken"), BIT["unplaced"]).otherwise(0)}).select("src", "name", "rank", "proper_flags", "fate", "target", "adds", "sink", "alice", "bob"))
        clashes.append(d.where("fate = 'reject/inconsistent'").select("src", "alice.kid", "alice.k", "bob.kid", "bob.k", "sink", "proper_flags").toDF("src", "alice", "alice_target", "bob", "bob_target", "sink", "proper_flags"))
        # A parent that is not under the sink is overtaken; the node counts as absorbed (M-6).
        fates = fates.union(d.select("src", F.when(F.col("fate") == "reject/overtaken", "reject/absorbed").otherwise(F.col("fate")).alias("fate")))

        # New nodes are detached until their parent is met; tombstones hang under their replacement at once.
        made = copies(d.where("fate LIKE 'new/%'"), F.lit(None).cast("string"), F.lit(0), True)
        dead = copies(d.where("fate LIKE 'reject/%'"), F.col("target"), F.when(F.col("fate") == "reject/inconsistent", BIT["inconsistent"]).otherwise(BIT["merged"]), False)
        # Children go to the target: new ones always, unplaced old ones if the target is a better place,
        # placed old ones where the source refines.
        t = kids.join(d.select("src", "fate", "target", "adds"), "src").join(pathed.select(F.col("uid").alias("target"), F.col("path").alias("t_path"), F.col("proper_flags").alias("t_flags"), F.col("parent_uid").alias("t_parent")), "target", "left")
        t_path = F.coalesce("t_path", F.array("target"))
        cycle = F.coalesce(F.array_contains(t_path, F.col("k")), F.lit(False))
        take_new = F.col("k_detached") & (F.col("k") != F.coalesce("target", F.lit("")))
        better = ~F.col("k_detached") & ~_placed("k_flags") & F.coalesce(F.array_contains(t_path, F.col("k_parent")), F.col("k_parent").isNull()) & ~F.col("target").eqNullSafe(F.col("k_parent")) & ~cycle
        refine = (F.col("fate") == "new/refinement") & ~F.col("k_detached") & _placed("k_flags")
        former = codecs.has(F.coalesce("t_flags", F.lit(0)), FORMER_CONTAINER) & F.col("t_parent").isNotNull()
        place = F.when(cycle & take_new, F.lit(None).cast("string")).when(former, F.col("t_parent")).otherwise(F.col("target"))
        more = F.when(cycle & take_new, BIT["unplaced"]).otherwise(F.col("adds").bitwiseOR(F.when(former & ~codecs.has(F.coalesce("t_flags", F.lit(0)), BIT["merged"]), BIT["unplaced"]).otherwise(0)))
        moves = t.where(take_new | better | refine).select("k", F.struct(F.when(refine, 0).when(take_new, 1).otherwise(2).alias("o"), "src", place.alias("place"), F.when(take_new, more).when(refine, 0).otherwise(F.col("adds").bitwiseOR(F.col("kid_flags").bitwiseAND(UNPLACED_ANY))).alias("more"), (better & ~take_new).alias("clears")).alias("m"))
        moves = moves.groupBy("k").agg(F.min("m").alias("m"))
        moved = nodes.join(moves, F.col("uid") == F.col("k"), "left")
        kept = F.when(F.coalesce(F.col("m.clears"), F.lit(False)), F.col("proper_flags").bitwiseAND(~UNPLACED_ANY)).otherwise(F.col("proper_flags"))
        moved = moved.select("uid", F.when(F.col("m").isNotNull(), F.col("m.place")).otherwise(F.col("parent_uid")).alias("parent_uid"), "name", "rank", "source_ids", kept.bitwiseOR(F.coalesce(F.col("m.more"), F.lit(0))).alias("proper_flags"), "inferred_flags", (F.col("detached") & F.col("m").isNull()).alias("detached"))
        nodes = settle(moved.union(made).union(dead))
        images = settle(images.union(d.where("fate <> 'mapped/internal'").select("src", new_uid.alias("tgt"))))

    # The images of source roots that are still detached become roots.
    nodes = nodes.drop("detached")
    nodes = transfer(source, nodes, yes)
    synonyms = copy_names(source, union, images, nodes)
    nodes = settle(nodes)
    clashed = reduce(DataFrame.union, clashes) if clashes else source.nodes.sparkSession.createDataFrame([], CLASHES)
    return Merged(Taxonomy(nodes, settle(synonyms), union.aliases, union.idspace), settle(fates), images, conflict_rows(clashed, nodes))


def conflict_rows(clashed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(src, alice, alice_target, alice_parent, alice_ancestor, bob, ..., mrca, sink, unplaced, depth, visible) (M-12).

    Alice and Bob are two children of the source node whose images have different parents: the ones with the smallest
    and the largest parent, then uid. The ancestors are the two below the images' common clade ``mrca``, with its depth (1 for a root; null
    where one image holds the other); ``unplaced`` counts the unplaced children of the sink. All as the union is after the merge.
    """
    pathed = settle(tree.with_path(nodes).select("uid", "parent_uid", "path", "proper_flags"))
    loose = pathed.where(codecs.has(F.col("proper_flags"), BIT["unplaced"])).groupBy(F.col("parent_uid").alias("_sink")).agg(F.count("*").alias("unplaced"))
    d = clashed
    for who in ("alice", "bob"):
        d = d.join(pathed.select(F.col("uid").alias(f"{who}_target"), F.col("parent_uid").alias(f"{who}_parent"), F.col("path").alias(f"{who}_path")), f"{who}_target", "left")
    d = d.join(loose, F.col("sink").eqNullSafe(F.col("_sink")), "left")
    two = paths.divergence("alice_path", "bob_path")
    d = d.withColumns({"two": two, "mrca": F.when(two.isNotNull(), paths.mrca("alice_path", "bob_path")), "depth": F.when(two.isNotNull(), paths.common_length("alice_path", "bob_path"))})
    visible = ~codecs.has(F.col("proper_flags"), SUPPRESSED) | codecs.has(F.col("proper_flags"), BIT["forced_visible"])
    return d.select("src", "alice", "alice_target", "alice_parent", F.col("two.left").alias("alice_ancestor"), "bob", "bob_target", "bob_parent", F.col("two.right").alias("bob_ancestor"), "mrca", "sink", F.coalesce("unplaced", F.lit(0)).alias("unplaced"), "depth", visible.alias("visible"))


def transfer(source: Taxonomy, nodes: DataFrame, yes: DataFrame) -> DataFrame:
    """Properties of aligned source nodes: missing names and ranks, three flags, the source's own id (M-10)."""
    ctx = source.nodes.join(yes, F.col("uid") == F.col("src")).select("tgt", "src", F.col("name").alias("s_name"), F.col("rank").alias("s_rank"), F.col("proper_flags").alias("s_flags"))
    one = ctx.groupBy("tgt").agg(F.min(F.struct("src", "s_name", "s_rank")).alias("a"), F.bit_or("s_flags").alias("s_flags"), F.sort_array(F.collect_set(F.struct(F.lit(source.idspace).alias("prefix"), F.col("src").alias("id")))).cast(SOURCE_IDS).alias("ids"))
    j = nodes.join(one, F.col("uid") == F.col("tgt"), "left")
    adds = F.coalesce(F.col("s_flags").bitwiseAND(mask("forced_visible", "edited", "extinct")), F.lit(0))
    other_name = ~F.col("name").eqNullSafe(F.col("a.s_name")) & ~codecs.has(F.col("proper_flags"), BIT["extinct"])
    adds = F.when(F.col("tgt").isNotNull() & other_name, adds.bitwiseAND(~BIT["extinct"])).otherwise(adds)
    rank = F.when(F.col("rank").isin("no rank", "cluster") & F.col("a.s_rank").isNotNull(), F.col("a.s_rank")).otherwise(F.col("rank"))
    return j.select("uid", "parent_uid", F.coalesce("name", F.col("a.s_name")).alias("name"), rank.alias("rank"), F.array_union("source_ids", F.coalesce("ids", F.array().cast(SOURCE_IDS))).alias("source_ids"), F.col("proper_flags").bitwiseOR(adds).alias("proper_flags"), "inferred_flags")


def copy_names(source: Taxonomy, union: Taxonomy, images: DataFrame, nodes: DataFrame) -> DataFrame:
    """All names of a source node become names of its image; equal to the primary name: nothing (M-11)."""
    own = source.nodes.select("uid", "name", F.lit("synonym").alias("type")).union(source.synonyms.select("uid", "name", "type"))
    new = own.where("name IS NOT NULL").join(images, F.col("uid") == F.col("src")).select(F.col("tgt").alias("uid"), "name", "type")
    every = union.synonyms.select("uid", "name", "type").union(new)
    return every.join(nodes.select("uid", "name"), ["uid", "name"], "left_anti").groupBy("uid", "name").agg(F.min("type").alias("type"))


def summary(fates: DataFrame) -> DataFrame:
    """(fate, n) (A-3)."""
    return fates.groupBy("fate").agg(F.count("*").alias("n"))


def absorb(source: Taxonomy, union: Taxonomy, **options) -> Merged:
    """Align and merge (M-15)."""
    return merge(source, union, align.align(source, union, **options))
