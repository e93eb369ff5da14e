"""Aligning the nodes of one forest to another: candidates, heuristics, ranked elimination (J-*)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.functions import codecs, paths
from grovespark.model import FAMILY, GENUS, Taxonomy
from grovespark.operators import divisions as divs
from grovespark.operators import tree
from grovespark.operators.divisions import Skeleton
from grovespark.storage import settle

ANSWERS = "src string, tgt string, value int, reason string"


def names(tax: Taxonomy, common: bool = True) -> DataFrame:
    """(uid, name, mode): primary names (C) and synonyms (S) (P-1); ``common``: whether common names count."""
    synonyms = tax.synonyms if common else tax.synonyms.where("type <> 'common name'")
    return tax.nodes.where("name IS NOT NULL").select("uid", "name", F.lit("C").alias("mode")).union(synonyms.select("uid", "name", F.lit("S").alias("mode")))


def unique_qids(nodes: DataFrame) -> DataFrame:
    """(qid, uid) of the ids that exactly one node has (P-4)."""
    own = nodes.select("uid", F.explode("source_ids").alias("q")).select("uid", codecs.print_qid(F.col("q")).alias("qid"))
    return own.groupBy("qid").agg(F.min("uid").alias("uid"), F.max("uid").alias("other")).where("uid = other").select("qid", "uid")


def candidates(src: Taxonomy, tgt: Taxonomy) -> DataFrame:
    """(src, tgt, modes): by any name, by a shared id, and for names with a space and no candidate by gender (J-1 to J-3)."""
    own = names(src, common=False).select(F.col("uid").alias("src"), "name", F.col("mode").alias("ms"))
    other = names(tgt).select(F.col("uid").alias("tgt"), "name", F.col("mode").alias("mt"))
    by_name = own.join(other, "name").select("src", "tgt", F.concat("ms", "mt").alias("mode"))
    ids = src.nodes.select(F.col("uid").alias("src"), F.posexplode("source_ids").alias("nth", "q")).select("src", "nth", codecs.print_qid(F.col("q")).alias("qid"))
    first = tgt.nodes.select(F.col("uid").alias("tgt"), codecs.print_qid(F.get("source_ids", F.lit(0))).alias("first"))
    by_id = ids.join(unique_qids(tgt.nodes).withColumnRenamed("uid", "tgt"), "qid").join(first, "tgt")
    by_id = by_id.select("src", "tgt", F.concat(F.lit("C"), F.when(F.col("nth") == 0, "I").otherwise("J"), F.when(F.col("first") == F.col("qid"), "I").otherwise("J"), F.lit("C")).alias("mode"))
    found = by_name.union(by_id)
    without = src.nodes.select(F.col("uid").alias("src"), codecs.gender_variant(F.col("name")).alias("name")).where("name IS NOT NULL").join(found.select("src"), "src", "left_anti")
    by_gender = without.join(other, "name").select("src", "tgt", F.concat(F.lit("G"), "mt").alias("mode"))
    return found.union(by_gender).groupBy("src", "tgt").agg(F.concat_ws(" ", F.sort_array(F.collect_list("mode"))).alias("modes"))


def candidate_counts(src: Taxonomy, tgt: Taxonomy) -> DataFrame:
    """(src, n): how many ``candidates`` each source node has, without the pairs.

    The nodes of a name are counted once for all sources that have it. What several names of a source find twice is taken off by sets of names:
    nodes are counted by the pairs of names that they bear, so only names that some node bears together meet.
    """
    own, other = settle(names(src, common=False).select(F.col("uid").alias("src"), "name").distinct()), settle(names(tgt).select(F.col("uid").alias("tgt"), "name").distinct())
    size = settle(other.groupBy("name").agg(F.count("*").alias("n")))

    def several(nodes: DataFrame, uid: str) -> DataFrame:
        return nodes.groupBy(uid).agg(F.sort_array(F.collect_list("name")).alias("all")).where("size(all) > 1")

    # The k common names of a node and a source count k times there, and should count once.
    mine = settle(several(own, "src"))
    kinds_s = mine.select("all").distinct().select(F.col("all").alias("all_s"))
    kinds_t = several(other, "tgt").groupBy(F.col("all").alias("all_t")).agg(F.count("*").alias("nodes"))
    meet = kinds_s.select("all_s", F.explode("all_s").alias("name")).join(kinds_t.select("all_t", "nodes", F.explode("all_t").alias("name")), "name")
    twice = meet.groupBy("all_s", "all_t").agg(F.first("nodes").alias("nodes"), F.count("*").alias("k")).where("k > 1").groupBy("all_s").agg(F.sum(-F.col("nodes") * (F.col("k") - 1)).alias("n"))
    twice = mine.join(twice, F.col("all") == F.col("all_s")).select("src", "n")
    by_name = own.join(size, "name").select("src", "n")

    ids = src.nodes.select(F.col("uid").alias("src"), F.explode("source_ids").alias("q")).select("src", codecs.print_qid(F.col("q")).alias("qid"))
    by_id = settle(ids.join(unique_qids(tgt.nodes).withColumnRenamed("uid", "tgt"), "qid").select("src", "tgt").distinct())
    named = by_id.join(own, "src").join(other, ["tgt", "name"], "left_semi").select("src", "tgt")
    by_id_alone = by_id.join(named, ["src", "tgt"], "left_anti").select("src", F.lit(1).cast("long").alias("n"))
    found = settle(by_name.union(twice).union(by_id_alone).groupBy("src").agg(F.sum("n").alias("n")))
    without = src.nodes.select(F.col("uid").alias("src"), codecs.gender_variant(F.col("name")).alias("name")).where("name IS NOT NULL").distinct().join(found, "src", "left_anti")
    return found.union(without.join(size, "name").groupBy("src").agg(F.sum("n").alias("n")))


def described(pathed: DataFrame, other: Taxonomy, divisions: DataFrame | None, side: str) -> DataFrame:
    """What the heuristics need of each node, with names that end in ``side``.

    ``divisions``: (uid, path), or (uid, division, path) where the nodes that bear divisions have uids of their own.
    """
    named = pathed.select(F.col("uid").alias("anc"), F.col("name").alias("anc_name"))
    quasi = tree.quasi_parent(pathed, names(other))
    # The names on the quasi-parent's own line.
    line = quasi.join(pathed.select(F.col("uid").alias("quasi"), F.col("path").alias("qp")), "quasi").select("uid", "quasi_name", F.explode("qp").alias("anc")).join(named, "anc").groupBy("uid", "quasi_name").agg(F.collect_set("anc_name").alias("line"))
    out = pathed.join(line, "uid", "left")
    if divisions is not None:
        own = divisions.select(F.col("uid").alias("bearer"), F.col("division" if "division" in divisions.columns else "uid").alias("division"), F.col("path").alias("division_path"))
        out = tree.with_division(out, divisions).withColumnRenamed("division", "bearer").join(own, "bearer", "left").drop("bearer")
    else:
        out = out.withColumns({"division": F.lit(None).cast("string"), "division_path": F.lit(None).cast("array<string>")})
    keep = {"uid": "", "name": "", "rank": "", "n_children": "", "source_ids": "", "quasi_name": "", "line": "", "division": "", "division_path": ""}
    return out.select(*(F.col(c).alias(f"{c}_{side}") for c in keep))


def overlaps(src_pathed: DataFrame, tgt_pathed: DataFrame, aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """(src, tgt, n_in, n_all) of the candidate ``pairs``: of the aligned nodes under src, how many images are under tgt (J-7).

    Aligned nodes meet only the candidates of the nodes above them, so no path is multiplied by another.
    """
    a = src_pathed.select(F.col("uid").alias("s"), F.col("path").alias("sp")).join(aligned.select(F.col("src").alias("s"), F.col("tgt").alias("t")), "s").join(tgt_pathed.select(F.col("uid").alias("t"), F.col("path").alias("tp")), "t")
    wanted = pairs.select("src", "tgt").distinct()
    up = a.select(F.explode("sp").alias("src"), "tp").join(wanted.select("src").distinct(), "src", "left_semi")
    total = up.groupBy("src").agg(F.count("*").alias("n_all"))
    return up.join(wanted, "src").where(F.array_contains("tp", F.col("tgt"))).groupBy("src", "tgt").agg(F.count("*").alias("n_in")).join(total, "src")


def h_division(ctx: dict) -> Column:
    a, b = F.col("division_path_s"), F.col("division_path_t")
    return F.when(F.col("division_s").isNotNull() & F.col("division_t").isNotNull() & (F.col("division_s") != F.col("division_t")) & paths.divergence(a, b).isNotNull(), -3).otherwise(0)


def h_ranks(ctx: dict) -> Column:
    a, b = codecs.rank_level("rank_s"), codecs.rank_level("rank_t")
    return F.when((a >= 0) & (b >= 0) & (((a >= GENUS) & (b <= FAMILY)) | ((a <= FAMILY) & (b >= GENUS))), -3).otherwise(0)


def h_lineage(ctx: dict) -> Column:
    near = (F.col("quasi_name_s") == F.col("quasi_name_t")) | F.array_contains("line_t", F.col("quasi_name_s")) | F.array_contains("line_s", F.col("quasi_name_t"))
    return F.when(F.coalesce(near, F.lit(False)), 3).otherwise(0)


def h_overlap(ctx: dict) -> Column:
    if not ctx.get("overlap"):
        return F.lit(0)
    both = (F.col("n_children_s") > 0) & (F.col("n_children_t") > 0) & (F.coalesce("n_in", F.lit(0)) > 0)
    return F.when(both & (F.col("n_in") == F.col("n_all")), 3).when(both, 2).otherwise(0)


def h_weak_division(ctx: dict) -> Column:
    return F.when(F.coalesce(F.col("division_s") != F.col("division_t"), F.lit(False)), -1).otherwise(0)


def h_name(ctx: dict) -> Column:
    return F.when(F.coalesce(F.col("name_s") == F.col("name_t"), F.lit(False)), 3).otherwise(0)


def _first_qid(side: str, idspace: str) -> Column:
    own = F.struct(F.lit(idspace).alias("prefix"), F.col(f"uid_{side}").alias("id"))
    return F.when(F.size(f"source_ids_{side}") > 0, F.get(f"source_ids_{side}", F.lit(0))).otherwise(own)


def h_source_id(ctx: dict) -> Column:
    return F.when(F.coalesce(_first_qid("s", ctx["src_idspace"]) == _first_qid("t", ctx["tgt_idspace"]), F.lit(False)), 2).otherwise(0)


def h_any_source_id(ctx: dict) -> Column:
    """An id in common other than by the first of both."""
    a, b = F.col("source_ids_s"), F.col("source_ids_t")
    rest = F.arrays_overlap(F.slice(a, F.lit(2), F.greatest(F.size(a), F.lit(1))), b) | F.arrays_overlap(a, F.slice(b, F.lit(2), F.greatest(F.size(b), F.lit(1))))
    return F.when((F.size(a) > 0) & (F.size(b) > 0) & F.coalesce(rest, F.lit(False)), 2).otherwise(0)


# Further heuristics, not in the standard list (J-12).


def h_same_division(ctx: dict) -> Column:
    return F.when(F.col("division_s").eqNullSafe(F.col("division_t")), 2).otherwise(0)


def h_disjoint(ctx: dict) -> Column:
    return F.when((F.col("n_children_s") > 0) & (F.col("n_children_t") > 0) & (F.coalesce("n_in", F.lit(0)) == 0) & (F.coalesce("n_all", F.lit(0)) > 0), -2).otherwise(0)


def h_same_rank(ctx: dict) -> Column:
    return F.when(F.col("rank_s") == F.col("rank_t"), 1).otherwise(0)


def h_only_candidate(ctx: dict) -> Column:
    return F.lit(1)


Heuristic = tuple[str, Callable[[dict], Column]]
CRITERIA: tuple[Heuristic, ...] = (
    ("disjoint divisions", h_division), ("disparate ranks", h_ranks), ("by lineage", h_lineage), ("overlapping membership", h_overlap),
    ("same-division-weak", h_weak_division), ("by name", h_name), ("by source id", h_source_id), ("any source id in common", h_any_source_id),
)


def scored(pairs: DataFrame, src_info: DataFrame, tgt_info: DataFrame, ctx: dict, criteria: Sequence[Heuristic] = CRITERIA) -> DataFrame:
    """``pairs`` (src, tgt) with a column for each heuristic's score; each is a row of ``eliminate`` of its own."""
    j = pairs.join(src_info, F.col("src") == F.col("uid_s")).join(tgt_info, F.col("tgt") == F.col("uid_t"))
    if ctx.get("overlap") is not None and not isinstance(ctx["overlap"], bool):
        j = j.join(ctx["overlap"], ["src", "tgt"], "left")
    return j.select("src", F.col("tgt").alias("low"), F.col("tgt").alias("high"), F.lit(1).cast("long").alias("weight"), "n_children_s", *(f(ctx).cast("int").alias(f"s{i}") for i, (_, f) in enumerate(criteria)))


#: What target nodes of one name may differ in, apart from lineage, ids and members.
DENSE = ("division_t", "division_path_t", "rank_t", "prime", "inner")


@dataclass(frozen=True)
class Groups:
    """The target nodes of every name by what the heuristics see of them."""

    #: (name, tgt, group, part): the nodes.
    members: DataFrame
    #: (name, group, n, low, high).
    groups: DataFrame
    #: (src, name, group, part, n, low, high): the parts of groups on the line of a source.
    on_line: DataFrame


def grouped(own: DataFrame, other: DataFrame, si: DataFrame, ti: DataFrame) -> Groups:
    """The groups that sources ``own`` (src, name) meet among ``other`` (tgt, name).

    The target nodes of a name fall into few groups by division, rank and whether it is their primary name, and those
    into parts by their lineage. The parts on the lineage of a source are found by joins on the names of lines. ``low`` and
    ``high`` are the smallest and largest uid of a group of ``n``.
    """
    told = other.join(ti, F.col("tgt") == F.col("uid_t")).withColumn("prime", F.coalesce(F.col("name") == F.col("name_t"), F.lit(False))).withColumn("inner", F.col("n_children_t") > 0)
    members = settle(told.select("name", "tgt", F.struct(*DENSE).alias("group"), F.when(F.col("quasi_name_t").isNotNull(), F.struct(*DENSE, "quasi_name_t", "line_t")).alias("part")))
    count = [F.count("*").alias("n"), F.min("tgt").alias("low"), F.max("tgt").alias("high")]
    groups, parts = members.groupBy("name", "group").agg(*count), settle(members.where("part IS NOT NULL").groupBy("name", "group", "part").agg(*count))
    lines = own.join(si.select(F.col("uid_s").alias("src"), "quasi_name_s", "line_s"), "src").where("quasi_name_s IS NOT NULL").select("src", "name", F.struct("quasi_name_s", "line_s").alias("line"))
    kinds = settle(lines.select("name", "line").distinct())
    down = parts.select("name", "part", F.explode("part.line_t").alias("at")).join(kinds.select("name", "line", F.col("line.quasi_name_s").alias("at")), ["name", "at"])
    up = kinds.select("name", "line", F.explode("line.line_s").alias("at")).join(parts.select("name", "part", F.col("part.quasi_name_t").alias("at")), ["name", "at"])
    near = down.select("name", "line", "part").union(up.select("name", "line", "part")).distinct().join(parts, ["name", "part"])
    on_line = settle(lines.join(near, ["name", "line"]).select("src", "name", "group", "part", "n", "low", "high"))
    return Groups(members, settle(groups), on_line)


def group_rows(own: DataFrame, g: Groups, sparse: DataFrame) -> DataFrame:
    """The candidates of every source node as groups that no heuristic tells apart, not as pairs.

    A source has a row for each group of its name with the nodes that are in no row below, one for each part of it on
    its lineage, and one for each node of ``sparse`` (src, tgt): those that share an id or a member with it. So rows are a
    partition of the candidates with a ``weight``, and their number grows with the nodes, not with the pairs.
    """
    keys, one, none = ["src", "name", "group"], F.lit(1).cast("long"), F.lit(None).cast("string")
    members, on_line = g.members, g.on_line.join(own, ["src", "name"], "left_semi")
    alone = settle(own.join(sparse.select("src", "tgt").distinct(), "src").join(members, ["name", "tgt"]).select("src", "name", "tgt", "group", "part"))
    inside = alone.join(on_line.select("src", "part", F.lit(True).alias("lined")), ["src", "part"], "left")
    # What is taken out of a group: how many, and the uids that could stand for its rest but are no part of it.
    ends = on_line.select(*keys, F.col("n").alias("k"), F.array("low", "high").alias("u")).union(inside.select(*keys, F.when(F.col("lined"), 0).otherwise(1).cast("long"), F.array("tgt")))
    taken = ends.groupBy(*keys).agg(F.sum("k").alias("k"), F.flatten(F.collect_list("u")).alias("gone"))
    rest = own.join(g.groups, "name").join(taken, keys, "left").select(*keys, F.lit(None).cast(dict(members.dtypes)["part"]).alias("part"), "n", "low", "high", "k", "gone")
    cut = on_line.join(alone.groupBy("src", "part").agg(F.count("*").alias("k"), F.collect_list("tgt").alias("gone")), ["src", "part"], "left").select(*rest.columns)
    both = rest.union(cut).withColumns({"weight": F.col("n") - F.coalesce("k", F.lit(0)), "gone": F.coalesce("gone", F.array().cast("array<string>"))}).where("weight > 0")
    low, high = (F.when(~F.array_contains("gone", F.col(c)), F.col(c)) for c in ("low", "high"))
    both = settle(both.withColumns({"low": F.coalesce(low, high), "high": F.coalesce(high, low)}).select(*keys, "part", "low", "high", "weight"))
    # Where both ends are taken, another member stands for the rest.
    hard = both.where("low IS NULL").alias("r").join(members.alias("m"), (F.col("r.name") == F.col("m.name")) & (F.col("r.group") == F.col("m.group")) & (F.col("r.part").isNull() | F.col("r.part").eqNullSafe(F.col("m.part")))).select("r.src", "r.name", "r.group", "r.part", "r.weight", "m.tgt", F.col("m.part").alias("of"))
    hard = hard.join(alone.select("src", "tgt"), ["src", "tgt"], "left_anti").join(on_line.select("src", F.col("part").alias("of"), F.lit(True).alias("lined")), ["src", "of"], "left").where("part IS NOT NULL OR lined IS NULL")
    hard = hard.groupBy(*keys, "part", "weight").agg(F.min("tgt").alias("low"), F.max("tgt").alias("high"))
    single = alone.select(*keys, "part", "tgt", F.col("tgt").alias("low"), F.col("tgt").alias("high"), one.alias("weight"))
    return both.where("low IS NOT NULL").select(*keys, "part", none.alias("tgt"), "low", "high", "weight").union(hard.select(*keys, "part", none, "low", "high", "weight")).union(single)


def scored_groups(rows: DataFrame, si: DataFrame, ti: DataFrame, ctx: dict, criteria: Sequence[Heuristic] = CRITERIA) -> DataFrame:
    """``group_rows`` with a column for each heuristic's score."""
    ids = ti.select(F.col("uid_t").alias("tgt"), "name_t", "source_ids_t", F.col("n_children_t").alias("kids"))
    j = rows.join(si, F.col("src") == F.col("uid_s")).join(ids, "tgt", "left").withColumn("uid_t", F.col("tgt"))
    if ctx.get("overlap") is not None and not isinstance(ctx["overlap"], bool):
        of_all = ctx["overlap"].groupBy("src").agg(F.first("n_all").alias("n_all"))
        j = j.join(ctx["overlap"].select("src", "tgt", "n_in"), ["src", "tgt"], "left").join(of_all, "src", "left")
    # A group's nodes have the source's name as their own or none of them has.
    own_name = F.when(F.col("group.prime"), F.col("name"))
    whole = {"division_t": F.col("group.division_t"), "division_path_t": F.col("group.division_path_t"), "rank_t": F.col("group.rank_t"), "quasi_name_t": F.col("part.quasi_name_t"), "line_t": F.col("part.line_t"), "name_t": F.coalesce("name_t", own_name), "n_children_t": F.coalesce("kids", F.col("group.inner").cast("int")), "source_ids_t": F.coalesce("source_ids_t", F.array().cast(dict(ti.dtypes)["source_ids_t"]))}
    j = j.withColumns(whole)
    return j.select("src", "low", "high", "weight", "n_children_s", *(f(ctx).cast("int").alias(f"s{i}") for i, (_, f) in enumerate(criteria)))


ROUND = "struct<heuristic:string,score:int,before:bigint,after:bigint,loser:string>"


def eliminate(scores: DataFrame, criteria: Sequence[Heuristic] = CRITERIA) -> DataFrame:
    """(src, tgt, value, reason, n_first, n_left, rounds) by ranked elimination (J-13).

    Each heuristic in its order leaves the candidates of the highest score, if that is not negative; all rounds are
    windows over one partitioning by src. A source without candidate left is rejected; one that a heuristic cut down
    to one takes that heuristic as reason and the last score as value, which may be 0 and then is no alignment. ``rounds`` is the
    evidence (A-2): what each heuristic that was asked found best, how many candidates it met and left, and one that it put out (null if none).
    """
    w = Window.partitionBy("src")
    d = scores.withColumns({"alive": F.lit(True), "done": F.lit(False), "last": F.lit(-100), "decider": F.lit(None).cast("string"), "left": F.sum("weight").over(w), "rounds": F.array().cast(f"array<{ROUND}>")}).withColumn("at_first", F.col("left"))
    for i, (label, _) in enumerate(criteria):
        d = d.withColumn("top", F.max(F.when(F.col("alive"), F.col(f"s{i}"))).over(w))
        stay = F.col("alive") & (F.col(f"s{i}") == F.col("top")) & (F.col("top") >= 0)
        d = d.withColumns({"out": F.col("alive") & ~stay & ~F.col("done"), "alive": F.when(F.col("done"), F.col("alive")).otherwise(stay)})
        d = d.withColumns({"now": F.sum(F.when(F.col("alive"), F.col("weight")).otherwise(0)).over(w), "loser": F.max(F.when(F.col("out"), F.col("high"))).over(w)})
        d = d.withColumns({
            "decider": F.when(~F.col("done") & (F.col("now") == 1) & (F.col("left") > 1), label).otherwise(F.col("decider")),
            "last": F.when(F.col("done"), F.col("last")).otherwise(F.coalesce("top", "last")),
            "rounds": F.when(F.col("done"), F.col("rounds")).otherwise(F.array_append("rounds", F.struct(F.lit(label).alias("heuristic"), F.col("top").alias("score"), F.col("left").alias("before"), F.col("now").alias("after"), F.col("loser").alias("loser")))),
            "left": F.col("now"),
            "done": F.col("done") | (F.col("now") == 0) | ((F.col("now") == 1) & (F.coalesce("top", F.lit(0)) > 0)),
        })
    keep = [F.first(c).alias(n) for c, n in (("left", "n_left"), ("at_first", "n_first"), ("last", "last"), ("decider", "decider"), ("n_children_s", "n_children"), ("rounds", "rounds"))]
    best = d.groupBy("src").agg(*keep, F.min(F.when(F.col("alive"), F.col("low"))).alias("tgt"))
    one = F.col("n_left") == 1
    value = F.when(F.col("n_left") == 0, F.col("last")).when(one & F.col("decider").isNull() & (F.col("last") <= 0), 2).when(one, F.col("last")).otherwise(0)
    reason = F.when(F.col("n_left") == 0, "rejected").when(one, F.coalesce("decider", F.when(F.col("last") > 0, "confirmed").otherwise("by elimination"))).otherwise(F.when(F.col("n_children") > 0, "ambiguous internal").otherwise("ambiguous tip"))
    return best.select("src", F.when(one, F.col("tgt")).alias("tgt"), value.cast("int").alias("value"), reason.alias("reason"), "n_first", "n_left", "rounds")


def choices(answers: DataFrame) -> DataFrame:
    """(src, heuristic, score, winner, loser): where a heuristic cut several candidates down to one (A-4)."""
    r = answers.select("src", "tgt", F.explode("rounds").alias("r")).where("r.before > 1 AND r.after = 1")
    return r.select("src", "r.heuristic", "r.score", F.col("tgt").alias("winner"), "r.loser")


def evidence(answers: DataFrame, names_: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(name, src, nth, heuristic, score, before, after, loser, tgt, reason): the rounds of sources of interest (A-2).

    Of interest are sources with several candidates, those that end in a no, and those with a name in ``wanted`` (name). ``names_``: (uid, name).
    """
    d = answers.join(names_.select(F.col("uid").alias("src"), "name"), "src")
    if wanted is not None:
        d = d.join(wanted.select("name").distinct().withColumn("asked", F.lit(True)), "name", "left")
    else:
        d = d.withColumn("asked", F.lit(None).cast("boolean"))
    d = d.where((F.col("n_first") > 1) | (F.col("value") < 0) | F.coalesce("asked", F.lit(False)))
    return d.select("name", "src", F.posexplode("rounds").alias("nth", "r"), "tgt", "reason").select("name", "src", "nth", "r.*", "tgt", "reason")


def quasi_tips(src_pathed: DataFrame, answers: DataFrame) -> DataFrame:
    """The aligned nodes without an aligned descendant (J-14)."""
    yes = answers.where("value > 0")
    covered = src_pathed.join(yes.select(F.col("src").alias("uid")), "uid", "left_semi").select(F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("src")).distinct()
    return yes.join(covered, "src", "left_anti")


def overlap_pairs(src_pathed: DataFrame, tgt_pathed: DataFrame, aligned: DataFrame, own: DataFrame, other: DataFrame) -> DataFrame:
    """(src, tgt, n_in, n_all): as ``overlaps``, for all nodes of one name (``own``, ``other``) that share a member.

    Both lines of an aligned node meet by the node and the name, so only true overlaps are made.
    """
    a = settle(src_pathed.select(F.col("uid").alias("s"), F.col("path").alias("sp")).join(aligned.select(F.col("src").alias("s"), F.col("tgt").alias("t")), "s").join(tgt_pathed.select(F.col("uid").alias("t"), F.col("path").alias("tp")), "t"))
    up = a.select("s", F.explode("sp").alias("src"))
    total = up.groupBy("src").agg(F.count("*").alias("n_all"))
    both = up.join(own, "src").join(a.select("s", F.explode("tp").alias("tgt")).join(other, "tgt"), ["s", "name"])
    return both.select("s", "src", "tgt").groupBy("src", "tgt").agg(F.count("*").alias("n_in")).join(total, "src")


def align(src: Taxonomy, tgt: Taxonomy, divisions: DataFrame | None = None, curated: DataFrame | None = None, criteria: Sequence[Heuristic] = CRITERIA, skeleton: Skeleton | None = None) -> DataFrame:
    """(src, tgt, value, reason, n_first, n_left, rounds) for every source node with a candidate.

    First all nodes are tried without the overlap of members; the aligned ones without aligned descendants count as
    members. Then the nodes above them are tried again with the overlap. ``curated`` (src, tgt) comes before both.
    With a ``skeleton`` the source's divisions are found by name and aligned to the union's (J-15), before all but what is curated, and
    the nodes below them are told apart by them (J-4, J-8); ``divisions`` are those of both sides, where they share uids.
    Sources with one name meet groups of candidates; those with synonyms, or with a candidate by id alone, meet each.
    """
    sp, tp = settle(tree.with_children(tree.with_path(src.nodes))), settle(tree.with_children(tree.with_path(tgt.nodes)))
    divisions_s = divisions_t = divisions
    if curated is not None:
        curated = curated.select("src", "tgt", F.lit("curated").alias("reason"))
    if skeleton is not None:
        known = curated.select("src", "tgt") if curated is not None else skeleton.images.select("src", "tgt").where("false")
        found = divs.marked(sp, src.synonyms, skeleton, tgt.nodes, known)
        divisions_s = settle(divs.of_side(skeleton, found.select(F.col("src").alias("uid"), "division")))
        divisions_t = settle(divs.of_side(skeleton, skeleton.images.select(F.col("tgt").alias("uid"), F.col("src").alias("division"))))
        by_division = found.join(known, "src", "left_anti").select("src", "tgt", F.lit(divs.BY_DIVISION).alias("reason"))
        curated = settle(by_division if curated is None else curated.union(by_division))
    mine, other = names(src, common=False).select(F.col("uid").alias("src"), "name").distinct(), settle(names(tgt).select(F.col("uid").alias("tgt"), "name").distinct())
    if curated is not None:
        mine = mine.join(curated.select("src"), "src", "left_anti")
    mine = settle(mine)
    ids = src.nodes.select(F.col("uid").alias("src"), F.explode("source_ids").alias("q")).select("src", codecs.print_qid(F.col("q")).alias("qid"))
    by_id = settle(ids.join(unique_qids(tgt.nodes).withColumnRenamed("uid", "tgt"), "qid").select("src", "tgt").distinct())
    by_name = mine.join(other, "name", "left_semi").select("src").distinct()
    without = mine.select("src").distinct().join(by_name, "src", "left_anti").join(by_id, "src", "left_anti")
    gender = src.nodes.join(without, F.col("uid") == F.col("src"), "left_semi").select(F.col("uid").alias("src"), codecs.gender_variant(F.col("name")).alias("name")).where("name IS NOT NULL")
    several = mine.groupBy("src").agg(F.count("*").alias("k")).where("k > 1").select("src")
    named = by_id.join(mine, "src").join(other, ["tgt", "name"], "left_semi").select("src", "tgt")
    each = settle(several.union(by_id.join(named, ["src", "tgt"], "left_anti").select("src")).distinct())
    if curated is not None:
        each = each.join(curated.select("src"), "src", "left_anti")
    own = settle(mine.join(each, "src", "left_anti").union(gender.join(each, "src", "left_anti")).join(other, "name", "left_semi"))
    pairs = settle(candidates(src.with_nodes(src.nodes.join(each, F.col("uid") == F.col("src"), "left_semi")), tgt).join(each, "src", "left_semi").select("src", "tgt"))
    si, ti = settle(described(sp, tgt, divisions_s, "s")), settle(described(tp, src, divisions_t, "t"))
    ctx = {"src_idspace": src.idspace, "tgt_idspace": tgt.idspace, "overlap": False}

    def qids(info: DataFrame, side: str, idspace: str, uid: str) -> DataFrame:
        first = codecs.print_qid(_first_qid(side, idspace))
        return info.select(F.col(f"uid_{side}").alias(uid), F.explode(F.array_distinct(F.concat(F.array(first), F.transform(f"source_ids_{side}", codecs.print_qid)))).alias("qid"))

    shared = own.join(qids(si, "s", src.idspace, "src"), "src").join(other.join(qids(ti, "t", tgt.idspace, "tgt"), "tgt"), ["name", "qid"]).select("src", "tgt")

    def tried(own: DataFrame, sparse: DataFrame, pairs: DataFrame) -> DataFrame:
        rows = settle(group_rows(own, groups, sparse))
        found = scored_groups(rows, si, ti, ctx, criteria)
        if not pairs.isEmpty():
            found = found.union(scored(pairs, si, ti, ctx, criteria))
        found = eliminate(found, criteria)
        return settle(found)

    groups = grouped(own, other, si, ti)
    first = tried(own, shared, pairs)
    if curated is not None:
        one = F.lit(1).cast("long")
        fixed = curated.select("src", "tgt", F.lit(3).alias("value"), "reason", one.alias("n_first"), one.alias("n_left"), F.array().cast(f"array<{ROUND}>").alias("rounds"))
        first = settle(first.union(fixed))
    low = settle(quasi_tips(sp, first))
    above = sp.join(low.select(F.col("src").alias("uid")), "uid", "left_semi").select(F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("src")).distinct()
    if curated is not None:
        above = above.join(curated.select("src"), "src", "left_anti")
    above = settle(above)
    again, pairs_again = own.join(above, "src", "left_semi"), settle(pairs.join(above, "src", "left_semi"))
    common = settle(overlap_pairs(sp, tp, low, again, other))
    ctx["overlap"] = common if pairs_again.isEmpty() else settle(common.union(overlaps(sp, tp, low, pairs_again).select(*common.columns)))
    second = tried(again, shared.join(above, "src", "left_semi").union(common.select("src", "tgt")), pairs_again)
    return settle(first.join(above, "src", "left_anti").union(second))


def target_mrcas(src_nodes: DataFrame, tgt_pathed: DataFrame, answers: DataFrame) -> DataFrame:
    """(src, lub): the common clade of the parents of the images of a node's placed children (J-17)."""
    from grovespark.model import UNPLACED_ANY

    kids = src_nodes.where("parent_uid IS NOT NULL").where(~codecs.has(F.col("proper_flags"), UNPLACED_ANY)).select(F.col("parent_uid").alias("src"), F.col("uid").alias("kid"))
    images = kids.join(answers.where("value > 0").select(F.col("src").alias("kid"), "tgt"), "kid").join(tgt_pathed.select(F.col("uid").alias("tgt"), F.expr("slice(path, 1, size(path) - 1)").alias("up")), "tgt").where("size(up) > 0")
    return images.groupBy("src").agg(paths.set_mrca_path("up").alias("m")).where("size(m) > 0").select("src", F.element_at("m", -1).alias("lub"))


def bridges(src_pathed: DataFrame, answers: DataFrame) -> DataFrame:
    """(src, image): the image of the nearest aligned ancestor-or-self (J-18)."""
    up = src_pathed.select(F.col("uid").alias("src"), F.posexplode("path").alias("nth", "anc"))
    return up.join(answers.where("value > 0").select(F.col("src").alias("anc"), "tgt"), "anc").groupBy("src").agg(F.max_by("tgt", "nth").alias("image"))


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """(change, n): sources gained, lost, moved and kept between two alignments (J-19)."""
    a, b = before.where("value > 0").select("src", F.col("tgt").alias("x")), after.where("value > 0").select("src", F.col("tgt").alias("y"))
    change = F.when(F.col("x").isNull(), "gained").when(F.col("y").isNull(), "lost").when(F.col("x") != F.col("y"), "moved").otherwise("kept")
    return a.join(b, "src", "full").groupBy(change.alias("change")).agg(F.count("*").alias("n"))


def align_by_membership(src_pathed: DataFrame, tgt_pathed: DataFrame) -> DataFrame:
    """(src, tgt): inner nodes that are each other's common clade, from tips with the same unique name (J-20)."""
    def unique(p: DataFrame, c: str) -> DataFrame:
        return p.where("n_children = 0").groupBy("name").agg(F.min("uid").alias(c), F.count("*").alias("k")).where("k = 1").select("name", c)

    tips = settle(unique(src_pathed, "s").join(unique(tgt_pathed, "t"), "name").select("s", "t"))

    def half(p: DataFrame, q: DataFrame, own: str, other: str) -> DataFrame:
        up = p.select(F.col("uid").alias(own), "path").join(tips, own).select(F.explode("path").alias("node"), other)
        m = up.join(q.select(F.col("uid").alias(other), F.col("path").alias("op")), other).groupBy("node").agg(paths.set_mrca_path("op").alias("m"))
        return m.select("node", F.element_at("m", -1).alias("image"))

    there, back = half(src_pathed, tgt_pathed, "s", "t"), half(tgt_pathed, src_pathed, "t", "s")
    return there.select(F.col("node").alias("src"), F.col("image").alias("tgt")).join(back.select(F.col("node").alias("tgt"), F.col("image").alias("src")), ["src", "tgt"])
