"""How far apart homonyms are: densities and uncertainties of all pairs, without making the pairs (A-8, A-9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.operators import tree
from grovespark.storage import settle


def weight_before(rows: DataFrame, keys: list[Column], weight: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the weight of all rows whose ``keys`` sort before theirs; equal keys share it.

    Keys are dealt out by ranges, summed by range, and added up within ranges, so no task sees all rows: ranges meet
    as one row each.
    """
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    cols = [f"_k{i}" for i in range(len(keys))]
    once = rows.select(*named, weight).groupBy(*cols).agg(F.sum(weight).alias("_w"))
    ranged = settle(once.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("_part").agg(F.sum("_w").alias("_s"))
    earlier = sums.select(F.col("_part").alias("_p"), F.col("_s").alias("_e"))
    offsets = sums.join(F.broadcast(earlier), F.col("_p") < F.col("_part"), "left").groupBy("_part").agg(F.coalesce(F.sum("_e"), F.lit(0)).alias("_o"))  # a row per range
    w = Window.partitionBy("_part").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    ranks = ranged.withColumn("_b", F.coalesce(F.sum("_w").over(w), F.lit(0))).join(F.broadcast(offsets), "_part").select(*cols, (F.col("_b") + F.col("_o")).alias(out))
    return rows.withColumns({f"_k{i}": k for i, k in enumerate(keys)}).join(ranks, cols).drop(*cols)


def partings(pathed: DataFrame, synonyms: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, mrca, child, low, high, larger, pairs, primary, tips): where homonyms part.

    Two visible nodes of one name that lie under different children of their common clade are a pair; its ``low`` is the size
    of the smaller child. For each name, clade and child: how many pairs the child's nodes make with those under larger
    children (ties: the larger uid), how many of these by primary names on both sides, and between tips. ``high`` is the clade's size and
    ``larger`` its largest child with the name. Nodes are counted by child and size, so a name with k nodes
    gives at most k times depth rows and not k * k pairs. A name that is a synonym on both sides makes no pair; a species, or a tip without rank whose name doesn't begin
    with ``uncultured``, is a tip.
    """
    tip = F.when(F.col("rank") == "no rank", (F.col("n_children") == 0) & ~F.col("name").startswith("uncultured")).otherwise(F.col("rank") == "species")
    seen = pathed.where(~tree.hidden() & F.col("name").isNotNull()).select("uid", "path", "name", F.coalesce(tip, F.lit(False)).alias("tip"))
    other = synonyms.join(seen.select("uid", "path", F.col("name").alias("own"), "tip"), "uid").where("name <> own").select("uid", "path", "name", "tip", F.lit(0).alias("main")).distinct()
    every = seen.select("uid", "path", "name", "tip", F.lit(1).alias("main")).union(other)
    many = every.groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name")
    steps = every.join(many, "name", "left_semi").select("name", "tip", "main", F.posexplode("path").alias("at", "mrca"), F.col("path").alias("p")).withColumn("child", F.get("p", F.col("at") + 1)).where("child IS NOT NULL")
    by_child = steps.groupBy("name", "mrca", "child").agg(F.count("*").alias("k"), F.sum("main").alias("m"), F.sum(F.when(F.col("tip"), F.col("main")).otherwise(0)).alias("t"), F.sum(F.when(F.col("tip"), 1).otherwise(0)).alias("a"))
    several = by_child.groupBy("name", "mrca").agg(F.count("*").alias("c")).where("c > 1").select("name", "mrca")
    size = counts.select("uid", "n_nodes")
    sized = by_child.join(several, ["name", "mrca"], "left_semi").join(size.select(F.col("uid").alias("child"), F.col("n_nodes").alias("low")), "child")
    # Children above in the order of size: those of a larger size in all, and of the same size by uid.
    by_size = settle(sized.groupBy("name", "mrca", "low").agg(*(F.sum(c).alias(c) for c in "kmta"), F.max("child").alias("last")))
    up = Window.partitionBy("name", "mrca").orderBy(F.desc("low")).rowsBetween(Window.unboundedPreceding, -1)
    above = by_size.select("name", "mrca", "low", *(F.coalesce(F.sum(c).over(up), F.lit(0)).alias(f"{c}_up") for c in "kmta"))
    same = Window.partitionBy("name", "mrca", "low").orderBy(F.desc("child")).rowsBetween(Window.unboundedPreceding, -1)
    own = sized.select("name", "mrca", "child", "low", *"kmta", *(F.coalesce(F.sum(c).over(same), F.lit(0)).alias(f"{c}_eq") for c in "kmta"))
    top = by_size.groupBy("name", "mrca").agg(F.max_by("last", "low").alias("larger"))
    d = own.join(above, ["name", "mrca", "low"])
    k, m, t, a = ((F.col(f"{c}_up") + F.col(f"{c}_eq")) for c in "kmta")
    # Pairs with a primary name on one side at least: all but those of two synonyms.
    d = d.withColumns({"pairs": F.col("k") * k - (F.col("k") - F.col("m")) * (k - m), "primary": F.col("m") * m, "tips": F.col("a") * a - (F.col("a") - F.col("t")) * (a - t)})
    d = d.where("pairs > 0").join(top, ["name", "mrca"]).join(size.select(F.col("uid").alias("mrca"), F.col("n_nodes").alias("high")), "mrca")
    return d.select("name", "mrca", "child", "low", "high", "larger", "pairs", "primary", "tips")


def density(parted: DataFrame, counts: DataFrame, buckets: int = 100, shown: int | None = None) -> DataFrame:
    """(bucket, start, primary, pairs, tips, sample, division) (A-8): homonym pairs by the size of their smaller side.

    The buckets divide the size of the largest tree evenly; ``shown`` are given, half of them where it is null. ``sample`` is the first name whose pairs are tips,
    or else the first, and ``division`` the largest clade on its other side.
    """
    width = counts.agg(F.ceil(F.max("n_nodes") / buckets).cast("bigint").alias("width"))
    every = counts.sparkSession.range(buckets // 2 if shown is None else shown).select(F.col("id").alias("bucket"))
    placed = parted.crossJoin(F.broadcast(width)).withColumn("bucket", F.floor((F.col("low") - 1) / F.col("width")))  # one row
    first = F.min(F.struct((F.col("tips") == 0).alias("o"), "name", "larger")).alias("first")
    found = placed.groupBy("bucket").agg(F.sum("primary").alias("primary"), F.sum("pairs").alias("pairs"), F.sum("tips").alias("tips"), first)
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("primary", "pairs", "tips")]
    return every.crossJoin(F.broadcast(width)).join(found, "bucket", "left").select("bucket", (F.col("bucket") * F.col("width")).alias("start"), *zero, F.col("first.name").alias("sample"), F.col("first.larger").alias("division"))


def uncertainty(parted: DataFrame) -> DataFrame:
    """(name, low, high, loser, mrca, pairs, doubt) (A-9): where tips part, the least certain first.

    A pair is doubtful if its smaller side is large, and if the common clade is small. Pairs get a rank by (low descending, high) and one by
    (high, low descending), each the number of pairs before it; ``doubt`` is their sum. A row stands for all ``pairs`` that a child's tips make.
    """
    d = parted.where("tips > 0").select("name", "low", "high", F.col("child").alias("loser"), "mrca", F.col("tips").alias("pairs"))
    d = weight_before(settle(d), [-F.col("low"), F.col("high")], "pairs", "u1")
    d = weight_before(d, [F.col("high"), -F.col("low")], "pairs", "u2")
    return d.select("name", "low", "high", "loser", "mrca", "pairs", (F.col("u1") + F.col("u2")).alias("doubt")).orderBy("doubt", "name", "loser")


def types(pathed: DataFrame, synonyms: DataFrame, counts: DataFrame, divisions: DataFrame | None = None, suspect: int = 10_000, true: int = 100_000) -> DataFrame:
    """(name, mrca, type, n): how many pairs of homonyms that part at a clade are of each type (A-10).

    A pair is two visible nodes that bear a name, as their own or as a synonym, each node once. The first that holds: ``siblings``; ``synonyms`` on both sides;
    ``divisions`` are disjoint (uid of nodes of this tree); ``nested`` one in the other (mrca is the outer one); ``lineage``, one is itself a child of the clade; ``internal``,
    one has more than two nodes; ``tip-synonym``; and, by the size of both children of the clade together, ``tip-duplicate`` below ``suspect``,
    ``tip-suspect`` below ``true``, ``tip-true``. Names that begin with ``uncultured`` are left out.

    Pairs are not made. Nodes are counted by clade, child and kind; only for tips the child's size, at most ``true``, is part of
    the kind. Children of k different sizes hold k * k / 2 nodes at least, so pairs of kinds grow with the nodes.
    """
    seen = pathed.where(~tree.hidden()).select("uid", "path", F.col("name").alias("own"))
    if divisions is not None:
        seen = tree.with_division(seen, divisions)
    else:
        seen = seen.withColumn("division", F.lit(None).cast("string"))
    size = counts.select("uid", "n_nodes")
    seen = seen.join(size, "uid").select("uid", "path", "own", (F.col("n_nodes") > 2).alias("big"), F.array_position("path", F.col("division")).alias("div_at"))
    primary = seen.where("own IS NOT NULL").select("uid", F.col("own").alias("name"))
    named = primary.union(synonyms.where("name IS NOT NULL").select("uid", "name")).distinct().where("NOT name LIKE 'uncultured%'")
    every = named.join(seen, "uid").withColumn("main", F.col("own").eqNullSafe(F.col("name")))
    many = every.groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name")
    every = settle(every.join(many, "name", "left_semi").select("name", "uid", "path", "main", "big", "div_at"))
    steps = every.select("name", "uid", "main", "big", "div_at", F.posexplode("path").alias("at", "mrca"), F.get("path", F.col("at") + 1).alias("child"))
    below = F.coalesce(F.col("div_at") > F.col("at") + 1, F.lit(False))
    steps = steps.where("child IS NOT NULL").withColumns({"self": F.col("child") == F.col("uid"), "apart": below})
    # Who lies under another bearer of the name: pairs without a parting.
    outer = every.select("name", F.col("uid").alias("mrca"), F.col("main").alias("outer_main"))
    nested = steps.join(outer, ["name", "mrca"]).groupBy("name", "mrca", F.when(F.col("main") | F.col("outer_main"), "nested").otherwise("synonyms").alias("type")).agg(F.count("*").alias("n"))
    tip = F.col("main") & ~F.col("self") & ~F.col("big")
    by_child = steps.join(size.select(F.col("uid").alias("child"), F.least("n_nodes", F.lit(true)).alias("s")), "child").withColumn("kind", F.struct("self", "big", "main", "apart", F.when(tip, F.col("s")).alias("s")))
    by_child = by_child.groupBy("name", "mrca", "child", "kind").agg(F.count("*").alias("k"))
    several = by_child.groupBy("name", "mrca").agg((F.min("child") != F.max("child")).alias("part")).where("part").select("name", "mrca")
    by_child = settle(by_child.join(several, ["name", "mrca"], "left_semi"))

    def met(rows: DataFrame, sign: int, *keys: str) -> DataFrame:
        """Twice the pairs of kinds, those of a node with itself included."""
        other = rows.select(*keys, F.col("kind").alias("other"), F.col("k").alias("l"))
        return rows.join(other, list(keys)).select("name", "mrca", "kind", "other", (F.col("k") * F.col("l") * sign).alias("twice"))

    kinds = by_child.groupBy("name", "mrca", "kind").agg(F.sum("k").alias("k"))
    twice = met(kinds, 1, "name", "mrca").union(met(by_child, -1, "name", "mrca", "child"))
    a, b = F.col("kind"), F.col("other")
    total = a["s"] + b["s"]
    label = (
        F.when(a["self"] & b["self"], "siblings").when(~a["main"] & ~b["main"], "synonyms").when(a["apart"] & b["apart"], "divisions").when(a["self"] | b["self"], "lineage")
        .when(a["big"] | b["big"], "internal").when(~a["main"] | ~b["main"], "tip-synonym").when(total < suspect, "tip-duplicate").when(total < true, "tip-suspect").otherwise("tip-true")
    )
    parted = twice.groupBy("name", "mrca", label.alias("type")).agg(F.sum("twice").alias("twice")).where("twice > 0").select("name", "mrca", "type", F.expr("twice div 2").alias("n"))
    return parted.union(nested).groupBy("name", "mrca", "type").agg(F.sum("n").alias("n"))
