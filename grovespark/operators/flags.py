"""Flag inference down and up the tree (F-1 to F-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.functions import codecs
from grovespark.model import BIT, INFERRED_ONLY, SPECIES, UNPLACED_ANY
from grovespark.storage import settle


def inherit(pathed: DataFrame) -> DataFrame:
    """``pathed`` with inferred_flags overwritten: the proper flags of all proper ancestors, and infraspecific below a species (F-1)."""
    gives = F.col("proper_flags").bitwiseOR(F.when(F.col("rank") == "species", BIT["infraspecific"]).otherwise(0))
    bequests = pathed.select(F.col("uid").alias("anc"), gives.alias("gives")).where("gives <> 0")
    up = pathed.select("uid", F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("anc")).join(bequests, "anc")
    got = up.groupBy("uid").agg(F.bit_or("gives").alias("got"))
    return pathed.drop("inferred_flags").join(got, "uid", "left").withColumn("inferred_flags", F.coalesce("got", F.lit(0))).drop("got")


def barren(pathed: DataFrame) -> DataFrame:
    """``pathed`` with the barren bit: no species-level node and no unranked tip at or below (F-2)."""
    fertile = (codecs.rank_level("rank") >= SPECIES) | ((F.col("rank") == "no rank") & (F.col("n_children") == 0))
    live = pathed.where(fertile).select(F.explode("path").alias("uid")).distinct().withColumn("live", F.lit(True))
    joined = pathed.join(live, "uid", "left")
    return joined.withColumn("inferred_flags", F.when(F.col("live"), F.col("inferred_flags").bitwiseAND(~BIT["barren"])).otherwise(F.col("inferred_flags").bitwiseOR(BIT["barren"]))).drop("live")


def extinct_up(pathed: DataFrame) -> DataFrame:
    """``pathed`` with extinct inferred upwards: a node all of whose children have it *inferred* gets it (F-3).

    A node has it inferred at first if an ancestor gave it. A node then gets it iff it has children and no descendant
    tip lacks it, so one grouping over paths does what a walk from the leaves would.
    """
    lacking = pathed.where((F.col("n_children") == 0) & ~codecs.has(F.col("inferred_flags"), BIT["extinct"])).select(F.explode("path").alias("uid")).distinct().withColumn("lacks", F.lit(True))
    joined = pathed.join(lacking, "uid", "left")
    lift = (F.col("n_children") > 0) & F.col("lacks").isNull()
    return joined.withColumn("inferred_flags", F.when(lift, F.col("inferred_flags").bitwiseOR(BIT["extinct"])).otherwise(F.col("inferred_flags"))).drop("lacks")


def sibling_ranks(pathed: DataFrame, major: bool = False) -> DataFrame:
    """``pathed`` with the proper flags of rank conflicts among placed siblings (F-5).

    A child ranks lower than its highest-ranked placed sibling: in the major mode by a whole group of ranks
    (major_rank_conflict), else at all (sibling_higher).
    """
    level = codecs.rank_level("rank")
    placed = ~codecs.has(F.col("proper_flags"), UNPLACED_ANY)
    high = F.min(F.when(placed & (level >= 0), level)).over(Window.partitionBy("parent_uid"))
    worse = (F.floor(level / 100) > F.floor(F.col("_high") / 100)) if major else (level > F.col("_high"))
    bit = BIT["major_rank_conflict" if major else "sibling_higher"]
    hit = F.col("parent_uid").isNotNull() & placed & (level >= 0) & F.coalesce(worse, F.lit(False))
    return pathed.withColumn("_high", high).withColumn("proper_flags", F.when(hit, F.col("proper_flags").bitwiseOR(bit)).otherwise(F.col("proper_flags"))).drop("_high")


def rank_inversions(nodes: DataFrame) -> DataFrame:
    """(uid, parent_uid, rank, parent_rank): children that rank above their parent (F-6)."""
    up = nodes.select(F.col("uid").alias("parent_uid"), F.col("rank").alias("parent_rank"))
    level, upper = codecs.rank_level("rank"), codecs.rank_level("parent_rank")
    return nodes.join(up, "parent_uid").where((level >= 0) & (upper >= 0) & (level < upper)).select("uid", "parent_uid", "rank", "parent_rank")


def fix(nodes: DataFrame) -> DataFrame:
    """Inferred flags that no parent explains become proper ones; the four inferred-only ones stay (F-4)."""
    up = nodes.select(F.col("uid").alias("parent_uid"), F.col("proper_flags").bitwiseOR(F.col("inferred_flags")).alias("above"))
    j = nodes.join(up, "parent_uid", "left")
    wrong = F.when(F.col("above").isNull(), 0).otherwise(F.col("inferred_flags").bitwiseAND(F.bitwise_not(F.col("proper_flags").bitwiseOR(F.col("above")))).bitwiseAND(~INFERRED_ONLY))
    return j.withColumn("wrong", wrong).withColumns({"proper_flags": F.col("proper_flags").bitwiseOR(F.col("wrong")), "inferred_flags": F.col("inferred_flags").bitwiseAND(F.bitwise_not(F.col("wrong")))}).select(*nodes.columns)


def infer(pathed: DataFrame) -> DataFrame:
    """All of it, in order: inherit, extinct and barren up, minor rank conflicts."""
    return sibling_ranks(barren(extinct_up(settle(inherit(pathed)))))


def flag_names(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the proper flags that their names ask for (P-10)."""
    return nodes.withColumn("proper_flags", F.col("proper_flags").bitwiseOR(F.coalesce(codecs.name_flags(F.col("name")), F.lit(0))))
