"""Stable identifiers from release to release (I-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.functions import codecs
from grovespark.storage import settle


def carry_over(nodes: DataFrame, old_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with ``id``, aliases): of the old ids of a node (uid, old_id) the shortest, then first, is primary (I-1).

    An old id that several nodes claim goes to the node with the smallest uid.
    """
    once = old_ids.groupBy("old_id").agg(F.min("uid").alias("uid"))
    w = Window.partitionBy("uid").orderBy(F.length("old_id"), "old_id")
    r = once.withColumn("nth", F.row_number().over(w))
    first = r.where("nth = 1").select("uid", F.col("old_id").alias("id"))
    rest = r.where("nth > 1").join(first, "uid").select(F.col("old_id").alias("id"), F.col("id").alias("replacement"))
    return nodes.join(first, "uid", "left"), rest


def apply_id_list(nodes: DataFrame, listed: DataFrame) -> DataFrame:
    """``nodes`` (uid, id, source_ids) with ids from ``listed`` (qid, ids separated by semicolons) (I-2).

    A listed id is taken by a node without one, or by one whose first source id is the qid if it is smaller.
    """
    want = listed.select("qid", F.explode(F.split("ids", ";")).alias("new_id")).where("new_id <> ''")
    q = nodes.select("uid", "id", F.posexplode("source_ids").alias("nth", "q")).select("uid", "id", "nth", codecs.print_qid(F.col("q")).alias("qid"))
    c = q.join(want, "qid").join(nodes.where("id IS NOT NULL").select(F.col("id").alias("new_id")), "new_id", "left_anti")
    fits = c.where("id IS NULL OR (nth = 0 AND try_cast(new_id AS bigint) < try_cast(id AS bigint))")
    best = fits.groupBy("uid").agg(F.min(F.struct(F.expr("try_cast(new_id AS bigint)").alias("k"), "new_id")).getField("new_id").alias("new_id"))
    one = best.groupBy("new_id").agg(F.min("uid").alias("uid"))
    return nodes.join(one, "uid", "left").withColumn("id", F.coalesce("new_id", "id")).drop("new_id")


def max_id(nodes: DataFrame, column: str = "id") -> DataFrame:
    """(max_id): the largest numeric id (I-4)."""
    return nodes.agg(F.max(F.expr(f"try_cast({column} AS bigint)")).alias("max_id"))


def mint(pathed: DataFrame, start: int) -> DataFrame:
    """(uid, new_id): contiguous ids for nodes without one, in preorder with children by name, then uid (I-5).

    The order key of a node is its ancestors' names and uids; rows are sorted by ranges, counted per range, and numbered
    from the ranges' offsets, so no task sees all rows.
    """
    names = pathed.select(F.col("uid").alias("anc"), F.coalesce("name", F.lit("￿")).alias("n"))
    need = pathed.where("id IS NULL").select("uid", F.posexplode("path").alias("nth", "anc")).join(names, "anc")
    keyed = need.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("nth", "n", "anc"))).alias("key"))
    keyed = settle(keyed.repartitionByRange("key").sortWithinPartitions("key").select("uid", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("m")))
    sizes = keyed.groupBy("part").agg(F.count("*").alias("c"), F.min("m").alias("low"))
    offsets = sizes.withColumn("before", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return keyed.join(F.broadcast(offsets), "part").select("uid", (F.lit(start) + F.col("before") + F.col("m") - F.col("low")).alias("new_id"))  # a row per range


def extend_registry(registry: DataFrame, release: DataFrame, version: str) -> DataFrame:
    """New rows (id, qid, release, note) of a release (id, qid) against the latest registration of each id (I-9).

    ``new``: an id never seen; ``was``: the id had another qid; ``return``: the qid had another id; the others are known.
    """
    w = Window.partitionBy("id").orderBy(F.desc("release"))
    latest = registry.withColumn("nth", F.row_number().over(w)).where("nth = 1").select("id", F.col("qid").alias("was_qid"))
    by_qid = registry.groupBy("qid").agg(F.min("id").alias("was_id"))
    j = release.join(latest, "id", "left").join(by_qid, "qid", "left")
    note = F.when(F.col("was_qid").isNull() & F.col("was_id").isNull(), "new").when(F.col("was_qid").isNull(), "return").when(F.col("was_qid") != F.col("qid"), "was")
    return j.withColumn("note", note).where("note IS NOT NULL").select("id", "qid", F.lit(version).alias("release"), "note")


def mutual_best(pairs: DataFrame) -> DataFrame:
    """(node, page) that are each other's smallest (J-23)."""
    a = pairs.groupBy("node").agg(F.min("page").alias("page"))
    b = pairs.groupBy("page").agg(F.min("node").alias("node"))
    return a.join(b, ["node", "page"])
