"""Addition documents: an ordered log of requests in which a row may refer to what an earlier row made (I-7)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.functions import codecs
from grovespark.model import RANK_LEVELS, SOURCE_IDS, Taxonomy
from grovespark.operators import align, tree
from grovespark.storage import Pile, settle

DOCUMENT = "id string, user_agent string, taxa array<struct<tag:string,ott_id:string,name:string,parent:string,parent_tag:string,rank:string,sources:array<struct<source:string>>>>"
#: The user agent that releases write their own requests with, unless told otherwise: such rows are never made anew.
ORIGINAL = "release"
ROOT = "root"
#: What rows need to be applied; ``at`` orders them.
ROW = "at struct<size:int,doc:string,pos:int>, original boolean, tag string, ott_id string, name string, parent string, parent_tag string, rank string, source string"


@dataclass(frozen=True)
class Applied:
    #: (doc, pos, tag, outcome, target) of every row that is settled.
    outcomes: DataFrame
    #: New nodes (COLUMNS and division).
    created: DataFrame
    #: (id, uid, division): requested ids and the nodes that bear them from now on.
    ids: DataFrame
    #: ROW of those that wait for a parent; empty unless ``wait``.
    waiting: DataFrame


@dataclass(frozen=True)
class Known:
    """What additions are held against: (id, uid, division) and (name, uid, division, first)."""

    ids: DataFrame
    names: DataFrame


def log_rows(docs: DataFrame, original: str = ORIGINAL) -> DataFrame:
    """ROW of all documents, each id once: by the length of the document's id, its id, and the place in it.

    Rows of the user agent ``original`` only find nodes.
    """
    once = docs.where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct("user_agent", "taxa")).alias("d"))
    t = once.select("id", F.coalesce(F.col("d.user_agent") == original, F.lit(False)).alias("original"), F.posexplode("d.taxa").alias("pos", "t"))
    at = F.struct(F.length("id").alias("size"), F.col("id").alias("doc"), "pos").alias("at")
    return t.select(at, "original", *(f"t.{c}" for c in ("tag", "ott_id", "name", "parent", "parent_tag", "rank")), F.coalesce(F.get("t.sources", F.lit(0))["source"], F.lit("")).alias("source"))


def known(tax: Taxonomy, divisions: DataFrame) -> Known:
    """The nodes and names of ``tax`` with their divisions (uid), aliases included."""
    pathed = settle(tree.with_division(tree.with_path(tax.nodes), divisions).select("uid", "name", "source_ids", "division"))
    ids = pathed.select(F.col("uid").alias("id"), "uid", "division").union(tax.aliases.join(pathed.select(F.col("uid").alias("replacement"), "division"), "replacement").select("id", F.col("replacement").alias("uid"), "division"))
    first = F.when(F.size("source_ids") > 0, codecs.print_qid(F.get("source_ids", F.lit(0))))
    names = align.names(tax).select("uid", "name").distinct().join(pathed.select("uid", "division", first.alias("first")), "uid")
    return Known(ids, names.select("name", "uid", "division", "first"))


def _smallest(uid: str) -> Column:
    return F.min(F.struct(F.length(uid).alias("n"), F.col(uid).alias("uid")))["uid"]


def _late(pending: DataFrame) -> DataFrame:
    """``pending`` with ``late``: whether no other row refers to the row or has its id, which holds for all rows of its name, too.

    Such a row changes nothing for those that are not late, and needs nothing of one that is, but for the name and division.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ids = pending.select(F.col("ott_id").alias("id"), one.alias("own"), none.alias("asked")).union(pending.where("parent IS NOT NULL").select("parent", none, one))
    busy_ids = ids.groupBy("id").agg(F.sum("own").alias("own"), F.sum("asked").alias("asked")).where("own > 1 OR own = 1 AND asked > 0").select(F.col("id").alias("ott_id"))
    tags = pending.where("parent IS NULL").select(F.col("at.doc").alias("doc"), F.col("parent_tag").alias("tag")).distinct()
    plain = pending.select("ott_id", "name", F.col("at.doc").alias("doc"), "tag")
    busy = plain.join(busy_ids, "ott_id", "left_semi").select("name").union(plain.join(tags, ["doc", "tag"], "left_semi").select("name"))
    names = settle(busy.distinct().withColumn("busy", F.lit(True)))
    return settle(pending.join(names, "name", "left").select(*pending.columns, F.col("busy").isNull().alias("late")))


def apply(rows: DataFrame, base: Known, wait: bool = False) -> Applied:
    """Applies ``rows`` (ROW) as if one after another.

    A row needs its parent, by id or by the tag of an earlier row of its document. Its node is the one with its id; else
    of those with its name in the parent's division the one whose first source is the row's first, or the smallest; else it is made. So
    a row waits only for earlier rows that may make its parent, have its id, or have its name. In each round all rows
    that wait for nothing are settled together: of those with one name and division the first makes the node and the others
    find it. The first open row never waits, so every round settles some; rounds are as many as references follow each other. Rows
    to which none refers are kept out of these rounds and settled after them, in one. With ``wait``, rows
    whose parent's id is unknown are handed back instead of refused.
    """
    spark = rows.sparkSession
    lacks = F.when(F.col("tag").isNull(), "missing tag").when(F.col("name").isNull(), "missing name").when(F.col("ott_id").isNull(), "missing id").when(F.col("parent").isNull() & F.col("parent_tag").isNull(), "no parent")
    told = settle(rows.withColumn("lack", lacks))
    nobody = F.lit(None).cast("string").alias("target")
    done = told.where("lack IS NOT NULL").select("at", "tag", F.col("lack").alias("outcome"), nobody)
    marked = _late(told.where("lack IS NULL").drop("lack"))
    columns = [c for c in marked.columns if c != "late"]
    # Only what the rows mention can matter.
    mentioned = marked.select(F.col("ott_id").alias("id")).union(marked.select("parent")).join(base.ids.select("id"), "id", "left_semi").distinct()
    never = F.lit(None).cast(marked.schema["at"].dataType)
    base_ids = settle(base.ids.join(mentioned, "id", "left_semi").withColumn("put_at", never))
    named = marked.select("name").join(base.names.select("name"), "name", "left_semi").distinct()
    base_names = settle(base.names.join(named, "name", "left_semi"))
    # What each round looked at, settled, and (with ``wait``) could not settle.
    seen, put, lost = Pile(spark, "seen"), Pile(spark, "put"), Pile(spark, "lost")
    qid = F.struct(F.col("at.doc").alias("prefix"), F.col("ott_id").alias("id"))
    rank = F.when(F.col("rank").isin(*RANK_LEVELS), F.col("rank")).otherwise("no rank")

    def brought() -> DataFrame:
        """The ids that rows have brought."""
        return put.all().where("target IS NOT NULL AND own IS NULL").select(F.col("ott_id").alias("id"), F.col("target").alias("uid"), F.col("target_division").alias("division"), F.col("at").alias("put_at"))

    def created() -> DataFrame:
        return put.all().where("outcome = 'added'").select(F.col("ott_id").alias("uid"), "parent_uid", "name", rank.alias("rank"), F.array(qid).cast(SOURCE_IDS).alias("source_ids"), F.lit(0).alias("proper_flags"), F.lit(0).alias("inferred_flags"), "division")

    def settled(pending: DataFrame, alone: bool) -> DataFrame:
        """The rows that are still open after a round; ``alone``: none of them waits for another."""
        have = base_ids.union(brought()) if put.paths else base_ids
        p = pending.withColumn("doc", F.col("at.doc")).join(have.select(F.col("id").alias("ott_id"), F.col("uid").alias("own"), F.col("division").alias("own_division")), "ott_id", "left")
        if alone:
            p = p.withColumns({"id_at": F.col("at"), "maker_at": never, "tag_at": never})
        else:
            by_id = pending.groupBy("ott_id").agg(F.min("at").alias("id_at"))
            by_tag = pending.groupBy(F.col("at.doc").alias("doc"), "tag").agg(F.min("at").alias("tag_at"))
            p = p.join(by_id, "ott_id").join(by_id.select(F.col("ott_id").alias("parent"), F.col("id_at").alias("maker_at")), "parent", "left")
            p = p.join(by_tag.withColumnRenamed("tag", "parent_tag"), ["doc", "parent_tag"], "left")
        # An id that a later row brought is not there yet.
        p = p.join(have.select(F.col("id").alias("parent"), F.col("uid").alias("up"), F.col("division").alias("up_division"), F.col("put_at").alias("up_at")), "parent", "left")
        p = p.withColumn("up", F.when(F.coalesce(F.col("up_at") < F.col("at"), F.lit(True)), F.col("up")))
        # The node of the last earlier row with the tag, which a refused row does not take over.
        if put.paths:
            tagged = put.all().select(F.col("at.doc").alias("doc"), F.col("tag").alias("parent_tag"), F.col("at").alias("put_at"), F.struct("target", F.col("target_division").alias("division")).alias("node"))
            last = pending.where("parent IS NULL").select("at", F.col("at.doc").alias("doc"), "parent_tag").join(tagged, ["doc", "parent_tag"]).where("put_at < at").groupBy("at").agg(F.max_by("node", "put_at").alias("node"))
            p = p.join(last.select("at", F.col("node.target").alias("tag_up"), F.col("node.division").alias("tag_division")), "at", "left")
        else:
            p = p.withColumns({"tag_up": F.lit(None).cast("string"), "tag_division": F.lit(None).cast("string")})
        by_parent = F.col("parent").isNotNull()
        is_root = F.coalesce(F.col("parent") == ROOT, F.lit(False))
        open_tag, open_id = F.coalesce(F.col("tag_at") < F.col("at"), F.lit(False)), F.coalesce(F.col("maker_at") < F.col("at"), F.lit(False))
        found = F.when(by_parent, is_root | F.col("up").isNotNull()).otherwise(~open_tag & F.col("tag_up").isNotNull())
        dead = ~found & F.when(by_parent, ~open_id).otherwise(~open_tag)
        p = p.select(*columns, "own", "own_division", found.alias("found"), dead.alias("dead"), F.when(is_root, None).otherwise(F.when(by_parent, F.col("up")).otherwise(F.col("tag_up"))).alias("parent_uid"), F.when(by_parent, F.col("up_division")).otherwise(F.col("tag_division")).alias("division"), (F.col("id_at") == F.col("at")).alias("first_id"))
        p = seen.add(p.withColumn("ready", F.col("found") & (F.col("own").isNotNull() | F.col("first_id"))))
        if alone:
            p = p.withColumn("live", F.col("ready"))
        else:
            blocks = p.where("NOT ready AND NOT dead AND own IS NULL").groupBy("name").agg(F.min("at").alias("block_at"))
            free = F.col("own").isNotNull() | F.col("block_at").isNull() | (F.col("at") < F.col("block_at"))
            p = settle(p.join(blocks, "name", "left").withColumn("live", F.col("ready") & free).drop("block_at"))
        live = p.where("live")
        # No row that is not late has a name of those that are.
        made = None if alone or not put.paths else created().select("name", "uid", "division", codecs.print_qid(F.get("source_ids", F.lit(0))).alias("first"))
        options = base_names if made is None else base_names.union(made)
        by_name = options.groupBy("name", "division").agg(_smallest("uid").alias("small"))
        by_source = options.where("first IS NOT NULL").groupBy("name", "division", F.col("first").alias("source")).agg(_smallest("uid").alias("same_source"))
        maker = live.where("own IS NULL AND NOT original").groupBy("name", "division").agg(F.min(F.struct("at", "ott_id")).alias("m"))
        d = live.alias("l")
        for other, keys in ((by_name, ["name", "division"]), (by_source, ["name", "division", "source"]), (maker, ["name", "division"])):
            theirs = other.select(*(F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in other.columns))
            d = d.join(theirs, reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys)), "left").drop(*(f"_{k}" for k in keys))
        there = F.coalesce("own", "same_source", "small")
        makes = there.isNull() & F.coalesce(F.col("m.at") == F.col("at"), F.lit(False))
        target = F.coalesce(there, F.when(F.col("m.at") <= F.col("at"), F.col("m.ott_id")))
        outcome = F.when(makes, "added").when(target.isNotNull(), "matched").otherwise("deprecated")
        put.add(d.select(*live.columns, outcome.alias("outcome"), target.alias("target"), F.when(F.col("own").isNotNull(), F.col("own_division")).otherwise(F.col("division")).alias("target_division")))
        if wait:
            by_id_lost = p.where("dead AND parent IS NOT NULL").select(*columns, F.lit(True).alias("waits"))
            # A tag of a row that waits is not there yet.
            held = by_id_lost if not lost.paths else by_id_lost.union(lost.all().where("waits"))
            waiting_tags = held.groupBy(F.col("at.doc").alias("doc"), F.col("tag").alias("parent_tag")).agg(F.min("at").alias("held_at"))
            by_tag_lost = p.where("dead AND parent IS NULL").withColumn("doc", F.col("at.doc")).join(waiting_tags, ["doc", "parent_tag"], "left")
            # Written in each round: what waits grows from itself, and its plan would double.
            lost.add(by_id_lost.union(by_tag_lost.select(*columns, F.coalesce(F.col("held_at") < F.col("at"), F.lit(False)))))
        return p.where("NOT dead AND NOT live").select(*columns)

    pending = marked.where("NOT late").select(*columns)
    while not pending.isEmpty():
        pending = settled(pending, alone=False)
    late = marked.where("late").select(*columns)
    if not late.isEmpty():
        settled(late, alone=True)

    waiting = spark.createDataFrame([], ROW)
    if not seen.paths:
        nodes = f"uid string, parent_uid string, name string, rank string, source_ids {SOURCE_IDS}, proper_flags int, inferred_flags int, division string"
        new, ids = spark.createDataFrame([], nodes), spark.createDataFrame([], "id string, uid string, division string")
    else:
        new, ids = created(), brought().drop("put_at")
        refused = seen.all().where("dead")
        if wait:
            refused, waiting = lost.all().where("NOT waits"), lost.all().where("waits").select(*columns)
        done = done.union(put.all().select("at", "tag", "outcome", "target")).union(refused.select("at", "tag", F.lit("parent not found"), nobody))
    return Applied(done.select(F.col("at.doc").alias("doc"), F.col("at.pos").alias("pos"), "tag", "outcome", "target"), new, ids, waiting)


def add(tax: Taxonomy, docs: DataFrame, divisions: DataFrame, original: str = ORIGINAL) -> tuple[Taxonomy, DataFrame]:
    """(``tax`` with the documents' nodes and with matched ids as aliases, the outcomes)."""
    a = apply(log_rows(docs, original), known(tax, divisions))
    aliases = a.ids.where("id <> uid").select("id", F.col("uid").alias("replacement"))
    nodes = tax.nodes.union(a.created.select(*tax.nodes.columns))
    return Taxonomy(nodes, tax.synonyms, tax.aliases.union(aliases), tax.idspace), a.outcomes
