"""Finding or making nodes by an ordered table of requests, which may refer to what earlier ones made (M-25)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.functions import codecs
from grovespark.model import BIT, COLUMNS, FORMER_CONTAINER, SOURCE_IDS, Taxonomy
from grovespark.operators import tree
from grovespark.storage import settle

#: What a request says; ``pos`` orders them and is unique, all but it and the name may be null.
REQUEST = "pos bigint, name string, rank string, parent string, ancestor string, division string, id string, source struct<prefix:string,id:string>"
CONTEXTS = ("parent", "ancestor", "division")


@dataclass(frozen=True)
class Established:
    tax: Taxonomy
    #: (pos, outcome, uid) of every request: found, created, conflict or nameless.
    outcomes: DataFrame


def _touched(requests: DataFrame) -> DataFrame:
    """(pos, key, writes): the names and ids that a request looks at, and whether it may give the key a new bearer."""
    both = [F.struct(F.col(c).alias("key"), F.lit(c in ("name", "id")).alias("writes")) for c in ("name", "id", *CONTEXTS)]
    return requests.select("pos", F.explode(F.array(*both)).alias("t")).select("pos", "t.key", "t.writes").where("key IS NOT NULL")


def ready(requests: DataFrame) -> DataFrame:
    """The requests that no earlier one of ``requests`` can bear on, nor be borne on by them.

    Two requests bear on each other if one looks at a name or id that the other may give a bearer. For each key the least
    position of those that look and of those that write is enough, so no pairs are made.
    """
    t = _touched(requests)
    first = t.groupBy("key").agg(F.min("pos").alias("looks"), F.min(F.when(F.col("writes"), F.col("pos"))).alias("writer"))
    late = t.join(first, "key").where("writer < pos OR (writes AND looks < pos)").select("pos").distinct()
    return requests.join(late, "pos", "left_anti")


def _answered(now: DataFrame, bearers: DataFrame, ids: DataFrame, prefix: str) -> DataFrame:
    """``now`` with outcome, uid, up (the node to attach to) and path; requests of one round don't bear on each other.

    ``bearers``: (name, uid, path); ``ids``: (id, path). The nodes of a name meet its one request of the round, and their ancestors
    meet the contexts by request and name.
    """
    asked = now.select("pos", F.explode(F.array(*(F.struct(F.lit(i).alias("nth"), F.col(c).alias("context")) for i, c in enumerate(CONTEXTS)))).alias("a")).select("pos", "a.*").where("context IS NOT NULL")
    above = now.select("pos", "name").join(bearers, "name").select("pos", "uid", F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("anc"))
    above = above.join(bearers.select(F.col("uid").alias("anc"), F.col("name").alias("context")), "anc").join(asked, ["pos", "context"]).select("pos", "nth", "uid").distinct()
    single = above.groupBy("pos", "nth").agg(F.count("*").alias("k"), F.min("uid").alias("uid")).where("k = 1")
    found = single.groupBy("pos").agg(F.min_by("uid", "nth").alias("found"))
    own = ids.select(F.col("id").alias("context"), F.col("path").alias("id_path"))
    named = bearers.groupBy("name").agg(F.count("*").alias("k"), F.min("path").alias("name_path")).withColumnRenamed("name", "context")
    places = asked.join(named, "context", "left").join(own, "context", "left").withColumn("at", F.when(F.col("k") == 1, F.col("name_path")).when(F.col("k").isNull(), F.col("id_path"))).where("at IS NOT NULL")
    place = places.groupBy("pos").agg(F.min("nth").alias("nth"), F.min_by("at", "nth").alias("at"), F.min_by("context", "nth").alias("under"))
    j = now.join(found, "pos", "left").join(place, "pos", "left").join(ids.select("id", F.col("path").alias("known")), "id", "left")
    conflict = F.col("known").isNotNull() & F.col("found").isNotNull() & (F.col("found") != F.col("id"))
    outcome = F.when(F.col("name").isNull(), "nameless").when(conflict, "conflict").when(F.col("known").isNotNull() | (F.col("id").isNull() & F.col("found").isNotNull()), "found").otherwise("created")
    j = j.withColumn("outcome", outcome)
    fresh = F.coalesce("id", F.concat(F.lit(prefix), F.col("pos").cast("string")))
    uid = F.when(F.col("outcome") == "created", fresh).when(F.col("outcome") == "found", F.coalesce("id", "found"))
    j = j.withColumn("uid", uid)
    return j.select(*now.columns, "outcome", "uid", F.get("at", F.size("at") - 1).alias("up"), F.concat(F.coalesce("at", F.array().cast("array<string>")), F.array("uid")).alias("path"), F.col("under").eqNullSafe(F.col("parent")).alias("placed"))


def establish(tax: Taxonomy, requests: DataFrame, prefix: str = "established-") -> Established:
    """``tax`` with a node for every request (REQUEST), each applied as if one after the other (M-25).

    The node is the one of that name (synonyms included, former containers not) below a bearer of the parent's name, else of the ancestor's, else
    of the division's; several below one context count as none. An ``id`` that a node has decides, and is a ``conflict``, with no node, if
    the contexts find another one; an id that no node has makes a node. A new node goes below the first context that names one node (by
    name, or by id if nobody has the name), as incertae sedis unless that is the parent, and becomes a root where there is none. Its uid is its
    id, else ``prefix`` and the position. A request without a name does nothing.

    Requests go in rounds, as many as the longest chain of requests that bear on each other; only the names and ids that requests mention are
    looked at after the first pass.
    """
    open_ = settle(requests.select("pos", "name", "rank", *CONTEXTS, "id", "source"))
    keys = settle(_touched(open_).select("key").distinct())
    pathed = settle(tree.with_path(tax.nodes).where("path IS NOT NULL").select("uid", "name", "path", "proper_flags"))
    live = pathed.where(~codecs.has(F.col("proper_flags"), FORMER_CONTAINER))
    every = live.select("name", "uid", "path").union(tax.synonyms.select("name", "uid").join(live.select("uid", "path"), "uid").select("name", "uid", "path")).where("name IS NOT NULL")
    bearers = [settle(every.join(keys, F.col("name") == F.col("key"), "left_semi").dropDuplicates(["name", "uid"]))]
    ids = [settle(pathed.join(keys, F.col("uid") == F.col("key"), "left_semi").select(F.col("uid").alias("id"), "path"))]
    done = []
    while not open_.isEmpty():
        now = ready(open_)
        got = settle(_answered(now, reduce(DataFrame.union, bearers), reduce(DataFrame.union, ids), prefix))
        new = got.where("outcome = 'created'")
        bearers.append(new.select("name", "uid", "path"))
        ids.append(new.select(F.col("uid").alias("id"), "path"))
        done.append(got)
        open_ = settle(open_.join(got.select("pos"), "pos", "left_anti"))
    if not done:
        return Established(tax, requests.where("false").select("pos", F.lit("found").alias("outcome"), F.col("name").alias("uid")))
    all_ = reduce(DataFrame.union, done)
    flags = F.when(F.col("up").isNotNull() & ~F.col("placed"), BIT["incertae_sedis"]).otherwise(0)
    sources = F.when(F.col("source").isNotNull(), F.array("source")).otherwise(F.array()).cast(SOURCE_IDS)
    made = all_.where("outcome = 'created'").select("uid", F.col("up").alias("parent_uid"), "name", F.coalesce("rank", F.lit("no rank")).alias("rank"), sources.alias("source_ids"), flags.alias("proper_flags"), F.lit(0).alias("inferred_flags"))
    return Established(tax.with_nodes(tax.nodes.select(*COLUMNS).union(made.select(*COLUMNS))), all_.select("pos", "outcome", "uid"))
