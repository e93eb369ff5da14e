"""What became of the ids of an earlier release (A-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovespark.functions import codecs, paths
from grovespark.model import BIT, FORMER_CONTAINER, Taxonomy
from grovespark.operators import lookups, tree


def _name_counts(nodes: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(name, k, one): how many nodes have a name, as theirs or as a synonym, and the smallest of them."""
    names = nodes.select("name", "uid").union(synonyms.select("name", "uid")).where("name IS NOT NULL")
    return names.groupBy("name").agg(F.count("*").alias("k"), F.min("uid").alias("one"))


def _other_gender(name: Column) -> Column:
    return F.when(name.endswith("us"), F.regexp_replace(name, "us$", "a")).when(name.endswith("a"), F.regexp_replace(name, "a$", "us"))


def deprecated_ids(old: DataFrame, old_synonyms: DataFrame, new: Taxonomy, pathed: DataFrame, images: DataFrame, important: DataFrame | None = None) -> DataFrame:
    """(id, size, name, reason, witness, replacement, status) of the old ids that are not what they were (A-15).

    ``old`` and ``pathed``, the nodes of ``new``: with path, n_nodes and division. ``images`` (src, tgt) maps old nodes to
    new ones. With ``important`` (id, in_synthesis) only its ids are reported, with ``synthesis`` or ``phylesystem`` as
    status. A replacement is ``=`` for the id itself, ``*`` for none, or an id with a mark: ``?`` smushed into, ``!`` of
    the same name, ``<`` the node that contains it.
    """
    old_names, new_names = _name_counts(old, old_synonyms), _name_counts(pathed, new.synonyms)
    o = old.select(F.col("uid").alias("id"), "name", "rank", "proper_flags", "inferred_flags", "path", F.col("n_nodes").alias("old_size"), "division", tree.hidden().alias("was_hidden"))
    if important is None:
        o = o.withColumn("status", F.lit(""))
    else:
        o = o.join(important.groupBy("id").agg(F.bool_or("in_synthesis").alias("used")), "id").withColumn("status", F.when(F.col("used"), "synthesis").otherwise("phylesystem")).drop("used")
    u = pathed.select(F.col("uid").alias("tgt"), F.col("parent_uid").alias("up"), F.col("path").alias("u_path"), F.col("proper_flags").alias("u_proper"), F.col("inferred_flags").alias("u_inferred"), tree.hidden().alias("is_hidden"))
    o = o.join(images.select(F.col("src").alias("id"), "tgt"), "id", "left").join(u, "tgt", "left")
    return _mapped(o.where("tgt IS NOT NULL"), pathed).union(_unmapped(o.where("tgt IS NULL"), new, pathed, images, old_names, new_names))


def _mapped(o: DataFrame, pathed: DataFrame) -> DataFrame:
    """Ids with an image: lumped into another node, or hidden since."""
    name = pathed.select(F.col("uid").alias("at"), F.col("name").alias("at_name"))
    fresh = F.col("is_hidden") & ~F.col("was_hidden")
    former = fresh & codecs.has(F.col("u_proper"), FORMER_CONTAINER) & F.col("up").isNotNull()
    o = o.where(fresh | (F.col("id") != F.col("tgt"))).withColumns({"fresh": fresh, "former": former})
    # The highest of the hidden nodes above, without a visible one between, comes after the last visible one.
    line = o.where("fresh AND NOT former").select("id", F.posexplode("u_path").alias("nth", "at")).join(pathed.where(~tree.hidden()).select(F.col("uid").alias("at")), "at", "left_semi")
    seen = line.groupBy("id").agg(F.max("nth").alias("last_visible"))
    o = o.join(seen, "id", "left").withColumn("at", F.when(F.col("former"), F.col("up")).when(F.col("fresh"), F.get("u_path", F.coalesce("last_visible", F.lit(-1)) + 1)))
    o = o.join(name, "at", "left")
    box = F.when(codecs.has(F.col("u_proper"), BIT["merged"]), "merged").otherwise("emptied-container")
    reason = F.when(F.col("former"), box).when(F.col("id") != F.col("tgt"), "lumped").otherwise("newly-hidden")
    more = codecs.print_flags(F.col("u_proper").bitwiseAND(F.bitwise_not("proper_flags")), F.col("u_inferred").bitwiseAND(F.bitwise_not("inferred_flags")))
    marks = F.when(F.col("fresh") & (more != ""), F.concat(F.lit("["), more, F.lit("]"))).otherwise("")
    replacement = F.when(F.col("former"), F.concat(F.lit("<"), "up")).when(F.col("id") == F.col("tgt"), "=").otherwise(F.col("tgt"))
    return o.select("id", F.col("old_size").alias("size"), "name", F.concat(reason, marks).alias("reason"), F.coalesce("at_name", F.lit("")).alias("witness"), replacement.alias("replacement"), "status")


def _unmapped(o: DataFrame, new: Taxonomy, pathed: DataFrame, images: DataFrame, old_names: DataFrame, new_names: DataFrame) -> DataFrame:
    """Ids without an image: used for another node, an alias now, or retired."""
    o = o.drop("tgt", "up", "u_path", "u_proper", "u_inferred", "is_hidden")
    o = o.join(lookups.by_id(o.select("id"), new).withColumnRenamed("uid", "holder"), "id", "left")
    o = o.join(old_names.select("name", F.col("k").alias("old_k")), "name", "left").join(new_names.select("name", F.col("k").alias("new_k"), "one"), "name", "left")
    turned = new_names.select(F.col("name").alias("turned"), F.lit(True).alias("gender"))
    o = o.withColumn("turned", F.when(F.col("rank") == "species", _other_gender(F.col("name")))).join(turned, "turned", "left")
    one = pathed.select(F.col("uid").alias("one"), F.col("path").alias("one_path"), F.col("division").alias("one_division"))
    o = o.join(one, "one", "left").withColumn("single", F.col("holder").isNull() & (F.coalesce("new_k", F.lit(0)) == 1))

    # Where the old node would be in the new release: at the image of its nearest ancestor that has one.
    line = o.where("single").select("id", F.posexplode("path").alias("nth", "src")).join(images, "src").groupBy("id").agg(F.max_by("tgt", "nth").alias("bridge"))
    o = o.join(line, "id", "left").join(pathed.select(F.col("uid").alias("bridge"), F.col("path").alias("bridge_path")), "bridge", "left")
    o = o.withColumn("apart", paths.divergence("bridge_path", "one_path"))
    for side in ("left", "right"):
        o = o.withColumn(f"{side}_uid", F.col(f"apart.{side}")).join(pathed.select(F.col("uid").alias(f"{side}_uid"), F.col("name").alias(f"{side}_name")), f"{side}_uid", "left")
    moved = F.col("single") & ~F.col("division").eqNullSafe(F.col("one_division"))
    reason = (
        F.when(F.col("holder") == F.col("id"), "id-used-differently").when(F.col("holder").isNotNull(), "smushing")
        .when(F.col("new_k").isNull(), F.when(F.col("gender"), "id-retired/gender-change").otherwise("id-retired/name-retired"))
        .when(moved, "id-retired/changed-divisions").when(F.col("new_k") > F.col("old_k"), "id-retired/possible-splitting").when(F.col("old_k") > F.col("new_k"), "id-retired/probable-lumping")
        .when(F.col("single"), "id-retired/incompatible-use").otherwise("id-retired/incompatible-uses")
    )
    witness = F.when(moved, F.concat(F.coalesce("division", F.lit("forest")), F.lit("->"), F.coalesce("one_division", F.lit("forest")))).when(F.col("single") & (F.col("new_k") == F.col("old_k")), F.concat("left_name", F.lit("->"), "right_name"))
    replacement = F.when(F.col("single"), F.concat(F.lit("!"), "one")).when(F.col("holder") != F.col("id"), F.concat(F.lit("?"), "holder")).otherwise("*")
    return o.select("id", F.col("old_size").alias("size"), "name", reason.alias("reason"), F.coalesce(witness, F.lit("")).alias("witness"), replacement.alias("replacement"), "status")
