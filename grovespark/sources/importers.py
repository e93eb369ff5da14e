"""Native dumps to interim tables: filters, closures and lineage columns (S-16 to S-31)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.functions import codecs
from grovespark.operators.tree import with_path


def read_dump(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """A table whose fields are separated by tab, bar, tab (S-16)."""
    return dump_fields(spark.read.text(path), *names)


def dump_fields(lines: DataFrame, *names: str) -> DataFrame:
    """The first fields of ``lines`` (value) by name, without spaces around them; null where a line has fewer (S-16)."""
    parts = F.split(F.regexp_replace("value", r"\t\|\s*$", ""), r"\t\|\t")
    return lines.select(*(F.trim(F.get(parts, F.lit(i))).alias(n) for i, n in enumerate(names)))


def drop_with_descendants(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Without ``roots`` (uid) and all below them (S-16, S-17)."""
    gone = with_path(nodes).select("uid", F.explode("path").alias("anc")).join(roots.select(F.col("uid").alias("anc")), "anc", "left_semi").select("uid").distinct()
    return nodes.join(gone, "uid", "left_anti")


def keep_with_ancestors(nodes: DataFrame, kept: DataFrame) -> DataFrame:
    """Only ``kept`` (uid) and their ancestors (S-19)."""
    up = with_path(nodes).join(kept.select("uid"), "uid", "left_semi").select(F.explode("path").alias("uid")).distinct()
    return nodes.join(up, "uid", "left_semi")


def drop_tips(nodes: DataFrame, bad: Column) -> DataFrame:
    """Without the tips for which ``bad`` holds (S-17)."""
    inner = nodes.where("parent_uid IS NOT NULL").select(F.col("parent_uid").alias("uid")).distinct().withColumn("inner", F.lit(True))
    return nodes.join(inner, "uid", "left").where(F.col("inner") | ~bad).drop("inner")


def sink_same_names(nodes: DataFrame) -> DataFrame:
    """Children that have their parent's name take their rank into it: ``X rank X`` (S-16)."""
    up = nodes.select(F.col("uid").alias("parent_uid"), F.col("name").alias("parent_name"))
    j = nodes.join(up, "parent_uid", "left")
    return j.withColumn("name", F.when(F.col("name") == F.col("parent_name"), F.concat_ws(" ", "name", "rank", "name")).otherwise(F.col("name"))).select(*nodes.columns)


def lineage_nodes(rows: DataFrame, lineage: str = "lineage") -> DataFrame:
    """(uid, parent_uid, name) of the distinct prefixes of lineage arrays (S-21, S-27)."""
    steps = rows.select(F.col(lineage).alias("l")).distinct().select("l", F.explode(F.sequence(F.lit(1), F.size("l"))).alias("k"))
    return steps.select(F.array_join(F.slice("l", F.lit(1), F.col("k")), ";").alias("uid"), F.when(F.col("k") > 1, F.array_join(F.slice("l", F.lit(1), F.col("k") - 1), ";")).alias("parent_uid"), F.get("l", F.col("k") - 1).alias("name")).distinct()


def exemplars(rows: DataFrame, cluster: str, accession: str) -> DataFrame:
    """The first accession of each cluster by length, then text (S-21, O-4)."""
    return rows.groupBy(cluster).agg(F.min(F.struct(F.length(accession), F.col(accession).alias("a"))).getField("a").alias("exemplar"))


def columns_to_lineage(rows: DataFrame, *ranks: str) -> Column:
    """A lineage array of rank columns, empty ones left out (S-22, S-27)."""
    return F.filter(F.array(*(F.col(r) for r in ranks)), lambda x: x.isNotNull() & (x != "") & (x != "Incertae sedis"))


def fill_down(rows: DataFrame, line: str, column: str, key: str) -> DataFrame:
    """The last value above within a file (S-27)."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(key).orderBy(line).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(column, F.last(column, ignorenulls=True).over(w))


def backfill(rows: DataFrame, older: DataFrame, *columns: str) -> DataFrame:
    """Missing values of ``rows`` from an older snapshot by uid (S-23)."""
    o = older.select("uid", *(F.col(c).alias(f"_{c}") for c in columns))
    return rows.join(o, "uid", "left").select(*(F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in rows.columns))


def flat_records(spark: SparkSession, path: str) -> DataFrame:
    """(accession, taxon, strain) of flat-file records that end in a line of two slashes (S-24)."""
    rec = spark.read.option("lineSep", "\n//\n").text(path)
    return rec.select(F.regexp_extract("value", r"(?m)^ACCESSION\s+(\S+)", 1).alias("accession"), F.regexp_extract("value", r'/db_xref="taxon:(\d+)"', 1).alias("taxon"), F.regexp_extract("value", r'/strain="([^"]*)"', 1).alias("strain")).where("accession <> ''")


def add_strains(nodes: DataFrame, strains: DataFrame) -> DataFrame:
    """Child rows ``taxon.strain`` unless the strain is part of the name (S-29)."""
    j = strains.join(nodes.select(F.col("uid").alias("taxon"), "name"), "taxon").where((F.col("strain") != "") & (F.instr("name", F.col("strain")) == 0))
    return j.select(F.concat_ws(".", "taxon", "strain").alias("uid"), F.col("taxon").alias("parent_uid"), F.concat_ws(" ", "name", "strain").alias("name")).distinct()


def used_ids(trees: DataFrame, text: str = "newick") -> DataFrame:
    """(id, studies) of ids that occur in tree texts (S-31)."""
    ids = trees.select("study", F.explode(F.regexp_extract_all(text, F.lit(r"ott(\d+)"), F.lit(1))).alias("id"))
    return ids.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("study")), ",").alias("studies"))


def unmapped_accessions(rows: DataFrame, mapped: DataFrame) -> DataFrame:
    """Accession keys not mapped yet (P-18)."""
    return rows.select(codecs.accession_key(F.col("accession")).alias("key")).distinct().join(mapped.select("key"), "key", "left_anti")


def flush_ambiguous(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs whose ``a`` has one ``b`` only (J-22)."""
    return pairs.groupBy(a).agg(F.min(b).alias(b), F.max(b).alias("_o")).where(F.col(b) == F.col("_o")).drop("_o")
