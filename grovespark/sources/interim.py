"""The delimited taxonomy format: nodes, synonyms, aliases and metadata, read and written by Spark (S-1 to S-6, S-11 to S-14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.functions import codecs
from grovespark.model import RANK_LEVELS, Taxonomy
from grovespark.operators import lookups, tree
from grovespark.storage import settle

#: Synonym types that are not names of taxa.
DROPPED_TYPES = ("type material", "authority", "blast name", "in-part", "valid")
NO_PARENT = ("null", "not found", "")


def _fields(spark: SparkSession, path: str) -> tuple[DataFrame, list[str] | None]:
    """Rows (file order ``line``, array ``f``) and the header, if there is one.

    A header is the first line of a file, with fields uid and name: a written table comes in several files. Elsewhere
    such a line is a row like any other.
    """
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.split("value", r"\t\|\t?|\t").alias("f"))
    # Of the lines that look like headers each file's first, if no other line comes before it.
    looks = lines.where(F.array_contains("f", "uid") & F.array_contains("f", "name") & (F.col("block") == 0)).groupBy("file").agg(F.min("line").alias("line"), F.min_by("f", "line").alias("head"))
    first = lines.where("block = 0").groupBy("file").agg(F.min("line").alias("first"))
    heads = looks.join(first, "file").where("line = first").select(F.col("line").alias("head_line"), "head")
    found = heads.select("head").first()
    rows = lines.join(F.broadcast(heads.select("head_line")), F.col("line") == F.col("head_line"), "left_anti")
    return rows.select("line", "f"), [x.strip() for x in found["head"]] if found else None


def _column(head: list[str], name: str) -> Column:
    return F.nullif(F.get("f", F.lit(head.index(name))), F.lit("")) if name in head else F.lit(None).cast("string")


def coerce_rank(rank: Column, name: Column) -> Column:
    """Unknown ranks, a genus in -ae and a family not in -ae are no rank (S-3)."""
    r = F.coalesce(rank, F.lit("no rank"))
    known = F.when(r.startswith("no rank") | r.isin("terminal", "samples", "") | ~r.isin(*RANK_LEVELS), "no rank").otherwise(r)
    ae = F.coalesce(name.endswith("ae"), F.lit(False))
    return F.when((known == "genus") & ae, "no rank").when((known == "family") & ~ae, "no rank").otherwise(known)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The node table: the first row of an id wins; rows with fewer than three fields or no id are skipped."""
    rows, head = _fields(spark, path)
    head = head or ["uid", "parent_uid", "name", "rank"]
    c = {n: _column(head, n) for n in ("uid", "parent_uid", "name", "rank", "sourceinfo", "source", "sourceid", "flags")}
    info = F.coalesce(c["sourceinfo"], F.when(c["source"].isNotNull(), F.concat_ws(":", c["source"], c["sourceid"])))
    proper, inferred = codecs.parse_flags(c["flags"])
    parent = F.when(~F.coalesce(c["parent_uid"], F.lit("")).isin(*NO_PARENT), c["parent_uid"])
    d = rows.where(F.size("f") >= 3).select("line", c["uid"].alias("uid"), parent.alias("parent_uid"), c["name"].alias("name"), coerce_rank(c["rank"], c["name"]).alias("rank"), codecs.parse_qids(info).alias("source_ids"), proper.alias("proper_flags"), inferred.alias("inferred_flags"))
    w = Window.partitionBy("uid").orderBy("line")
    return d.where("uid IS NOT NULL").withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth", "line")


def repair_parents(nodes: DataFrame, idspace: str) -> DataFrame:
    """A root for every parent that is named but has no row (S-2)."""
    lost = nodes.where("parent_uid IS NOT NULL").select(F.col("parent_uid").alias("uid")).distinct().join(nodes.select("uid"), "uid", "left_anti")
    blank = {"parent_uid": F.lit(None).cast("string"), "name": F.concat(F.lit(f"{idspace}:"), F.col("uid")), "rank": F.lit("no rank"), "source_ids": F.array().cast(nodes.schema["source_ids"].dataType), "proper_flags": F.lit(0), "inferred_flags": F.lit(0)}
    return nodes.unionByName(lost.select("uid", *(v.alias(k) for k, v in blank.items())))


def read_synonyms(spark: SparkSession, path: str, nodes: DataFrame) -> DataFrame:
    """Synonyms of known nodes, without odd types, repeats and primary names (S-4)."""
    rows, head = _fields(spark, path)
    head = head or ["uid", "name", "type"]
    kind = F.coalesce(_column(head, "type"), F.lit("synonym"))
    d = rows.select(_column(head, "uid").alias("uid"), _column(head, "name").alias("name"), F.when(kind == "None", "synonym").otherwise(kind).alias("type"))
    d = d.where(~F.col("type").isin(*DROPPED_TYPES) & (~F.col("type").endswith("common name") | (F.col("type") == "common name")))
    return d.where("name IS NOT NULL").join(nodes, "uid", "left_semi").join(nodes.select("uid", "name"), ["uid", "name"], "left_anti").dropDuplicates(["uid", "name"])


def read_aliases(spark: SparkSession, path: str, nodes: DataFrame) -> DataFrame:
    """Aliases of known nodes whose id is not in use (S-5)."""
    d = spark.read.csv(path, sep="\t", header=True, schema="id string, replacement string")
    return d.join(nodes.select(F.col("uid").alias("replacement")), "replacement", "left_semi").join(nodes.select(F.col("uid").alias("id")), "id", "left_anti").select("id", "replacement")


def read_taxonomy(spark: SparkSession, path: str, idspace: str = "") -> Taxonomy:
    """A directory with taxonomy.tsv and, if any, synonyms.tsv, forwards.tsv and about.json (S-6, S-7)."""
    from grovespark.model import ALIASES, SYNONYMS

    def there(name: str) -> bool:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)

    if there("about.json"):
        about = spark.read.json(f"{path}/about.json", multiLine=True)
        if "prefix" in about.columns:
            idspace = about.first()["prefix"] or idspace
    nodes = repair_parents(read_nodes(spark, f"{path}/taxonomy.tsv"), idspace)
    synonyms = read_synonyms(spark, f"{path}/synonyms.tsv", nodes) if there("synonyms.tsv") else spark.createDataFrame([], SYNONYMS)
    aliases = read_aliases(spark, f"{path}/forwards.tsv", nodes) if there("forwards.tsv") else spark.createDataFrame([], ALIASES)
    return Taxonomy(nodes, synonyms, aliases, idspace)


def node_lines(nodes: DataFrame) -> DataFrame:
    """(value): the text rows of a node table (S-11); unique names and numbers of children are columns that it may have."""
    rank = F.when((F.col("rank") == "no rank") & (F.col("n_children") == 0), "no rank - terminal").otherwise(F.col("rank")) if "n_children" in nodes.columns else F.col("rank")
    fields = ["uid", F.coalesce("parent_uid", F.lit("")), F.coalesce("name", F.lit("")), rank, codecs.print_qids(F.col("source_ids")), F.coalesce("unique_name", F.lit("")) if "unique_name" in nodes.columns else F.lit(""), codecs.print_flags(F.col("proper_flags"), F.col("inferred_flags"))]
    return nodes.select(F.concat(F.concat_ws("\t|\t", *fields), F.lit("\t|\t")).alias("value"))


def synonym_lines(tax: Taxonomy, unique: DataFrame) -> DataFrame:
    """(value): the text rows of a synonym table (S-12); its unique name tells the node's, ``unique`` (uid, unique_name). Synonyms without a node or a name are left out."""
    own = tax.nodes.select("uid", F.col("name").alias("own")).join(unique, "uid", "left")
    d = tax.synonyms.where("name IS NOT NULL").join(own, "uid")
    told = F.concat("name", F.lit(" (synonym for "), F.coalesce(F.nullif("unique_name", F.lit("")), "own", "uid"), F.lit(")"))
    info = codecs.print_qids(F.col("source_ids")) if "source_ids" in tax.synonyms.columns else F.lit("")
    return d.select(F.concat(F.concat_ws("\t|\t", "name", "uid", F.coalesce("type", F.lit("synonym")), told, F.coalesce(info, F.lit(""))), F.lit("\t|\t")).alias("value"))


def write_taxonomy(tax: Taxonomy, path: str) -> None:
    """Node, synonym and alias tables as text under ``path``, with unique names; each with its header (S-11 to S-13)."""
    spark = tax.nodes.sparkSession
    pathed = settle(tree.with_children(tree.with_path(tax.nodes)))
    unique = settle(lookups.unique_names(pathed))

    def write(rows: DataFrame, name: str, *header: str) -> None:
        head = spark.createDataFrame([("\t|\t".join([*header, ""]),)], "value string")
        head.coalesce(1).union(rows).write.text(f"{path}/{name}.tsv")

    write(node_lines(pathed.join(unique, "uid", "left")), "taxonomy", "uid", "parent_uid", "name", "rank", "sourceinfo", "uniqname", "flags")
    write(synonym_lines(tax, unique), "synonyms", "name", "uid", "type", "uniqname", "sourceinfo")
    tax.aliases.where("id <> replacement").write.csv(f"{path}/forwards.tsv", sep="\t", header=True)
