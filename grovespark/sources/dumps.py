"""Dumps of one JSON object a line, scanned for the pages and ids of known nodes (S-28)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the format: the class of taxa, the properties that hold ids of sources, and the one that holds the id of a page.
TAXON_CLASS = 16521
ID_PROPERTIES = {"P685": "ncbi", "P846": "gbif", "P850": "worms", "P1391": "if"}
PAGE_PROPERTY = "P830"


@dataclass(frozen=True)
class Scan:
    #: (uid, item, page, title_<site>...): each distinct row once.
    links: DataFrame
    #: (line, problem) of lines that look like a taxon but are no JSON, or have no claim of a class.
    problems: DataFrame


def known_ids(nodes: DataFrame) -> DataFrame:
    """(prefix, id, uid): one node for every source id, the least by uid.

    An ncbi id right before a silva id came by way of silva: it stands for its node only where no other node has the id.
    """
    q = nodes.select("uid", F.posexplode("source_ids").alias("at", "q"), F.col("source_ids").alias("all"))
    by_silva = (F.col("q.prefix") == "ncbi") & F.coalesce(F.get("all", F.col("at") + 1)["prefix"] == "silva", F.lit(False))
    return q.groupBy("q.prefix", "q.id").agg(F.min(F.struct(by_silva.alias("late"), "uid")).alias("m")).select("prefix", "id", "m.uid")


def scan(lines: DataFrame, nodes: DataFrame, sites: Sequence[str] = (), properties: Mapping[str, str] = ID_PROPERTIES, page: str = PAGE_PROPERTY, taxon: int = TAXON_CLASS) -> Scan:
    """The items of ``lines`` (line) that are taxa and share an id with one of ``nodes`` (S-28).

    Only lines that begin as an item and mention the class are parsed; a comma at a line's end and the array's brackets don't matter. An item is a taxon if one
    of its claims says so; claims without a value are passed over. Its rows are all nodes that one of its ids stands for; page and
    titles are null where it has none. ``sites`` and ``properties`` are names without quotes.
    """
    near = lines.where(F.col("line").startswith('{"type":"item') & F.col("line").contains(f'"numeric-id":{taxon}' + "}"))
    v = near.select("line", F.try_parse_json(F.regexp_replace("line", r"[,\s]+$", "")).alias("v"))
    classes = F.try_variant_get("v", "$.claims.P31", "array<variant>")
    of_class = F.exists(classes, lambda c: F.try_variant_get(c, "$.mainsnak.datavalue.value['numeric-id']", "bigint") == taxon)
    problem = F.when(F.col("v").isNull(), "no JSON").when(classes.isNull(), "no class")
    problems = v.select("line", problem.alias("problem")).where("problem IS NOT NULL")
    titles = {f"title_{s}": F.try_variant_get("v", f"$.sitelinks['{s}'].title", "string") for s in sites}
    taxa = v.where(F.coalesce(of_class, F.lit(False))).select(
        F.try_variant_get("v", "$.id", "string").alias("item"), F.try_variant_get("v", f"$.claims.{page}[0].mainsnak.datavalue.value", "string").alias("page"), *(c.alias(n) for n, c in titles.items()),
        F.explode(F.array(*(F.struct(F.lit(prefix).alias("prefix"), F.try_variant_get("v", f"$.claims.{p}", "array<variant>").alias("claims")) for p, prefix in properties.items()))).alias("c"),
    )
    ids = taxa.select("item", "page", *titles, F.col("c.prefix").alias("prefix"), F.explode("c.claims").alias("claim")).withColumn("id", F.try_variant_get("claim", "$.mainsnak.datavalue.value", "string")).drop("claim")
    return Scan(ids.join(known_ids(nodes), ["prefix", "id"]).select("uid", "item", "page", *titles).distinct(), problems)
