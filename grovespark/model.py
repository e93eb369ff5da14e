"""The data model: a forest of named nodes with synonyms and id aliases, as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_IDS = "array<struct<prefix:string,id:string>>"
NODES = f"uid string, parent_uid string, name string, rank string, source_ids {SOURCE_IDS}, proper_flags int, inferred_flags int"
SYNONYMS = "uid string, name string, type string"
ALIASES = "id string, replacement string"
COLUMNS = ["uid", "parent_uid", "name", "rank", "source_ids", "proper_flags", "inferred_flags"]

#: Rank names by group; a rank's level is 100 for each group and 10 for each place in it.
RANK_GROUPS = (
    ("domain", "superkingdom", "kingdom", "subkingdom", "division", "infrakingdom", "superphylum"),
    ("phylum", "subphylum", "infraphylum", "subdivision", "superclass"),
    ("class", "subclass", "infraclass", "subterclass", "cohort", "subcohort", "superorder"),
    ("order", "suborder", "infraorder", "parvorder", "section", "subsection", "superfamily"),
    ("family", "subfamily", "supertribe", "tribe", "subtribe"),
    ("genus", "subgenus", "species group", "species subgroup"),
    ("species", "infraspecificname", "subspecies", "natio", "variety", "varietas", "subvariety", "form", "forma", "subform", "cluster"),
)
RANK_LEVELS = {name: (i + 1) * 100 + j * 10 for i, group in enumerate(RANK_GROUPS) for j, name in enumerate(group)} | {"no rank": -1}
GENUS, FAMILY, SPECIES = RANK_LEVELS["genus"], RANK_LEVELS["family"], RANK_LEVELS["species"]

#: The bit of each flag.
FLAG_BITS = {
    "was_container": 0, "inconsistent": 1, "merged": 2, "major_rank_conflict": 3, "unclassified": 4, "environmental": 5,
    "incertae_sedis": 6, "unplaced": 7, "tattered": 8, "not_otu": 9, "hybrid": 10, "viral": 11, "sibling_higher": 13,
    "sibling_lower": 14, "hidden": 16, "extinct": 17, "forced_visible": 18, "edited": 19, "infraspecific": 21, "barren": 22,
}
BIT = {name: 1 << b for name, b in FLAG_BITS.items()}


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


FORMER_CONTAINER = mask("was_container", "inconsistent", "merged")
UNPLACED_ANY = mask("major_rank_conflict", "unclassified", "environmental", "incertae_sedis", "unplaced")
SUPPRESSED = mask("hidden", "extinct", "barren", "not_otu", "hybrid", "viral", "tattered") | FORMER_CONTAINER | UNPLACED_ANY
INFERRED_ONLY = mask("sibling_higher", "sibling_lower", "infraspecific", "barren")


@dataclass(frozen=True)
class Taxonomy:
    """A forest. ``nodes`` has COLUMNS (a root has a null parent_uid); operators return a new one."""

    nodes: DataFrame
    synonyms: DataFrame
    aliases: DataFrame
    idspace: str = ""

    def with_nodes(self, nodes: DataFrame) -> Taxonomy:
        return replace(self, nodes=nodes)


def taxonomy(nodes: DataFrame, synonyms: DataFrame | None = None, aliases: DataFrame | None = None, idspace: str = "") -> Taxonomy:
    """A taxonomy from any frame with uid and parent_uid; what is missing gets its default."""
    spark = nodes.sparkSession
    defaults = {"name": F.lit(None).cast("string"), "rank": F.lit("no rank"), "source_ids": F.array().cast(SOURCE_IDS), "proper_flags": F.lit(0), "inferred_flags": F.lit(0)}
    nodes = nodes.select("uid", "parent_uid", *(F.col(c) if c in nodes.columns else d.alias(c) for c, d in defaults.items()))
    return Taxonomy(nodes, synonyms if synonyms is not None else spark.createDataFrame([], SYNONYMS), aliases if aliases is not None else spark.createDataFrame([], ALIASES), idspace)


def rank_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RANK_LEVELS.items()), "rank string, level int")
