"""Text forms of flags, ids, ranks and names."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from grovespark.model import BIT, RANK_LEVELS, SOURCE_IDS, mask

#: Text names that set a proper flag, and those that set an inferred one.
PROPER_NAMES = {n: n for n in ("was_container", "inconsistent", "merged", "incertae_sedis", "unclassified", "environmental", "major_rank_conflict", "unplaced", "tattered", "not_otu", "viral", "hybrid", "hidden", "edited", "forced_visible", "extinct")} | {
    "D": "hidden", "incertae_sedis_direct": "was_container", "unclassified_direct": "was_container",
    "major_rank_conflict_direct": "major_rank_conflict", "extinct_direct": "extinct",
}
INFERRED_NAMES = {f"{n}_inherited": n for n in ("inconsistent", "merged", "incertae_sedis", "unclassified", "environmental", "major_rank_conflict", "unplaced", "tattered", "hidden", "extinct")} | {n: n for n in ("sibling_higher", "sibling_lower", "infraspecific", "barren")}


def rank_level(rank: Column | str) -> Column:
    """The level of a rank name; -1 without rank."""
    rank = F.col(rank) if isinstance(rank, str) else rank
    levels = F.create_map(*[F.lit(x) for pair in RANK_LEVELS.items() for x in pair])
    return F.coalesce(F.element_at(levels, rank), F.lit(-1))


def has(flags: Column, bits: int) -> Column:
    return flags.bitwiseAND(bits) != 0


def parse_flags(text: Column) -> tuple[Column, Column]:
    """(proper, inferred) bit masks of a comma list; unknown names count for nothing."""
    parts = F.split(F.coalesce(text, F.lit("")), ",")

    def fold(names: dict[str, str]) -> Column:
        bits = F.create_map(*[F.lit(x) for n, f in names.items() for x in (n, BIT[f])])
        return F.aggregate(parts, F.lit(0), lambda a, n: a.bitwiseOR(F.coalesce(F.element_at(bits, n), F.lit(0))))

    return fold(PROPER_NAMES), fold(INFERRED_NAMES)


def print_flags(proper: Column, inferred: Column) -> Column:
    """The comma list, in its fixed order."""
    both = proper.bitwiseOR(inferred)

    def own(flag: str, col: Column, as_name: str | None = None, unless: Column | None = None) -> Column:
        on = has(col, BIT[flag])
        return F.when(on if unless is None else on & ~unless, F.lit(as_name or flag))

    items: list[Column] = []
    for n in ("incertae_sedis", "unclassified", "environmental", "unplaced"):
        items += [own(n, proper), own(n, inferred, f"{n}_inherited")]
    items += [own("major_rank_conflict", proper), own("sibling_higher", proper, unless=has(proper, BIT["major_rank_conflict"])), own("major_rank_conflict", inferred, "major_rank_conflict_inherited")]
    items += [own(n, proper) for n in ("merged", "inconsistent", "was_container")]
    items += [own(n, both) for n in ("not_otu", "viral", "hybrid")]
    for n in ("hidden", "extinct"):
        items += [own(n, proper), own(n, inferred, f"{n}_inherited", has(proper, BIT[n]))]
    items += [own("infraspecific", both), own("barren", both, unless=has(both, BIT["infraspecific"]))]
    return F.concat_ws(",", *items)


def parse_qid(text: Column) -> Column:
    """A qualified id: ``prefix:id``; an IRI stays whole as prefix; nothing after the colon is a null id."""
    head, rest = F.split_part(text, F.lit(":"), F.lit(1)), F.regexp_extract(text, "^[^:]*:(.*)$", 1)
    prefix = F.when(text.startswith("http"), text).otherwise(F.when(head == "IF", F.lit("if")).otherwise(head))
    return F.struct(prefix.alias("prefix"), F.when(text.startswith("http") | (rest == ""), F.lit(None).cast("string")).otherwise(rest).alias("id"))


def parse_qids(text: Column) -> Column:
    """A comma list of qualified ids."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast(SOURCE_IDS)).otherwise(F.transform(F.split(text, ","), lambda x: parse_qid(x)))


def print_qid(qid: Column) -> Column:
    return F.when(qid["id"].isNull(), qid["prefix"]).otherwise(F.concat_ws(":", qid["prefix"], qid["id"]))


def print_qids(qids: Column) -> Column:
    return F.array_join(F.transform(qids, lambda q: print_qid(q)), ",")


@F.pandas_udf(StringType())
def _strip_marks(names: pd.Series) -> pd.Series:
    return names.map(lambda s: s if s is None else "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) not in ("Mn", "Lm", "Sk")))


def normalize_names(df: DataFrame, column: str = "name", out: str = "normal") -> DataFrame:
    """``df`` with diacritics stripped from ``column``; only distinct names beyond ASCII go through Python."""
    odd = df.where(F.col(column).rlike(r"[^\x00-\x7F]")).select(F.col(column).alias("_n")).distinct()
    fixed = odd.select("_n", _strip_marks("_n").alias("_s"))
    joined = df.join(fixed, F.col(column) == F.col("_n"), "left")
    value = F.coalesce("_s", F.col(column))
    return joined.withColumn(out, F.when(value != "", value)).drop("_n", "_s")


def gender_variant(name: Column) -> Column:
    """The name with -a for -us or -us for -a; null for others and for names without a space."""
    spaced = F.instr(name, " ") > 1
    return F.when(spaced & name.endswith("a"), F.regexp_replace(name, "a$", "us")).when(spaced & name.endswith("us"), F.regexp_replace(name, "us$", "a"))


def epithet_stem(name: Column) -> Column:
    return F.regexp_replace(name, "(us|um|a)$", "")


def ae_variant(name: Column) -> Column:
    return F.when(name.endswith("ae"), F.regexp_replace(name, "ae$", "ea"))


def canonical_name(text: Column) -> Column:
    """A name without its authority: leading lower- and title-case words up to the author; viruses stay whole."""
    viral = text.rlike("(?i)(phage|virus|viroid)")
    plain = F.regexp_extract(text, r"^([A-ZÀ-Þ×][\p{L}\-]+(?: (?:x |× )?[a-zà-ÿ][\p{L}\-]+)*)", 1)
    dated = text.rlike(r"\d") & ~text.rlike(r", \d{4}")
    return F.when(viral | (plain == "") | dated, text).otherwise(plain)


def subgenus_name(text: Column) -> Column:
    """``G (S) e`` to ``G e``, ``G (S)`` to ``S``."""
    return F.when(text.rlike(r"^\S+ \([^)]+\)$"), F.regexp_extract(text, r"\(([^)]+)\)$", 1)).otherwise(F.regexp_replace(text, r"^(\S+) \([^)]+\) ", "$1 "))


def newick_quote(name: Column) -> Column:
    """A label for bracket text: quoted where it holds a character with a meaning there; colons are spelled out."""
    safe = F.regexp_replace(name, ":", "<colon>")
    return F.when(safe.rlike(r"[\s()\[\],;']"), F.concat(F.lit("'"), F.regexp_replace(safe, "'", "''"), F.lit("'"))).otherwise(safe)


def is_binomial(name: Column) -> Column:
    return name.rlike("^[A-Z][a-z]+ [a-z]+$")


#: Words that mark names as unfit, hybrid, viral, or as containers.
NOT_OTU = r"\buncultured\b|\bunclassified\b|\bunidentified\b|\bunknown\b|\bmetagenomes?\b|\bother sequences\b|\bartificial\b|\blibraries\b|\bbogus duplicates\b|\bplasmids\b|\binsertion sequences\b|\bmidvariant sequence\b|\btransposons\b|\bunclassified sequences\b|\bsp\.$"
HYBRID = " x |×|\\bhybrid\\b"
VIRAL = r"\bviral\b|\b[Vv]iroids\b|\b[Vv]iruses\b|\bvirus\b"
ENVIRONMENTAL = r"\bmycorrhizal samples\b|\benvironmental samples\b"
INCERTAE = r"\b[Ii]ncertae [Ss]edis\b|\b[Ii]ncertae[Ss]edis\b|\b[Uu]nallocated\b|\b[Uu]nclassified\b|\bunassigned\b|\b[Mm]itosporic\b"


def name_flags(name: Column) -> Column:
    """The proper flags that a name asks for."""
    marks = [(NOT_OTU, "not_otu"), (HYBRID, "hybrid"), (VIRAL, "viral")]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(name.rlike(p), mask(f)).otherwise(0) for p, f in marks])


def container_flag(name: Column) -> Column:
    """What the children of a container by this name become; 0 for other names."""
    return F.when(name.rlike(ENVIRONMENTAL), BIT["environmental"]).when(name.rlike(r"\b[Uu]nclassified\b"), BIT["unclassified"]).when(name.rlike(INCERTAE), BIT["incertae_sedis"]).otherwise(0)


def accession_key(accession: Column) -> Column:
    return F.substring_index(accession, ".", 1)


def squash_date(text: Column) -> Column:
    return F.date_format(F.to_date(text, "yyyy-MM-dd"), "yyyyMMdd")
