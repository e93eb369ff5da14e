"""A corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as the
next stage's documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm import bpe, jaccard_join, line_dedup, mixing, quality
from grovespark.llm.common import Workspace, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the row rules or their host's verdict reject go."""
    return quality.keep(docs.select(*COLUMNS))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least 10 documents hold go; what is left of a document stays, with its new length."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS), min_chars=1, min_docs=10)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keyed(docs: DataFrame, work: Workspace) -> DataFrame:
    """``docs`` written once with a key ``row`` for each row: ids may be null or repeated."""
    return work.save(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "keyed", compression="zstd")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays (five words, 0.8): the one with the smallest doc_id.

    Every row is a document of its own, by its text: of repeated rows one stays, null ids come last in their group, and
    rows of one id with different texts are not near duplicates. Texts without words only repeat a row of their own id.
    """
    work = Workspace(spark, "near")
    docs = keyed(docs, work)
    links = jaccard_join.link(docs.select(F.col("row").alias("doc_id"), "text"), k=5, percent=80).withColumnRenamed("doc_id", "row")
    wordless = "n_shingles = 0 AND doc_id IS NOT NULL"
    group = [F.expr(f"CASE WHEN NOT ({wordless}) THEN component_id END").alias("group"), F.expr(f"CASE WHEN {wordless} THEN doc_id END").alias("own")]
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row")
    kept = links.join(docs.select("row", "doc_id"), "row").groupBy(*group).agg(first).select("row")
    return work.only(docs, kept, "row").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of all tokens by the weights of the domain - language - source tree, each row at most once."""
    work = Workspace(spark, "mix")
    docs = keyed(docs, work)
    counted = mixing.with_domain(docs).withColumn("n_tokens", mixing.count_tokens(F.col("text")))
    chosen = mixing.mix(counted, budget_share=0.9, epochs=1, seed=1, weight={"lang": mixing.language_weight()}, key="row").select("row")
    return work.only(docs, chosen, "row").select(*COLUMNS)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of every document's ids and of its decoded text."""
    import public_tokenizers

    return bpe.digests(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding", encode_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = work.save(docs, f"stage-{i + 1}")
    return docs


#: No SQL form: the links of near duplicates, the tree's budgets and the encoding are tested against plain versions.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
