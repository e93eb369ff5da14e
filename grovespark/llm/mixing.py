"""Mixing sources to target weights: a budget of tokens handed down a domain - language - source tree.

Every node's weight is its share among its siblings; a node's supply is ``epochs`` times the tokens below it. The
budget goes down the tree level by level: a node's money is split among its children by weight, what a child can't use
goes to its siblings by weight (again and again until none is short or all are full), and only what all of them can't
use goes back, so a shortage meets siblings before ancestors. Each leaf then takes whole documents in the order of a
seeded hash, epoch after epoch, as long as the running number of tokens stays within its budget.

Sizes: the tree's tables have a row per leaf and are split by DataFrame windows over siblings, never collected. A
leaf's running sum runs over ``BINS`` ranges of the hash first; only the range that the budget ends in is ordered row
by row, so a source with a third of all rows is no single task's work.

Defined cases: null labels are nodes of their own; documents without tokens cost nothing and are taken with the prefix;
a null text has no tokens; repeated rows are documents of their own; an empty table or a budget of 0 takes nothing but
documents without tokens in the first range; other columns stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.llm.common import SPACES, Workspace, same, table

BINS = 4096
LEVELS = ("domain", "lang", "source")
#: Weights of languages among their siblings; sources and domains weigh alike.
LANGUAGE_WEIGHTS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}


def count_tokens(text: Column) -> Column:
    """Words between spaces."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def with_domain(docs: DataFrame) -> DataFrame:
    """A domain for each document: the letters that its source begins with."""
    return docs.withColumn("domain", F.regexp_extract(F.coalesce("source", F.lit("")), "^([A-Za-z]*)", 1))


def split_budget(leaves: DataFrame, levels: Sequence[str], budget: Column, weight: Mapping[str, Column], work: Workspace) -> DataFrame:
    """``leaves`` (levels, supply) with the leaf's budget ``allowed``.

    At each level children are filled in the order of supply / weight: a child whose supply is below its fair share of
    what is left is full, and the fair share of the others grows; this is the fixed point of handing on what a child
    can't use to its siblings.
    """
    # What each subtree can use, from the leaves up.
    sizes = [leaves.groupBy(*levels[: k + 1]).agg(F.sum("supply").alias(f"supply_{k}")) for k in range(len(levels))]
    now = None
    for k, level in enumerate(levels):
        own = sizes[k].withColumn("w", weight.get(level, F.lit(1.0)).cast("double"))
        if k == 0:
            own, up = own.withColumn("money", budget.cast("double")), []
        else:
            up = list(levels[:k])
            on = same([own[c] for c in up], [now[c] for c in up])
            own = own.join(now.select(*up, F.col("given").alias("money")), on).select(*(own[c] for c in own.columns), "money")
        order = Window.partitionBy(*up).orderBy(F.col(f"supply_{k}") / F.col("w"), *levels[: k + 1])
        before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        # The level of water if all before are full: full while the supply lies below it; later ones share the rest alike.
        own = own.withColumns({"fair": (F.col("money") - F.coalesce(F.sum(f"supply_{k}").over(before), F.lit(0))) / F.sum("w").over(rest)})
        own = own.withColumn("short", F.col(f"supply_{k}") <= F.col("fair") * F.col("w"))
        # The first that is not full has the highest fair share of those that aren't: the supplies before it are all met.
        own = own.withColumn("water", F.max(F.when(~F.col("short"), F.col("fair"))).over(Window.partitionBy(*up)))
        now = own.withColumn("given", F.when(F.col("short") | F.col("water").isNull(), F.col(f"supply_{k}").cast("double")).otherwise(F.col("water") * F.col("w"))).select(*levels[: k + 1], f"supply_{k}", "given")
    return work.save(now.select(*levels, F.floor(F.col("given") + 1e-6).cast("long").alias("allowed")), "budgets")


def mix(docs: DataFrame, budget_share: float = 0.5, epochs: int = 1, seed: int = 1, levels: Sequence[str] = LEVELS, weight: Mapping[str, Column] | None = None, key: str | None = None) -> DataFrame:
    """The chosen documents with ``n_tokens`` and ``epoch`` (from 1): ``budget_share`` of all tokens by the weights.

    Needs the columns of ``levels``, doc_id and n_tokens. A document's order within its leaf is the md5 of seed, epoch
    and id; where its first 6 digits are equal, a hash of the row, the rest of the md5, the id and the row. ``key``: a column of longs that tells rows apart, which the result keeps.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "mixing")
    weight = weight or {}
    slim = work.save(docs.select(*levels, "doc_id", "n_tokens", (F.col(key) if key else F.monotonically_increasing_id()).alias("row")), "slim")
    leaves = work.save(slim.groupBy(*levels).agg((F.sum("n_tokens") * epochs).alias("supply"), F.sum("n_tokens").alias("once")), "leaves")
    total = leaves.agg(F.sum("once")).first()[0] or 0
    budgets = split_budget(leaves, levels, F.lit(float(total) * budget_share), weight, work)

    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    every = slim.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).withColumn("o", order).withColumn("bin", F.conv(F.substring("o", 1, 3), 16, 10).cast("int"))
    bins = every.groupBy(*levels, "epoch", "bin").agg(F.sum("n_tokens").alias("own"))
    run = Window.partitionBy(*levels).orderBy("epoch", "bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("upto", F.sum("own").over(run)).withColumn("start", F.col("upto") - F.col("own"))
    on = same([F.col(f"b.{c}") for c in levels], [F.col(f"q.{c}") for c in levels])
    placed = bins.alias("b").join(budgets.alias("q"), on).select(*(F.col(f"b.{c}").alias(f"_{c}") for c in levels), F.col("epoch").alias("_epoch"), F.col("bin").alias("_bin"), "start", "upto", "allowed").where("start <= allowed")
    on = same([F.col(c) for c in ("epoch", "bin", *levels)], [F.col(f"_{c}") for c in ("epoch", "bin", *levels)])
    met = every.join(work.save(placed, "bins"), on).select("row", *levels, "doc_id", "n_tokens", "epoch", "o", "bin", "start", "upto", "allowed")
    met = work.save(met, "met")
    inside = met.where("upto <= allowed").select("row", "epoch")
    # The ranges that the budgets end in are cut once more, by the next digits and then the row: many rows of one id are spread too.
    edge = work.save(met.where("upto > allowed").withColumn("fine", F.concat(F.substring("o", 4, 3), F.lpad(F.pmod(F.xxhash64("row"), F.lit(BINS)).cast("string"), 4, "0"))), "edge")
    leaf = [*levels, "epoch", "bin"]
    fine = edge.groupBy(*leaf, "fine").agg(F.sum("n_tokens").alias("own"))
    run = Window.partitionBy(*leaf).orderBy("fine").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = work.save(fine.withColumn("before", F.sum("own").over(run) - F.col("own")).select(*(F.col(c).alias(f"_{c}") for c in (*leaf, "fine")), "before"), "fine")
    edge = edge.join(fine, same([F.col(c) for c in (*leaf, "fine")], [F.col(f"_{c}") for c in (*leaf, "fine")])).where("start + before <= allowed")
    within = Window.partitionBy(*leaf, "fine").orderBy("o", "doc_id", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("sum", F.col("start") + F.col("before") + F.sum("n_tokens").over(within)).where("sum <= allowed").select("row", "epoch")
    return work.save(slim.join(inside.union(edge), "row").select(*levels, "doc_id", "n_tokens", "epoch", *([F.col("row").alias(key)] if key else [])), "chosen")


def language_weight() -> Column:
    out = F.lit(1.0)
    for code, w in LANGUAGE_WEIGHTS.items():
        out = F.when(F.col("lang") == code, w).otherwise(out)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: (doc_id, epoch, domain, lang, source, n_tokens) of the mixed corpus: half of all tokens, at most two epochs."""
    docs = with_domain(table(spark, sf_dir, "documents")).withColumn("n_tokens", count_tokens(F.col("text")))
    return mix(docs, budget_share=0.5, epochs=2, seed=1, weight={"lang": language_weight()})
