"""Quality rules with host-level verdicts, in DataFrame operations only.

Row rules over the whole text: counts of words, word characters, symbols, lines that repeat an earlier line, and words
in 8-word windows that occur twice or more. A document fails the base rule if it has fewer than 20 words or if more
than 30 % of its words are in repeated windows. A host (the ``source``) collects how often each of three rules fails:
base, symbols (more than 30 symbols per 100 word characters) and repeated lines (more than half). Its rate is shrunk
by a beta prior that is fitted to the rates of all hosts by moments (what sampling alone would vary is taken off). The
limit goes with the prior: three times its mean, but at least a quarter and at most 0.6; a host one of whose shrunk
rates lies above it by two posterior deviations is rejected with all its documents.

Defined cases: a null or empty text has zeros and fails the base rule; a null host is a host of its own; repeated rows
count each; an empty table gives an empty result; other columns stay in ``judge`` and ``keep``, whatever their names
(those of the counts and verdicts are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm.common import SPACES, Workspace, same, spread_join, table, text_key

SYMBOLS = "#*$%&|<>"
WINDOW = 8
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = {
    "base": "base_failed",
    "symbols": "100 * n_symbols > 30 * word_chars",
    "lines": "2 * n_dup_lines > n_filled_lines",
}
#: The strength of the prior, in documents, where the hosts' rates don't vary more than samples do.
STRONGEST = 1000.0
#: The limit: so many times the prior's mean, between two bounds; and the deviations that a rate must lie above it.
TIMES, LEAST, MOST, SURE = 3.0, 0.25, 0.6, 2.0


def _counted(text: Column) -> dict[str, Column]:
    """The counts that need no more than lists of words and lines."""
    plain = text
    for c in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    words = F.array_remove(F.split(plain, " "), "")
    filled = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    symbols = F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))
    return {"words": words, "filled": filled, "n_symbols": symbols.cast("long")}


def measure(docs: DataFrame, *carried: Column) -> DataFrame:
    """``carried`` columns with the counts of every whole ``text`` and ``base_failed``."""
    kept = F.struct(*carried).alias("carried")
    a = docs.select(kept, *(c.alias(n) for n, c in _counted(F.coalesce("text", F.lit(""))).items()))
    a = a.select(
        "carried", F.transform("words", lambda w: F.xxhash64(w)).alias("h"), F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        F.size("filled").cast("long").alias("n_filled_lines"), (F.size("filled") - F.size(F.array_distinct("filled"))).cast("long").alias("n_dup_lines"),
    )
    ahead = ", ".join(f"h[i + {t}]" for t in range(WINDOW))
    a = a.withColumn("g", F.expr(f"CASE WHEN n_words >= {WINDOW} THEN transform(sequence(0, size(h) - {WINDOW}), i -> xxhash64({ahead})) END"))
    # Only texts in which some window repeats are sorted.
    a = a.withColumn("s", F.expr("CASE WHEN size(array_distinct(g)) < size(g) THEN array_sort(transform(g, (x, i) -> struct(x AS x, i AS i))) END"))
    a = a.withColumn("p", F.expr("array_sort(transform(filter(sequence(0, size(s) - 1), j -> s[j].x = get(s, j - 1).x OR s[j].x = get(s, j + 1).x), j -> s[j].i))"))
    repeat = f"aggregate(sequence(0, size(p) - 1), 0L, (n, j) -> n + least({WINDOW}, coalesce(get(p, j + 1) - p[j], {WINDOW})))"
    a = a.withColumn("n_repeat_words", F.expr(f"CASE WHEN p IS NULL THEN 0L ELSE {repeat} END"))
    a = a.withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
    return a.select("carried", *STATS, "n_filled_lines", "base_failed")


def host_verdicts(measured: DataFrame) -> DataFrame:
    """(host, n, rates, limits, rejected) of every host of ``measured`` (``carried.host`` and the counts)."""
    counts = measured.groupBy(F.col("carried.host").alias("host")).agg(F.count("*").alias("n"), *(F.sum(F.expr(r).cast("double")).alias(f"f_{k}") for k, r in RULES.items()))
    moments = counts.agg(*(F.avg(F.expr(f"f_{k} / n")).alias(f"m_{k}") for k in RULES), *(F.var_pop(F.expr(f"f_{k} / n")).alias(f"v_{k}") for k in RULES), F.avg(F.expr("1 / n")).alias("one"))
    out = counts.join(F.broadcast(moments))  # a single row
    for k in RULES:
        out = out.withColumn("own", F.expr(f"v_{k} - m_{k} * (1 - m_{k}) * one"))
        out = out.withColumn("k", F.expr(f"CASE WHEN own > 0 THEN greatest(2.0D, least({STRONGEST}D, m_{k} * (1 - m_{k}) / own - 1)) ELSE {STRONGEST}D END"))
        out = out.withColumn(f"rate_{k}", F.expr(f"(f_{k} + m_{k} * k) / (n + k)"))
        out = out.withColumn(f"limit_{k}", F.expr(f"least({MOST}D, greatest({LEAST}D, {TIMES}D * m_{k}))"))
        out = out.withColumn(f"over_{k}", F.expr(f"rate_{k} - {SURE}D * sqrt(rate_{k} * (1 - rate_{k}) / (n + k + 1)) > limit_{k}"))
    return out.select("host", "n", *(f"rate_{k}" for k in RULES), *(f"limit_{k}" for k in RULES), F.expr(" OR ".join(f"over_{k}" for k in RULES)).alias("rejected"))


def _verdicts(measured: DataFrame, work: Workspace) -> DataFrame:
    """``measured`` with ``kept``; a host of many documents is dealt to many tasks."""
    hosts = work.save(host_verdicts(measured), "hosts")
    bad = hosts.where("rejected").select("host", F.lit(True).alias("bad"))
    rows = measured.withColumn("host", F.col("carried.host"))
    return spread_join(rows, bad, ["host"], "left", counts=hosts.select("host", "n")).withColumn("kept", ~F.col("base_failed") & F.col("bad").isNull()).drop("host", "bad")


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """``docs`` with all counts, ``base_failed`` and ``kept``. The measured rows are written once and read by both sides."""
    work = Workspace(docs.sparkSession, "quality")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    measured = work.save(measure(docs, F.col(host).alias("host"), row.alias("row")), "measured")
    added = [*STATS, "base_failed", "kept"]
    return _verdicts(measured, work).select(*(F.col(f"carried.row.`{c}`").alias(c) for c in docs.columns if c not in added), *added)


def keep(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept. No text is written or, while few rows are rejected, shuffled.

    A row is known by its id, host and text: equal rows get equal verdicts.
    """
    work = Workspace(docs.sparkSession, "quality")
    known = dict(zip(("id", "host", "t1", "t2"), [F.col("doc_id"), F.col(host), *text_key()], strict=True))
    measured = work.save(measure(docs, *(c.alias(n) for n, c in known.items())), "measured")
    gone = work.save(_verdicts(measured, work).where("NOT kept").select(*(F.col(f"carried.{n}").alias(f"gone_{n}") for n in known)).distinct(), "rejected")
    work.drop(measured)
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(c.alias(f"own_{n}") for n, c in known.items()))
    left = row.join(gone, same([F.col(f"own_{n}") for n in known], [F.col(f"gone_{n}") for n in known]), "left_anti")
    return left.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, work = table(spark, sf_dir, "documents"), Workspace(spark, "quality")
    measured = work.save(measure(docs, F.col("source").alias("host"), "doc_id"), "measured")
    return _verdicts(measured, work).select(F.col("carried.doc_id").alias("doc_id"), *STATS, "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS fl FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
x AS (SELECT r, i, list_slice(ws, i, i + 7) AS win FROM g),
y AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM x),
z AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM y WHERE c >= 2) GROUP BY r),
s AS (SELECT w.r, doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
             len(fl) - len(list_distinct(fl)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(fl) AS n_filled FROM w LEFT JOIN z USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s),
h AS (SELECT source, count(*) AS n, sum(base_failed::int)::double AS f1, sum((100 * n_symbols > 30 * word_chars)::int)::double AS f2, sum((2 * n_dup_lines > n_filled)::int)::double AS f3 FROM b GROUP BY source),
m AS (SELECT avg(f1 / n) m1, avg(f2 / n) m2, avg(f3 / n) m3, var_pop(f1 / n) v1, var_pop(f2 / n) v2, var_pop(f3 / n) v3, avg(1 / n) one FROM h),
k AS (SELECT m1, m2, m3, CASE WHEN v1 - m1 * (1 - m1) * one > 0 THEN greatest(2, least(1000, m1 * (1 - m1) / (v1 - m1 * (1 - m1) * one) - 1)) ELSE 1000 END k1,
             CASE WHEN v2 - m2 * (1 - m2) * one > 0 THEN greatest(2, least(1000, m2 * (1 - m2) / (v2 - m2 * (1 - m2) * one) - 1)) ELSE 1000 END k2,
             CASE WHEN v3 - m3 * (1 - m3) * one > 0 THEN greatest(2, least(1000, m3 * (1 - m3) / (v3 - m3 * (1 - m3) * one) - 1)) ELSE 1000 END k3 FROM m),
q AS (SELECT *, (f1 + m1 * k1) / (n + k1) AS r1, (f2 + m2 * k2) / (n + k2) AS r2, (f3 + m3 * k3) / (n + k3) AS r3 FROM h, k),
v AS (SELECT source, r1 - 2 * sqrt(r1 * (1 - r1) / (n + k1 + 1)) > least(0.6, greatest(0.25, 3 * m1)) OR
             r2 - 2 * sqrt(r2 * (1 - r2) / (n + k2 + 1)) > least(0.6, greatest(0.25, 3 * m2)) OR
             r3 - 2 * sqrt(r3 * (1 - r3) / (n + k3 + 1)) > least(0.6, greatest(0.25, 3 * m3)) AS rejected FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""
