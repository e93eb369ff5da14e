"""Line dedup over levelled sorted runs of line hashes, in DataFrame operations only.

A line's key is the line with space and U+0009-U+000D stripped at both ends and A-Z lower-cased, held as two 64-bit
hashes. Documents come in batches. A batch first drops the keys that the runs already know as frequent (a merge
anti-join: runs are bucketed and sorted by the hash), counts the others (documents per key) and adds them as a sorted
run of level 0. When a level has ``fan_in`` runs they are compacted into one run of the next level. The keys whose
counts reach the limit over all runs are frequent; their lines go from every document, the first copies included.

Defined cases: a null or empty text is one empty line with an empty key, shorter than any ``min_chars`` of 1 or more,
so it stays; a text whose lines all go becomes empty; repeated rows count as documents of their own; null doc_ids are
treated like any other; documents keep their other columns, whatever their names (``n_lines`` and ``n_dropped`` are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm.common import SPACES, Workspace, folded, same, spread_join, table, text_key


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def key_hashes(text: Column, min_chars: int) -> Column:
    """The two hashes of every line's key, in order; null where the key is too short to count."""
    trimmed = F.transform(lines(text), lambda x: F.trim(x, F.lit(SPACES)))
    keys = F.transform(trimmed, lambda x: F.when(F.length(x) >= min_chars, folded(x)))
    return F.transform(keys, lambda k: F.when(k.isNotNull(), F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(7), k).alias("h2"))))


class LineRuns:
    """The levelled runs of one corpus: tables (h1, h2, n) bucketed and sorted by the hashes."""

    def __init__(self, work: Workspace, min_docs: int, fan_in: int = 2):
        self.work, self.min_docs, self.fan_in, self.levels, self.names = work, min_docs, fan_in, [], []
        self.buckets = int(work.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, counts: DataFrame, label: str) -> DataFrame:
        name = f"line_run_{self.work.root.rpartition('-')[2]}_{len(self.names)}"
        path = self.work.path(label)
        counts.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(name)
        self.names.append(name)
        out = self.work.spark.table(name)
        out.written_at = path
        return out

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def add(self, keys: DataFrame) -> None:
        """Add a batch: ``keys`` has one row (h1, h2) per document and distinct key."""
        counts = keys.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        for run in self.runs():
            counts = counts.join(run.where(F.col("n") >= self.min_docs), ["h1", "h2"], "left_anti")
        self._put(0, self._write(counts, "run-0"))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            merged = self._write(self._sum(self.levels[level]), f"run-{level + 1}")
            self.work.drop(*self.levels[level])
            self.levels[level] = []
            self._put(level + 1, merged)

    @staticmethod
    def _sum(runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for r in runs[1:]:
            both = both.unionByName(r)
        return both.groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        return self.work.save(self._sum(self.runs()).where(F.col("n") >= self.min_docs).select("h1", "h2", "n"), "frequent")

    def close(self) -> None:
        for run in self.runs():
            self.work.drop(run)
        for name in self.names:
            self.work.spark.sql(f"DROP TABLE IF EXISTS {name}")


def frequent_keys(hashed: DataFrame, min_docs: int, batches: int, work: Workspace) -> DataFrame:
    """(h1, h2, n) of keys in ``n``, at least ``min_docs``, documents, through ``batches`` batches of ``hashed`` (batch, keys)."""
    runs = LineRuns(work, min_docs)
    for b in range(batches):
        runs.add(hashed.where(F.col("batch") == b).select(F.explode(F.array_distinct("keys")).alias("k")).where("k IS NOT NULL").select("k.h1", "k.h2"))
    out = runs.frequent()
    runs.close()
    return out


def dedup_lines(docs: DataFrame, min_chars: int = 1, min_docs: int = 10, batches: int = 4) -> DataFrame:
    """``docs`` with the cleaned ``text``, and ``n_lines``, ``n_dropped``. Each row is a document.

    Lines are hashed once; what is written and joined are hashes. A line that a large share of all documents hold is
    dealt to many tasks.
    """
    work = Workspace(docs.sparkSession, "lines")
    # A row is known by its id and its text: equal rows get equal answers, though each counts as a document.
    known = dict(zip(("id", "t1", "t2"), [F.col("doc_id"), *text_key()], strict=True))
    hashed = docs.select(*(c.alias(n) for n, c in known.items()), key_hashes(F.col("text"), min_chars).alias("keys"))
    hashed = work.save(hashed.withColumn("batch", F.pmod(F.xxhash64("id", "t1"), F.lit(batches)).cast("int")), "hashes", partition_by="batch")
    frequent = frequent_keys(hashed, min_docs, batches, work)
    found = hashed.select(*known, F.posexplode("keys").alias("at", "k")).where("k IS NOT NULL").select(*known, "at", "k.h1", "k.h2")
    hit = spread_join(found, frequent.select("h1", "h2"), ["h1", "h2"], "left_semi", counts=frequent)
    gone = work.save(hit.groupBy(*known).agg(F.sort_array(F.collect_set("at")).alias("gone")), "gone")
    work.drop(hashed, frequent)
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(c.alias(f"own_{n}") for n, c in known.items()))
    joined = own.join(gone, same([F.col(f"own_{n}") for n in known], [F.col(n) for n in known]), "left")
    # The lines between two dropped positions are one slice, so the work grows with the lines alone.
    kept = F.expr("""array_join(flatten(transform(concat(array(-1), gone), (p, i) ->
        slice(split(coalesce(row.text, ''), '\\n'), p + 2, coalesce(get(gone, i), size(split(coalesce(row.text, ''), '\\n'))) - p - 1))), '\\n')""")
    text, hits = F.coalesce("row.text", F.lit("")), F.col("gone").isNotNull()
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    extra = {"n_lines": n_lines.cast("long"), "n_dropped": F.when(hits, F.size("gone")).otherwise(F.lit(0)).cast("long"), "text": F.when(hits, kept).otherwise(text)}
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in extra], *[c.alias(n) for n, c in extra.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=1, min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (SELECT rowid_ AS r, doc_id, generate_subscripts(ls, 1) AS nth, unnest(ls) AS line
           FROM (SELECT row_number() OVER () AS rowid_, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM f)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (key NOT IN (SELECT key FROM f)), '')) AS kept_sha256
FROM k GROUP BY r, doc_id
"""
