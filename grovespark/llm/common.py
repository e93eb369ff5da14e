"""Shared helpers: the cluster's shared folder, written intermediate tables, bounded batches, joins on uneven keys."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting that removes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of bits (64 keys each) that are broadcast; beyond, a join by key takes their place.
MOST_BITS = 1 << 20
#: The characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names for shared files; a temporary one only where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


class Workspace:
    """Tables that a job writes under the shared folder, so that a lost executor costs no lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.made = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def path(self, label: str) -> str:
        self.made += 1
        return f"{self.root}/{self.made:03d}-{label}"

    def save(self, df: DataFrame, label: str, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
        """Write ``df`` as Parquet and return a frame that reads the written table. Its shuffle files go at once: nothing reads them again."""
        path, writer = self.path(label), df.write.option("compression", compression) if compression else df.write
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.written_at = path
        return out

    def drop(self, *tables: DataFrame | str) -> None:
        """Delete tables of this workspace that nothing reads any more."""
        for t in tables:
            path = t if isinstance(t, str) else t.written_at
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def settle(self) -> None:
        """Let the driver's collectors run, so that the plans, broadcast tables and shuffles of jobs that have ended go."""
        gc.collect()
        self.spark._jvm.System.gc()

    def only(self, docs: DataFrame, rows: DataFrame, key: str, most: int = MOST_BITS) -> DataFrame:
        """The rows of ``docs`` whose ``key`` is in ``rows``; texts are not shuffled.

        The keys travel as bits, a row for each 64 keys that follow each other, which is small where keys are dense (as row
        numbers are). More than ``most`` such rows are not broadcast: then the keys are joined.
        """
        at, bit = F.shiftright(F.col(key), 6), F.pmod(F.col(key), F.lit(64)).cast("int")
        bits = self.save(rows.where(F.col(key).isNotNull()).groupBy(at.alias("__at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("__bits")), "bits")
        if bits.count() > most:
            return docs.join(rows, key, "left_semi")
        return docs.join(F.broadcast(bits), at == F.col("__at")).where(F.getbit("__bits", bit) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))


def rebatch(batches: Iterator[pa.RecordBatch], at: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together or cut until column ``at`` (strings) holds about ``limit`` bytes; a longer row stands alone."""
    held, n = [], 0
    for b in batches:
        ends = np.cumsum(pa.compute.binary_length(b.column(at)).fill_null(0).to_numpy().astype(np.int64))
        i = 0
        while i < b.num_rows:
            start = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, start + limit - n, "right")))
            held.append(b.slice(i, j - i))
            n += int(ends[j - 1] - start)
            if j < b.num_rows or n >= limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
            i = j
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """All of ``left`` equal those of ``right``, nulls included."""
    out = F.lit(True)
    for x, y in zip(left, right, strict=True):
        out = out & x.eqNullSafe(y)
    return out


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", counts: DataFrame | None = None, by: Sequence[str] = (), total: int | None = None) -> DataFrame:
    """``left`` joined to ``right`` by ``on`` (nulls are equal), with heavy keys dealt to many tasks.

    A key is heavy if it holds more rows of ``left`` than a partition's fair share; there are at most as many such keys
    as partitions, and they get as many copies of their rows of ``right`` as they hold fair shares, at most twice the
    partitions in all. Each row of ``left`` meets exactly one copy: rows take turns, for which ``left`` must read a written
    table (so that a task that runs again deals its rows alike), or go by a hash of the columns ``by``. ``counts`` (on,
    n) says how many rows of ``left`` each key has, where that is known; ``total`` their sum.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = left.groupBy(*on).agg(F.count("*").alias("n")) if counts is None else counts
    total = counts.agg(F.sum("n")).first()[0] or 0 if total is None else total
    if not total:
        parts = 1
    heavy = counts.where(F.col("n") * parts > F.lit(total)).select(*(F.col(c).alias(f"__{c}") for c in on), F.ceil(F.col("n") * parts / F.lit(max(total, 1))).cast("int").alias("__copies"))
    held = [f"__{c}" for c in on]

    def marked(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(heavy), same([df[c] for c in on], [heavy[c] for c in held]), "left").drop(*held)

    mine = marked(left).withColumn("__salt", F.when(F.col("__copies").isNull(), 0).otherwise(F.pmod(F.xxhash64(*by) if by else F.monotonically_increasing_id(), F.col("__copies"))).cast("int")).drop("__copies")
    theirs = marked(right).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__copies", F.lit(1)) - 1))).drop("__copies")
    theirs = theirs.select(*(F.col(c).alias(f"__{c}") if c in {*on, "__salt"} else F.col(c) for c in theirs.columns))
    joined = mine.join(theirs, same([F.col(c) for c in (*on, "__salt")], [F.col(f"__{c}") for c in (*on, "__salt")]), how)
    return joined.drop("__salt", "____salt", *held)


def text_key(text: str = "text") -> list[Column]:
    """Two hashes of a text, which with its id tell rows apart as far as operators on texts can."""
    return [F.xxhash64(text), F.xxhash64(F.lit(3), text)]


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(col, UPPER, LOWER)


def folded(col: Column) -> Column:
    """A string that is the same for two strings just if they differ in the case of A-Z alone; cheaper than ``ascii_lower``.

    The bytes are read as Latin-1 and lower-cased: lead bytes of two-byte characters move as well, but to places that
    the number of bytes that go on tells apart from lead bytes of three- and four-byte characters.
    """
    return F.lower(F.decode(col.cast("binary"), "ISO-8859-1"))


def crc(col: Column) -> Column:
    """crc32 of a key written as text."""
    return F.crc32(col.cast("string").cast("binary"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
