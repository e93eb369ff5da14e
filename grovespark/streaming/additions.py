"""Addition documents as a stream: files arrive in any order, rows wait until their parents are known (I-7).

Each micro-batch writes what it adds under its own number (``created``, ``ids``, ``outcomes``) and the whole table of waiting rows.
A batch that runs again after a failure writes the same folders again and reads only those of earlier batches, so no
row is applied twice. Documents of one batch, and rows that waited, are applied in the log's order; a document that
comes a batch late can't change what later documents have matched by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from grovespark.model import SOURCE_IDS
from grovespark.operators.additions import DOCUMENT, ORIGINAL, ROW, Known, apply, log_rows

TABLES = {
    "created": f"uid string, parent_uid string, name string, rank string, source_ids {SOURCE_IDS}, proper_flags int, inferred_flags int, division string",
    "ids": "id string, uid string, division string", "outcomes": "doc string, pos int, tag string, outcome string, target string", "waiting": ROW, "seen": "doc string",
}


def state(spark: SparkSession, folder: str, table: str, before: int | None = None) -> DataFrame:
    """One table of all batches (waiting rows: of the last one) below ``before``, or of all."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    empty = spark.createDataFrame([], TABLES[table])
    if not fs.exists(where):
        return empty
    numbers = sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(where) if s.getPath().getName().startswith("batch="))
    numbers = [n for n in numbers if before is None or n < before]
    paths = [f"{folder}/{table}/batch={n}" for n in (numbers[-1:] if table == "waiting" else numbers)]
    return spark.read.schema(TABLES[table]).parquet(*paths) if paths else empty


def add_documents(docs: DataFrame, base: Known, folder: str, checkpoint: str, original: str = ORIGINAL) -> StreamingQuery:
    """Runs over all documents (DOCUMENT) of the stream that are there now, and stops."""

    def batch(own: DataFrame, number: int) -> None:
        spark = own.sparkSession
        made, ids = state(spark, folder, "created", number), state(spark, folder, "ids", number)
        # Created nodes are found by name with their own first source: the document and the id asked for.
        first = F.concat(F.get("source_ids", F.lit(0))["prefix"], F.lit(":"), F.get("source_ids", F.lit(0))["id"])
        have = Known(base.ids.union(ids), base.names.union(made.select("name", "uid", "division", first.alias("first"))))
        seen = state(spark, folder, "seen", number)
        fresh = log_rows(own.join(seen.withColumnRenamed("doc", "id"), "id", "left_anti"), original)
        a = apply(fresh.unionByName(state(spark, folder, "waiting", number)), have, wait=True)
        tables = {"created": a.created, "ids": a.ids, "outcomes": a.outcomes, "waiting": a.waiting, "seen": own.where("id IS NOT NULL").select(F.col("id").alias("doc")).distinct()}
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")

    return docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_documents(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """A stream of documents: JSON files with one document a line."""
    return spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", per_batch).json(folder)
