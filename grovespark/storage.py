"""Cutting lineage through tables written to the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder in the one that the session names in spark.checkpoint.dir, or in a temporary one where it names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


#: How many times the size of their files written tables of ids, names and paths are taken to be in memory; fifty times was measured.
IN_MEMORY = 100.0
FACTOR = "spark.sql.sources.fileCompressionFactor"


def _sized(spark: SparkSession) -> None:
    """Has the session estimate tables by their size in memory, unless it was told otherwise.

    By the size of files Spark plans broadcasts of tables with a million rows, which pass whole through the driver.
    Tables that turn out to be small are still broadcast while the query runs.
    """
    if float(spark.conf.get(FACTOR)) == 1:
        spark.conf.set(FACTOR, str(IN_MEMORY))


def settle(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the folder that the session names in spark.checkpoint.dir, and read from there.

    The written table has statistics and its columns can be pruned; losing an executor loses nothing.
    """
    _sized(df.sparkSession)
    path = scratch(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Pile:
    """A table that grows by parts. All parts are read as one relation, so plans stay as small however many there are."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self.paths, self.schema = spark, scratch(spark, label), [], None

    def add(self, part: DataFrame) -> DataFrame:
        """``part`` written beside the others, and read from there."""
        _sized(self.spark)
        path = f"{self.folder}/{len(self.paths)}"
        part.write.parquet(path)
        self.paths.append(path)
        self.schema = self.schema or part.schema
        return self.spark.read.schema(self.schema).parquet(path)

    def all(self) -> DataFrame | None:
        """All parts; None before the first."""
        return self.spark.read.schema(self.schema).parquet(*self.paths) if self.paths else None
