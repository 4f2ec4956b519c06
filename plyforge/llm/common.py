"""Helpers that the training-data operators share."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where none is set and Spark runs locally."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="plyforge-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    This cuts lineage: a lost executor costs no more than the tasks that read the table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int, each: int = 10_000) -> DataFrame:
    """``df`` in so many parts at most that one has ``each`` of ``rows``, but two for each core: whatever the number
    of shuffle partitions. Every part is a file, and for a file (and its checksum) on a local disk Hadoop starts a process,
    which counts the executor's whole memory once more until it runs its own program."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / each)))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space, in order; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def remainder(doc_id: Column, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bounds what a Python worker holds at once where texts can be very long; the models' tables
    come to the driver as Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def spread(docs: DataFrame, small: int = 64 << 20) -> DataFrame:
    """``docs`` over all cores where Spark estimates fewer than ``small`` bytes: such a table may be
    one file with one row group, which one task would read. Larger tables stay as they are read."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return docs.repartition(docs.sparkSession.sparkContext.defaultParallelism) if size < small else docs
