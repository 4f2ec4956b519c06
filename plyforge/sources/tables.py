"""Table access by directory, and scans over explicit file lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables under ``sf_dir``; columns are pruned by Catalyst."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_list(spark: SparkSession, files: Sequence[str], schema: StructType) -> DataFrame:
    """Scan of an explicit file list, never a glob; an empty list gives an empty table."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files)
