"""Data tests: each returns the rows that break a rule; an empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def dependency_violations(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that go with several values."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("n_values")).filter("n_values > 1")


def gaps(df: DataFrame, key: str, step: str) -> DataFrame:
    """Groups whose steps aren't 0, 1, ... without repetition; one aggregate."""
    out = df.groupBy(key).agg(F.min(step).cast("long").alias("min_step"), F.max(step).cast("long").alias("max_step"), F.count("*").alias("n_rows"), F.countDistinct(step).alias("n_steps"))
    return out.filter("min_step <> 0 OR max_step <> n_rows - 1 OR n_steps <> n_rows")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key).distinct(), key, "left_anti")


def count_mismatch_inner(parent: DataFrame, child: DataFrame, key: str, expected: Column) -> DataFrame:
    """Parents whose children differ in number from ``expected``; parents without children are not seen."""
    n = child.groupBy(key).agg(F.count("*").alias("n_children"))
    return parent.join(n, key).withColumn("expected", expected.cast("long")).filter("n_children <> expected").select(key, "expected", "n_children")


def count_mismatch_left(parent: DataFrame, child: DataFrame, key: str, expected: Column) -> DataFrame:
    """As ``count_mismatch_inner``, with parents without children counted as having none."""
    n = child.groupBy(key).agg(F.count("*").alias("n_children"))
    out = parent.join(n, key, "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)).cast("long"), "expected": expected.cast("long")})
    return out.filter("n_children <> expected").select(key, "expected", "n_children")


def unaccepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(values))


def nulls(df: DataFrame, *columns: str) -> DataFrame:
    """One row with the number of nulls in each column, in one pass."""
    return df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("int")), F.lit(0)).cast("long").alias(f"null_{c}") for c in columns])


def range_gaps(df: DataFrame, index: str, start: str, end: str) -> DataFrame:
    """Half-open ranges that don't continue the one before; for manifests, whose rows are few."""
    from pyspark.sql import Window

    w = Window.orderBy(index)
    out = df.withColumns({"place": F.row_number().over(w) - 1, "before": F.lag(end, 1, 0).over(w)})
    return out.filter((F.col("place") != F.col(index)) | (F.col("before") != F.col(start)) | (F.col(end) < F.col(start))).select(index, start, end, "before")


def forbidden_columns(df: DataFrame, names: set[str]) -> set[str]:
    """Columns that must not be features, by lower-cased name; no job runs."""
    return {c for c in df.columns if c.lower() in names}


def path_partition_mismatch(df: DataFrame, column: str, expected: str | None = None) -> DataFrame:
    """Rows whose ``column`` differs from the partition value in their file's path."""
    out = df.withColumn("path_value", F.regexp_extract(F.col("_metadata.file_path"), rf"{expected or column}=([^/\\]+)", 1))
    return out.filter(F.col("path_value") != F.col(column))
