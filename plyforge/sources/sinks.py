"""Writers and the publication protocol: stage, validate, describe, rename; never overwrite."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.functions.identity import identity_of


def write_partitioned(df: DataFrame, path: str, partition: str, order: list[str], row_group_bytes: int = 64 << 20, max_rows: int = 0) -> None:
    """One shuffle by partition and a hash of the order, sorted files, zstd. A month is dealt over
    several tasks, so a large one doesn't meet in a single file."""
    spread = F.pmod(F.xxhash64(*order), F.lit(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    writer = df.repartition(partition, spread).sortWithinPartitions(partition, *order).write
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    writer.option("compression", "zstd").option("parquet.block.size", row_group_bytes).partitionBy(partition).parquet(path)


def write_empty_part(spark: SparkSession, df: DataFrame, path: str, partition: str, value: str) -> None:
    """A dataset without rows still has a file with its schema under its partition."""
    spark.createDataFrame([], df.drop(partition).schema).coalesce(1).write.parquet(f"{path}/{partition}={value}")


def write_split(df: DataFrame, path: str, split: str = "temporal_split") -> dict[str, int]:
    """Partitioned by split; the rows of each, counted from what was written."""
    df.write.option("compression", "zstd").partitionBy(split).parquet(path)
    return {r[split]: r["n"] for r in df.sparkSession.read.parquet(path).groupBy(split).agg(F.count("*").alias("n")).collect()}


class Storage:
    """The file system that a path lives on, local or not, through Hadoop's interface."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = root
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def exists_below(self, name: str, start: str) -> bool:
        return any(f.getPath().getName().startswith(start) for f in self.fs.listStatus(self.path(name)))

    def rename(self, a: str, b: str) -> None:
        self.fs.mkdirs(self.path(b).getParent())
        if not self.fs.rename(self.path(a), self.path(b)):
            raise OSError(f"could not rename {a} to {b}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def write_text(self, name: str, text: str) -> None:
        """Whole or not at all: a temporary file that is renamed."""
        part = f"{name}.partial"
        out = self.fs.create(self.path(part), True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if self.exists(name):
            self.delete(name)
        self.rename(part, name)

    def read_text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()


def safe_name(name: str) -> str:
    """A relative path without steps upwards."""
    if not name or os.path.isabs(name) or ".." in name.split("/") or "\\" in name:
        raise ValueError(f"unsafe path {name!r}")
    return name


def contents(df: DataFrame) -> tuple[int, str]:
    """Rows and a digest of all values, in any order, in one pass."""
    columns = sorted(df.columns)
    row = df.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    return row[0], str(row[1] or 0)


def publish(
    spark: SparkSession, root: str, identity: dict[str, Any], tables: dict[str, DataFrame], validate: Callable[[dict[str, DataFrame]], list[str]], keep_failed: bool = True,
    partitions: dict[str, tuple[str, str, list[str]]] | None = None,
) -> dict[str, Any]:
    """Writes ``tables`` under the SHA-256 of ``identity`` and returns the manifest.

    ``partitions``: of some tables the partition column, its value where the table is empty, and the order within.
    The same identity again: the published manifest is checked and returned, nothing is written. A
    validation failure raises; the staged data stay with a failed manifest, or go.
    """
    store, name = Storage(spark, root), identity_of(identity)
    if store.exists(name):
        manifest = json.loads(store.read_text(f"{name}/manifest.json"))
        if manifest["identity"] != identity or not store.exists(f"{name}/_SUCCESS"):
            raise ValueError(f"{name} was published with another identity or not to its end")
        for table, count in manifest["counts"].items():
            read = spark.read.schema(tables[table].schema) if table in tables else spark.read
            if contents(read.parquet(f"{root}/{name}/{safe_name(table)}")) != (count, manifest["digests"][table]):
                raise ValueError(f"{table} of {name} has changed since it was published")
        return manifest
    staging = f"staging/{name}"
    store.delete(staging)
    for table, df in tables.items():
        path = f"{root}/{staging}/{safe_name(table)}"
        if table not in (partitions or {}):
            df.write.option("compression", "zstd").parquet(path)
            continue
        partition, value, order = partitions[table]
        write_partitioned(df, path, partition, order)
        if not store.exists_below(f"{staging}/{table}", f"{partition}="):
            write_empty_part(spark, df, path, partition, value)
    written = {t: spark.read.schema(df.schema).parquet(f"{root}/{staging}/{t}") for t, df in tables.items()}
    manifest = {"dataset_id": name, "identity": identity, "counts": {}, "digests": {}, "status": "complete"}
    for table, df in written.items():
        manifest["counts"][table], manifest["digests"][table] = contents(df)
    problems = validate(written)
    if problems:
        if keep_failed:
            store.write_text(f"{staging}/manifest.json", json.dumps(manifest | {"status": "failed", "problems": problems}, indent=1))
        else:
            store.delete(staging)
        raise ValueError("; ".join(problems))
    store.write_text(f"{staging}/manifest.json", json.dumps(manifest, indent=1, sort_keys=True))
    store.rename(staging, name)
    store.write_text(f"{name}/_SUCCESS", "")
    return manifest


def flattened(value: Any, prefix: str = "") -> dict[str, float]:
    """Nested metrics as dotted keys; finite numbers only, no booleans or lists."""
    out: dict[str, float] = {}
    for k, v in value.items():
        if isinstance(v, dict):
            out |= flattened(v, f"{prefix}{k}.")
        elif isinstance(v, int | float) and not isinstance(v, bool) and v == v and abs(v) != float("inf"):
            out[f"{prefix}{k}"] = v
    return out
