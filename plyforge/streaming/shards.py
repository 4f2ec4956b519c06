"""Resumable processing of shards: a file source that is run until nothing is left, exactly once.

Each call takes up the shards that came since the last one; the checkpoint remembers what is done. A
batch's results and its manifest row carry the batch's number, and a batch that is repeated after a
failure replaces its own output, so a resumed run ends like one that never failed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plyforge.functions.columns import canonical_date


def date_sidecar(rows: DataFrame) -> DataFrame:
    """game_id, source file, canonical date, its source and validity flags of each game header."""
    date = canonical_date(F.col("utc_date"), F.col("date"))
    return rows.withColumn("c", date).select(
        "game_id", "shard", F.col("c.day").cast("string").alias("played_date"), F.col("c.source").alias("date_source"),
        (F.coalesce(F.col("c.source") == "utc_date", F.lit(False))).alias("utc_date_valid"),
    )


def counters(sidecar: DataFrame) -> DataFrame:
    """Games by date source, per shard."""
    return sidecar.groupBy("shard").agg(F.count("*").alias("games"), *[F.count_if(F.col("date_source") == s).alias(s) for s in ("utc_date", "date", "missing_or_invalid")])


def process_new(spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = date_sidecar, most_shards: int | None = None) -> int:
    """Processes the shards under ``source`` that aren't done yet; returns the batches that ran.

    ``most_shards``: shards in a batch at most. Every batch writes ``out/data/batch=N`` and
    ``out/manifest/batch=N``.
    """
    stream = spark.readStream.schema(schema)
    if most_shards:
        stream = stream.option("maxFilesPerTrigger", most_shards)
    rows = stream.parquet(source).withColumn("shard", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    ran = []

    def commit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={number}")
        counters(spark.read.parquet(f"{out}/data/batch={number}")).write.mode("overwrite").parquet(f"{out}/manifest/batch={number}")
        ran.append(number)

    query = transform(rows).writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(ran)


def committed_prefix(done: set[int]) -> int:
    """How many results from 0 on are complete: out-of-order results wait for those before them."""
    n = 0
    while n in done:
        n += 1
    return n
