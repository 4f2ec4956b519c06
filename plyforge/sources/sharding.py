"""Archives cut into independently readable shards at game boundaries, without changing a byte."""

from __future__ import annotations

from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.operators.checks import range_gaps
from plyforge.sources.pgn import raw_games

BOUNDARY = b"\n[Event "
BOM = b"\xef\xbb\xbf"


def iter_game_bytes(stream: BinaryIO, chunk: int = 1 << 20, max_game_bytes: int = 8 << 20) -> Iterator[bytes]:
    """The games of a stream as they stand; only a byte-order mark and what precedes the first game go.

    A game starts where a line begins with ``[Event ``. Raises for a game longer than the limit.
    """
    held, start, first = b"\n", None, True
    while True:
        block = stream.read(chunk)
        ended = not block
        if first and block:
            while len(block) < len(BOM) and (more := stream.read(chunk)):
                block += more
            block, first = block.removeprefix(BOM), False
        held += block
        while True:
            at = held.find(BOUNDARY, 1 if start is not None else 0)
            if at < 0:
                break
            if start is not None:
                yield held[start : at + 1]
            held, start = held[at:], 1
        if start is None:
            held = held[-len(BOUNDARY) :]
        elif len(held) > max_game_bytes + 1:
            raise ValueError("game is longer than the limit")
        if ended:
            break
    if start is not None and len(held) > 1:
        yield held[start:]


def iter_zst_games(path: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    import zstandard

    with open(path, "rb") as f, zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True) as stream:
        yield from iter_game_bytes(stream, chunk)


def count_zst_games(path: str) -> int:
    return sum(1 for _ in iter_zst_games(path))


def shard_ranges(spark: SparkSession, games: int, per_shard: int) -> DataFrame:
    """(idx, range_start, range_end): half-open ranges of games that cover the archive."""
    n = -(-games // per_shard)
    return spark.range(n).select(F.col("id").alias("idx"), (F.col("id") * per_shard).alias("range_start"), F.least((F.col("id") + 1) * per_shard, F.lit(games)).alias("range_end"))


def write_shards(spark: SparkSession, archive: str, out: str, per_shard: int) -> DataFrame:
    """Writes ``out/shard=N`` of ``per_shard`` games each and returns the manifest, recounted from what
    was written: idx, range_start, range_end, games. Raises if a range is missing or miscounted."""
    rows = raw_games(spark, archive).select((F.col("local_index") / per_shard).cast("long").alias("shard"), "local_index", "text")
    total = rows.count()
    rows.repartition("shard").sortWithinPartitions("shard", "local_index").select("shard", "text").write.partitionBy("shard").option("lineSep", "\n").text(out)
    counts = spark.read.option("lineSep", "\n").text(out).groupBy("shard").agg(F.count_if(F.col("value").startswith("[Event ")).alias("games"))
    manifest = shard_ranges(spark, total, per_shard).join(counts.withColumnRenamed("shard", "idx"), "idx", "left")
    wrong = manifest.filter("games IS NULL OR games <> range_end - range_start").count()
    if wrong or range_gaps(manifest.select("idx", "range_start", "range_end"), "idx", "range_start", "range_end").count():
        raise ValueError(f"{wrong} shards are incomplete or out of order")
    return manifest


def fixture(raw: DataFrame, games: int) -> DataFrame:
    """The first complete games of an archive with names and sites blanked."""
    done = raw.filter(F.col("text").rlike(r'\[Result "(1-0|0-1|1/2-1/2)"\]') & F.col("text").rlike(r"(?m)^1\."))
    blank = F.regexp_replace("text", r'(?m)^\[(White|Black|Site) "[^"]*"\]', '[$1 "?"]')
    return done.orderBy("archive", "local_index").limit(games).withColumn("text", blank)
