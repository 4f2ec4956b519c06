"""Game archives: one row per game, parsed into games, moves, positions and errors."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plyforge.functions import pgn
from plyforge.functions.columns import header_int
from plyforge.functions.identity import game_id, player_hash, position_id

MARK = "[Event "
PARSED = (
    "archive string, local_index long, run_index long, result string, headers map<string,string>, error struct<code:string,message:string>, "
    "moves array<struct<ply:int,san:string,uci:string,fen_before:string,position:string,clock:string,side:string>>"
)


def raw_games(spark: SparkSession, paths: str | list[str], max_games: int | None = None, max_bytes: int = 8 << 20) -> DataFrame:
    """(archive, local_index, run_index, text) of every game: its ordinal in its file, and in all files in the order of
    their names. ``.zst`` is decoded by the reader; one compressed file is one task, so large archives are sharded
    before. A game starts at a line that begins with ``[Event ``; what stands before the first is dropped.

    A file may be read as many blocks: each block's games are counted, and the sums of the blocks before it
    (a table with a row per block) are added to a game's place in its block. ``max_games`` counts all files together."""
    if max_games is not None and max_games < 0:
        raise ValueError("max_games must not be negative")
    rows = spark.read.option("lineSep", "\n" + MARK).text(paths)
    rows = rows.select(F.col("_metadata.file_path").alias("archive"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("_at"))
    blocks = rows.groupBy("archive", "block").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"), F.min_by("value", "_at").alias("_head"))
    # The reader strips the mark from all but a file's first row, which may also be a preamble.
    skipped = (F.col("block") == 0) & ~F.regexp_replace("_head", "^\\ufeff", "").startswith(MARK)
    blocks = blocks.select("archive", "block", "_first", skipped.cast("int").alias("_skip"), (F.col("_rows") - skipped.cast("int")).alias("_games"))
    before = lambda w: F.coalesce(F.sum("_games").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumns({"_local": before(Window.partitionBy("archive").orderBy("block")), "_run": before(Window.orderBy("archive", "block"))})
    rows = rows.join(blocks.drop("_games"), ["archive", "block"])
    place = F.col("_at") - F.col("_first")
    head = (F.col("block") == 0) & (place == 0)
    text = F.when(head, F.regexp_replace("value", "^\\ufeff", "")).otherwise(F.concat(F.lit(MARK), "value"))
    rows = rows.filter(~head | (F.col("_skip") == 0))
    text = F.when(F.octet_length(text) > max_bytes, F.raise_error(F.lit("game is longer than the limit"))).otherwise(text)
    rows = rows.select("archive", (F.col("_local") + place - F.col("_skip")).alias("local_index"), (F.col("_run") + place - F.col("_skip")).alias("run_index"), text.alias("text"))
    return rows if max_games is None else rows.filter(F.col("run_index") < max_games)


def parsed(raw: DataFrame) -> DataFrame:
    """One row per game: its headers and moves, or its error."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for archive, index, at, text in zip(batch["archive"], batch["local_index"], batch["run_index"], batch["text"], strict=True):
                row = {"archive": archive, "local_index": index, "run_index": at, "result": None, "headers": None, "error": None, "moves": None}
                try:
                    game = pgn.parse_game(text)
                    row |= {"result": game["result"], "headers": game["headers"], "moves": game["moves"]}
                    if not pgn.is_complete(game):
                        row["error"] = {"code": "incomplete_game", "message": game["result"]}
                except pgn.Rejected as e:
                    row["error"] = {"code": e.code, "message": str(e)}
                out.append(row)
            yield pd.DataFrame(out, columns=["archive", "local_index", "run_index", "result", "headers", "error", "moves"])

    # A compressed archive is read by one task; its games are parsed by all.
    return raw.repartition(raw.sparkSession.sparkContext.defaultParallelism, "archive", "local_index").mapInPandas(parse, PARSED)


def records(parsed_games: DataFrame, archive_sha: str, month: str, offset: int = 0, key: bytes | None = None) -> dict[str, DataFrame]:
    """games, moves, positions and ingestion_errors of one archive, whose shards' names follow its order.
    ``offset``: games of the archive before the first of them."""
    at = F.col("run_index") + offset
    index, ident = at.alias("source_game_index"), game_id(F.lit(archive_sha), at).alias("game_id")
    good, h = parsed_games.filter("error IS NULL"), lambda k: F.col("headers")[k]
    games = good.select(
        ident, index, F.lit(month).alias("source_month"), "result", F.coalesce(h("UTCDate"), h("Date")).alias("played_date"), player_hash(h("White"), key).alias("white_player_hash"), player_hash(h("Black"), key).alias("black_player_hash"),
        header_int(h("WhiteElo")).alias("white_rating"), header_int(h("BlackElo")).alias("black_rating"), h("TimeControl").alias("time_control_raw"), h("ECO").alias("eco"), h("Opening").alias("opening"), h("Termination").alias("termination"), F.size("moves").alias("ply_count"),
    )
    moves = good.select(ident, F.explode("moves").alias("m"))
    moves = moves.select("game_id", F.lit(month).alias("source_month"), "m.ply", "m.san", F.col("m.uci").alias("played_move_uci"), F.col("m.fen_before").alias("pre_move_fen"), F.col("m.position").alias("normalized_pre_move_fen"), position_id(F.col("m.position")).alias("position_id"), F.col("m.side").alias("side_to_move"), F.col("m.clock").alias("clock"))
    positions = moves.groupBy("position_id").agg(F.min("normalized_pre_move_fen").alias("normalized_fen"), F.count("*").alias("occurrences"))
    errors = parsed_games.filter("error IS NOT NULL").select(ident, index, F.lit(month).alias("source_month"), F.col("error.code").alias("error_code"), F.col("error.message").alias("message"))
    return {"games": games, "moves": moves, "positions": positions, "ingestion_errors": errors}
