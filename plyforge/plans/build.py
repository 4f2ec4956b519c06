"""The two batch builds: archive to bronze, and bronze to an audited modeling dataset."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from dataclasses import asdict, dataclass, field
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge import schemas
from plyforge.functions.columns import by_side, played_date, rating_band, temporal_split, time_control, value_label
from plyforge.functions.identity import sampled
from plyforge.operators import checks, leakage
from plyforge.sources import pgn
from plyforge.sources.sinks import publish
from plyforge.streaming.lock import WriterLock

# Columns that tell the outcome or identity and are never features.
FORBIDDEN = {"result", "final_result_label", "termination", "termination_label", "white_player_hash", "black_player_hash"}


def bronze_problems(tables: dict[str, DataFrame]) -> list[str]:
    """What keeps bronze tables from being published; each check is one aggregate or anti join."""
    games, moves = tables["games"], tables["moves"]
    found = [f"{n}: {p}" for n, df in tables.items() for p in schemas.differences(df, schemas.of(n))]
    if found:
        return found
    found += [f"nulls in {n}: {v}" for n, df in tables.items() if (v := schemas.null_violations(df, schemas.of(n)))]
    for text, bad in (
        ("duplicate games", checks.duplicate_keys(games, "game_id")),
        ("duplicate moves", checks.duplicate_keys(moves, "game_id", "ply")),
        ("moves without game", checks.orphans(moves, games, "game_id")),
        ("gaps in plies", checks.gaps(moves, "game_id", "ply")),
        ("other ply counts", checks.count_mismatch_left(games, moves, "game_id", F.col("ply_count"))),
    ):
        if n := bad.count():
            found.append(f"{text}: {n}")
    return found


#: Bronze tables by month, and their order within.
BY_MONTH = {"games": ["game_id"], "moves": ["game_id", "ply"], "ingestion_errors": ["game_id"]}


def ingest(
    spark: SparkSession, paths: Sequence[str], root: str, archive_sha: str, month: str, key: bytes | None = None, max_games: int | None = None, strict: bool = False, offset: int = 0, lock: str | None = None
) -> dict[str, Any]:
    """Parses an archive's shards, validates and publishes games, moves, positions and errors, the large ones by month.

    Shards' names follow the archive's order; ``offset`` games of it stand before the first. ``lock``: a file on the driver's
    machine that keeps other writers out."""
    rows = pgn.parsed(pgn.raw_games(spark, list(paths), max_games))
    rows = rows.persist()  # four tables come from one parse
    try:
        if strict and (n := rows.filter("error IS NOT NULL").count()):
            raise ValueError(f"{n} games were rejected")
        identity = {"archive": archive_sha, "month": month, "schema": schemas.SCHEMA_VERSION, "max_games": max_games, "keyed": key is not None, "offset": offset, "shards": sorted(p.rpartition("/")[2] for p in paths)}
        tables = {n: df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.of(n)]) for n, df in pgn.records(rows, archive_sha, month, offset, key).items()}
        with WriterLock(lock) if lock else nullcontext():
            return publish(spark, root, identity, tables, bronze_problems, partitions={n: ("source_month", month, order) for n, order in BY_MONTH.items()})
    finally:
        rows.unpersist()


@dataclass(frozen=True)
class DatasetConfig:
    seed: str
    threshold: int
    modulus: int
    holdout_threshold: int
    holdout_modulus: int
    ranges: tuple[tuple[str, date, date], ...]
    missing_dates: str | None = None
    versions: dict[str, str] = field(default_factory=dict)


def assign_games(games: DataFrame, config: DatasetConfig) -> DataFrame:
    """Sample, date, split, holdout, eligibility: one chain of column expressions."""
    chosen = games.filter(sampled("game_sampling", config.seed, F.col("game_id"), config.threshold, config.modulus))
    split = temporal_split(played_date(F.col("played_date")), config.ranges, config.missing_dates)
    rows = chosen.withColumn("_s", split).withColumns({"temporal_split": F.col("_s.split"), "split_reason": F.col("_s.reason")}).drop("_s")
    return leakage.with_holdout(rows, "white_player_hash", "black_player_hash", config.seed, config.holdout_threshold, config.holdout_modulus)


def policy_examples(moves: DataFrame, assignments: DataFrame) -> DataFrame:
    """Examples with labels; rows whose target can't be encoded keep a reject_reason. Games are
    assigned before the join, so moves of other games are never carried."""
    from plyforge.functions.chess_udf import policy_target

    games = assignments.filter("temporal_split IS NOT NULL").select("game_id", "temporal_split", "eligible", "is_holdout_game", "result", "white_rating", "black_rating", "time_control_raw")
    rows = moves.select("game_id", "ply", "position_id", "normalized_pre_move_fen", "pre_move_fen", "side_to_move", "played_move_uci").join(games, "game_id")
    side = F.col("side_to_move")
    mover, other = by_side(side, F.col("white_rating"), F.col("black_rating")), by_side(side, F.col("black_rating"), F.col("white_rating"))
    rows = rows.withColumns({"mover_rating": mover, "opponent_rating": other, "value_label": value_label(side, F.col("result")), "time_control_category": time_control(F.col("time_control_raw"))})
    rows = rows.withColumns({"rating_difference": F.col("mover_rating") - F.col("opponent_rating"), "rating_band": rating_band(F.col("mover_rating")), "_t": policy_target("pre_move_fen", "played_move_uci")})
    reason = F.when(F.col("_t.value").isNull(), F.coalesce("_t.error", F.lit("no_target"))).when(F.col("value_label").isNull(), "no_value_label")
    return rows.withColumns({"policy_target": F.col("_t.value"), "reject_reason": reason}).drop("_t", "result", "time_control_raw", "white_rating", "black_rating", "pre_move_fen")


def dataset_problems(tables: dict[str, DataFrame]) -> list[str]:
    games, examples = tables["game_assignments"], tables["policy_examples"]
    found = [f"forbidden columns {sorted(v)}" for v in [checks.forbidden_columns(examples, FORBIDDEN)] if v]
    real = examples.filter("temporal_split <> 'novel_position_test'")
    for text, bad in (
        ("duplicate games", checks.duplicate_keys(games, "game_id")),
        ("games in several splits", checks.dependency_violations(real, "game_id", "temporal_split")),
        ("held-out players in training", leakage.holdout_leaks(games)),
        ("actions out of range", examples.filter("policy_target NOT BETWEEN 0 AND 4671")),
    ):
        if n := bad.count():
            found.append(f"{text}: {n}")
    days = games.filter("temporal_split IS NOT NULL AND played_date IS NOT NULL").groupBy("temporal_split").agg(F.min("played_date").alias("a"), F.max("played_date").alias("b"))
    try:
        leakage.ordered_splits({r["temporal_split"]: (r["a"], r["b"]) for r in days.collect()})
    except ValueError as e:
        found.append(str(e))
    return found


def build_dataset(spark: SparkSession, games: DataFrame, moves: DataFrame, root: str, upstream: str, config: DatasetConfig) -> dict[str, Any]:
    """Publishes game_assignments and policy_examples (with the novel slice) and returns the manifest
    with the leakage audit and the rejects."""
    assignments = assign_games(games, config)
    examples = policy_examples(moves, assignments)
    accepted = examples.filter("reject_reason IS NULL").drop("reject_reason")
    whole = accepted.unionByName(leakage.novel(accepted).withColumn("temporal_split", F.lit("novel_position_test")))
    identity = {"upstream": upstream, "config": {k: str(v) for k, v in asdict(config).items()}}
    manifest = publish(spark, root, identity, {"game_assignments": assignments, "policy_examples": whole}, dataset_problems, keep_failed=False)
    written = spark.read.parquet(f"{root}/{manifest['dataset_id']}/policy_examples").filter("temporal_split <> 'novel_position_test'")
    audit = {name: [r.asDict() for r in df.collect()] for name, df in (("splits", leakage.split_counts(written)), ("overlap", leakage.overlap(written)), ("bands", leakage.overlap_by_band(written, ((10, "opening"), (40, "middle")), "late")))}
    rejects = {r["reject_reason"]: r["n"] for r in examples.filter("reject_reason IS NOT NULL").groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
    return manifest | {"audit": audit, "rejects": rejects}


def value_baseline(examples: DataFrame, c: float = 1.0):
    """Multinomial logistic regression of the value label on bands, phase and ratings; returns the fitted
    ``pyspark.ml`` pipeline. Categories that training doesn't have are kept as unknown."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    kinds = ["rating_band", "time_control_category", "side_to_move"]
    n = max(1, examples.count())
    stages = [StringIndexer(inputCols=kinds, outputCols=[f"{k}_i" for k in kinds], stringOrderType="alphabetAsc", handleInvalid="keep"), OneHotEncoder(inputCols=[f"{k}_i" for k in kinds], outputCols=[f"{k}_v" for k in kinds]), VectorAssembler(inputCols=[*(f"{k}_v" for k in kinds), "rating_difference", "ply"], outputCol="features", handleInvalid="keep"), StringIndexer(inputCol="value_label", outputCol="label", stringOrderType="alphabetAsc"), LogisticRegression(family="multinomial", regParam=1 / (c * n), standardization=False)]
    return Pipeline(stages=stages).fit(examples.na.fill({"rating_difference": 0}))
