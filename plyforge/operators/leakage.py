"""Holdouts, train/test leakage and the backed-off frequency policy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plyforge.functions.identity import sampled, u64

SPLITS = ("train", "validation", "test")


def hash_ordered(df: DataFrame, group: str, item: str, seed: str, most: int) -> DataFrame:
    """The first ``most`` items of each group in the order of their hashes."""
    payload = F.concat_ws("|", F.lit(seed), F.col(group).cast("string"), F.col(item).cast("string"))
    w = Window.partitionBy(group).orderBy(u64(payload), item)
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)


def with_holdout(games: DataFrame, white: str, black: str, seed: str, threshold: int, modulus: int, include_unknown: bool = True) -> DataFrame:
    """Adds the players' holdout flags, their disjunction and eligibility for training."""
    held = lambda c: F.coalesce(sampled("player_holdout", seed, F.col(c), threshold, modulus), F.lit(False))
    out = games.withColumns({"white_is_holdout": held(white), "black_is_holdout": held(black)})
    out = out.withColumn("is_holdout_game", F.col("white_is_holdout") | F.col("black_is_holdout"))
    known = F.lit(True) if include_unknown else F.col(white).isNotNull() & F.col(black).isNotNull()
    return out.withColumn("eligible", F.coalesce(F.col("temporal_split") == "train", F.lit(False)) & ~F.col("is_holdout_game") & known)


def holdout_leaks(games: DataFrame) -> DataFrame:
    """Games that are eligible though one of their players is held out."""
    return games.filter("eligible AND is_holdout_game")


def training_population(examples: DataFrame, mode: str) -> DataFrame:
    """``temporal_all``: every training example; ``player_disjoint``: eligible ones, and never a held-out game."""
    train = examples.filter("temporal_split = 'train'")
    if mode == "temporal_all":
        return train
    if mode != "player_disjoint":
        raise ValueError(f"unknown training population {mode}")
    return train.filter("eligible AND NOT is_holdout_game")


def _train_keys(examples: DataFrame, key: str) -> DataFrame:
    return examples.filter("temporal_split = 'train'").select(key).distinct()


def seen(examples: DataFrame, key: str = "position_id") -> DataFrame:
    """Test examples whose position occurs in train."""
    return examples.filter("temporal_split = 'test'").join(_train_keys(examples, key), key, "left_semi")


def novel(examples: DataFrame, key: str = "position_id") -> DataFrame:
    """Test examples whose position doesn't occur in train (keys are never null)."""
    return examples.filter("temporal_split = 'test'").join(_train_keys(examples, key), key, "left_anti")


def flagged(examples: DataFrame, key: str = "position_id") -> DataFrame:
    """Adds in_train (0 or 1). One aggregate by position and one join, whatever the number of splits."""
    return examples.join(_train_keys(examples, key).withColumn("hit", F.lit(1)), key, "left").withColumn("in_train", F.coalesce("hit", F.lit(0)).cast("long")).drop("hit")


def split_counts(examples: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    """Rows and distinct positions of every split, empty ones too."""
    frame = examples.sparkSession.createDataFrame([(s,) for s in splits], "temporal_split string")
    found = examples.groupBy("temporal_split").agg(F.count("*").alias("n_rows"), F.countDistinct("position_id").alias("n_positions"))
    return frame.join(found, "temporal_split", "left").na.fill(0, ["n_rows", "n_positions"])


def overlap(examples: DataFrame) -> DataFrame:
    """Rows of validation and test, those seen in train, and their share in per cent."""
    frame = examples.sparkSession.createDataFrame([("validation",), ("test",)], "temporal_split string")
    found = flagged(examples.select("position_id", "temporal_split")).groupBy("temporal_split").agg(F.count("*").alias("n_rows"), F.sum("in_train").alias("n_seen"))
    out = frame.join(found, "temporal_split", "left").na.fill(0, ["n_rows", "n_seen"])
    return out.withColumn("seen_percent", F.when(F.col("n_rows") > 0, F.round(F.col("n_seen") * 100.0 / F.col("n_rows"), 6)).otherwise(F.lit(0.0)))


def overlap_by_band(examples: DataFrame, bands: Sequence[tuple[int, str]], last: str) -> DataFrame:
    """As ``overlap``, by bands of the ply; bands without rows are left out."""
    band = None
    for below, name in bands:
        band = F.when(F.col("ply") < below, name) if band is None else band.when(F.col("ply") < below, name)
    rows = flagged(examples.select("position_id", "temporal_split", "ply")).filter("temporal_split <> 'train'")
    return rows.groupBy("temporal_split", (band.otherwise(last) if band is not None else F.lit(last)).alias("band")).agg(F.count("*").alias("n_rows"), F.sum("in_train").alias("n_seen"))


def ordered_splits(bounds: dict[str, tuple[str, str]]) -> None:
    """Raises unless train ends before validation starts and validation before test."""
    for a, b in (("train", "validation"), ("validation", "test")):
        if a in bounds and b in bounds and not bounds[a][1] < bounds[b][0]:
            raise ValueError(f"{a} doesn't end before {b} starts")


def frequency_levels(train: DataFrame) -> DataFrame:
    """Counts at (band, phase, action), (phase, action) and (action), in one aggregate."""
    train.createOrReplaceTempView("_frequency_train")
    return train.sparkSession.sql("SELECT band, phase, action, COUNT(*) AS n FROM _frequency_train GROUP BY GROUPING SETS ((band, phase, action), (phase, action), (action))")


def frequency_scores(rows: DataFrame, train: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Adds score: the first level with a count gives priority * 1e6 + count, none gives 0."""
    score = None
    for i, keys in enumerate(levels):
        rows = rows.join(train.groupBy(*keys).agg(F.count("*").alias(f"_n{i}")), list(keys), "left")
        value = F.lit((len(levels) - i) * 1_000_000) + F.col(f"_n{i}")
        score = F.when(F.col(f"_n{i}") > 0, value) if score is None else score.when(F.col(f"_n{i}") > 0, value)
    return rows.withColumn("score", score.otherwise(F.lit(0)).cast("long")).drop(*[f"_n{i}" for i in range(len(levels))])
