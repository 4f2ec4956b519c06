"""Ranking, calibration and classification metrics as grouped aggregates."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plyforge.functions.columns import argmax


def ranked(df: DataFrame, group: str, score: str, index: str) -> DataFrame:
    """Rank in a group by score, ties to the smaller index."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), index)))


def invalid_groups(df: DataFrame, group: str, label: str) -> DataFrame:
    """Groups without exactly one positive."""
    return df.groupBy(group).agg(F.sum(label).cast("long").alias("positives")).filter("positives <> 1")


def ranking_metrics(positives: DataFrame, candidates: str = "n_candidates", ks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """One row from the rank of each group's positive and its number of candidates."""
    n, r = F.col(candidates), F.col("rank")
    quantiles = [F.percentile(n, F.lit(q)).alias(f"candidates_p{round(q * 100)}") for q in (0.5, 0.9, 0.95)]
    recall = [F.avg((r <= k).cast("double")).alias(f"recall_at_{k}") for k in ks]
    gain = [F.avg(F.when(r <= k, 1 / F.log2(r + F.lit(1.0))).otherwise(0.0)).alias(f"ndcg_at_{k}") for k in ks]
    return positives.agg(F.count("*").alias("n_groups"), F.avg(n).alias("candidates_mean"), F.max(n).alias("candidates_max"), F.min(n).alias("candidates_min"), *quantiles, F.avg(1 / r).alias("mrr"), *recall, *gain)


def brier(df: DataFrame, truth: str, probabilities: str) -> DataFrame:
    """Mean over rows of the summed squared distance to the one-hot truth."""
    each = F.aggregate(F.transform(probabilities, lambda p, i: F.pow(p - (i == F.col(truth)).cast("double"), F.lit(2.0))), F.lit(0.0), lambda a, x: a + x)
    return df.agg(F.avg(each).alias("brier"))


def calibration_bins(df: DataFrame, confidence, correct, bins: int, *by: str) -> DataFrame:
    """count, mean confidence and accuracy of every equal-width bin; empty bins are zeros."""
    rows = df.select(*by, confidence.alias("conf"), correct.cast("double").alias("ok"))
    rows = rows.withColumn("bin", F.least(F.floor(F.col("conf") * bins), F.lit(bins - 1)).cast("int"))
    found = rows.groupBy(*by, "bin").agg(F.count("*").alias("n"), F.avg("conf").alias("confidence"), F.avg("ok").alias("accuracy"))
    frame = (rows.select(*by).distinct() if by else df.sparkSession.range(1)).select(*by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = frame.join(found, [*by, "bin"], "left")
    return out.select(*by, "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("confidence", "accuracy")])


def top_label_bins(df: DataFrame, truth: str, probabilities: str, bins: int = 15) -> DataFrame:
    return calibration_bins(df, F.array_max(probabilities), argmax(F.col(probabilities)) == F.col(truth), bins)


def class_bins(df: DataFrame, truth: str, probabilities: str, bins: int = 15) -> DataFrame:
    rows = df.select(truth, F.posexplode(probabilities).alias("class", "p"))
    return calibration_bins(rows, F.col("p"), F.col("class") == F.col(truth), bins, "class")


def expected_calibration_error(bins: DataFrame) -> DataFrame:
    """Sum of |accuracy - confidence| weighted by the bins' counts."""
    gap = F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("confidence")))
    return bins.agg(F.when(F.sum("n") > 0, gap / F.sum("n")).otherwise(F.lit(0.0)).alias("ece"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_scores(matrix: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each class in truth or prediction, from a confusion matrix; zero over nothing."""
    cells = matrix.select("n", F.col("truth").alias("t"), F.col("predicted").alias("p"))
    rows = cells.select(F.col("t").alias("class"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hit"), F.col("n").alias("real"), F.lit(0).cast("long").alias("said"))
    rows = rows.unionByName(cells.select(F.col("p").alias("class"), F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("real"), F.col("n").alias("said")))
    sums = rows.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("hit", "real", "said")])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    out = sums.withColumns({"precision": ratio(F.col("hit"), F.col("said")), "recall": ratio(F.col("hit"), F.col("real"))})
    both = F.col("precision") + F.col("recall")
    return out.select("class", F.col("real").alias("support"), "precision", "recall", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0)).alias("f1"))


def subgroups(df: DataFrame, dimensions: Sequence[str], **measures) -> DataFrame:
    """The measures for every value of every dimension, by one unpivot and one aggregate."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("unknown")).alias("value")) for d in dimensions])).alias("pair")
    return df.select("*", pairs).groupBy("pair.dimension", "pair.value").agg(*[m.alias(k) for k, m in measures.items()])


def standardizer(df: DataFrame, *columns: str) -> DataFrame:
    """A row per column: mean, population deviation (1 where it isn't positive), missing values."""
    stats = df.agg(F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.avg(c), F.lit(0.0)).alias("mean"), F.stddev_pop(c).alias("sd"), F.count_if(F.col(c).isNull()).alias("missing")) for c in columns]).alias("s"))
    return stats.select(F.inline("s")).withColumn("sd", F.when(F.col("sd") > 0, F.col("sd")).otherwise(F.lit(1.0)))


def categories(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values numbered from 1; 0 stands for unknown ones. For small vocabularies."""
    values = df.select(F.col(column).alias("value")).dropna().distinct()
    return values.withColumn("code", F.row_number().over(Window.orderBy("value")))


def array_parity(df: DataFrame, a: str, b: str, tolerance: float) -> DataFrame:
    """Largest and 99th percentile absolute difference, and how many are above ``tolerance``."""
    gaps = df.select(F.explode(F.zip_with(a, b, lambda x, y: F.abs(x - y))).alias("gap"))
    return gaps.agg(F.max("gap").alias("max_abs"), F.percentile("gap", F.lit(0.99)).alias("p99_abs"), F.count_if(F.col("gap") > tolerance).alias("over"))


def bootstrap(per_game: list[tuple[int, float]], iterations: int, seed: int) -> dict[str, float]:
    """Mean over rows with a 2.5/97.5 percentile interval, resampling games; per_game: (rows, sum)."""
    n, s = (np.array(x, dtype=float) for x in zip(*per_game, strict=True))
    point = float(s.sum() / n.sum())
    if iterations <= 0:
        return {"point": point, "low": point, "high": point}
    rng = np.random.default_rng(seed)
    draws = rng.integers(0, len(n), (iterations, len(n)))
    means = s[draws].sum(axis=1) / n[draws].sum(axis=1)
    return {"point": point, "low": float(np.percentile(means, 2.5)), "high": float(np.percentile(means, 97.5))}


def fitted_temperature(loss: Callable[[float], float], low: float = 0.05, high: float = 20.0, steps: int = 60) -> float:
    """The temperature in [low, high] with the smallest loss, by golden section on its logarithm; 1 if none is better."""
    a, b, g = math.log(low), math.log(high), (math.sqrt(5) - 1) / 2
    for _ in range(steps):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(math.exp(c)) < loss(math.exp(d)) else (c, b)
    best = math.exp((a + b) / 2)
    return best if loss(best) < loss(1.0) else 1.0
