"""Deterministic selections and their fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plyforge.functions.identity import identity_of, u64


def hash_selected(df: DataFrame, keys: Sequence[str], seed: str, limit: int | None, namespace: str = "") -> DataFrame:
    """The first ``limit`` rows in the order of their keys' hashes, ties by the keys; all rows, unordered, without a
    positive limit."""
    if not limit or limit <= 0:
        return df
    payload = F.concat_ws("|", F.lit(namespace), F.lit(seed), *[F.col(k).cast("string") for k in keys])
    return df.withColumn("_u", u64(payload)).orderBy("_u", *keys).limit(limit).drop("_u")


def fingerprint(selected: Sequence[Sequence]) -> str:
    """SHA-256 of the keys in the order of selection; a selection is bounded by its limit."""
    return identity_of([list(k) for k in selected])


def compatible(a: dict, b: dict, keys: Sequence[str] = ("dataset_id", "seed", "fingerprint")) -> list[str]:
    """What keeps two experiments from being compared: the keys whose values differ or are missing."""
    return [k for k in keys if k not in a or k not in b or a[k] != b[k]]


def prediction_sample(predictions: DataFrame, group: str, score: str, index: str, most_rows: int) -> DataFrame:
    """Ranked predictions of each split up to ``most_rows`` rows, in the order of group and rank."""
    ranked = predictions.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), index)))
    return ranked.orderBy(group, "rank").limit(most_rows)


def candidate_rows(examples: int, negatives: int | None, most_legal: int = 218) -> dict[str, object]:
    """Expected candidate rows, and how they weigh on memory."""
    rows = examples * (1 + negatives) if negatives is not None else examples * most_legal
    risk = "low" if rows < 5_000_000 else "medium" if rows < 50_000_000 else "high"
    return {"rows": rows, "risk": risk}
