"""Exact top-k search by exhaustive term-at-a-time accumulation.

Candidates are dealt into groups of bounded size and queries into blocks; each (group, block)
pair meets in one task. There the group becomes an inverted file: for each dimension the
candidates with a non-zero weight. A query row scatters ``weight * posting`` into a dense score
array, dimension after dimension; a partition selection keeps the k best of the group with all
that tie with the last, and a window merges the groups' survivors.

Nulls: vectors that are null or hold null or non-finite components, and rows without an id, take
no part. Vectors of different lengths: missing components count as zero. Repeated ids: each row
is a candidate; a query excludes all rows of its own id, and of repeated query rows the smallest
vector is asked. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORES = "query_id long, vec_id long, score long"


def quantized(rows, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, padded with zeros to a matrix of whole numbers."""
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = np.floor(scale * np.asarray(r, dtype=np.float64))
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray, chunk: int = 256):
    """Yields (first query, scores of some queries against all candidates), term at a time."""
    terms = min(queries.shape[1], candidates.shape[1])
    postings = []
    for t in range(terms):
        at = np.flatnonzero(candidates[:, t])
        postings.append((slice(None) if len(at) == len(candidates) else at, candidates[at, t]))
    for lo in range(0, len(queries), chunk):
        part = queries[lo : lo + chunk]
        scores = np.zeros((len(part), len(candidates)), dtype=np.int64)
        for t in range(terms):
            asks = np.flatnonzero(part[:, t])
            at, weights = postings[t]
            if not len(asks) or not len(weights):
                continue
            add = part[asks, t][:, None] * weights[None, :]
            if isinstance(at, slice):
                scores[asks] += add
            else:
                scores[np.ix_(asks, at)] += add
        yield lo, scores


def best(scores: np.ndarray, ids: np.ndarray, own, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, without the query's own rows."""
    keep = np.flatnonzero(ids != own)
    if len(keep) > k:
        s = scores[keep]
        keep = keep[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def exact_topk(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 5, scale: int = 256, group_rows: int = 32_768, block_rows: int = 8_192) -> DataFrame:
    """The ``k`` highest integer inner products of every query row against all rows.

    ``is_query`` tells the query rows. Returns query_id, rank (from 1), vec_id, score.
    """
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
    n, asked = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("asks").cast("int")), F.lit(0))).first()
    groups = max(1, -(-n // min(group_rows, max(256, n // 64))))
    blocks = max(1, -(-asked // block_rows))

    def dealt(df: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        df = df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(count)).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def search(asks: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        ids, out = have["id"].to_numpy(), []
        if len(asks) and len(have):
            q_ids = asks["id"].to_numpy()
            for lo, scores in accumulate(quantized(asks["v"], scale), quantized(have["v"], scale)):
                for i, row in enumerate(scores):
                    at = best(row, ids, q_ids[lo + i], k)
                    out.append(pd.DataFrame({"query_id": q_ids[lo + i], "vec_id": ids[at], "score": row[at]}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})

    queries = dealt(rows.filter("asks").groupBy("id").agg(F.min("v").alias("v")), "b", blocks, "g", groups)
    have = dealt(rows.select("id", "v"), "g", groups, "b", blocks)
    found = queries.groupBy("g", "b").cogroup(have.groupBy("g", "b")).applyInPandas(search, SCORES)
    order = F.row_number().over(_by_query())
    return found.withColumn("rank", order).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _by_query():
    from pyspark.sql import Window

    return Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
