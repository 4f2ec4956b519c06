"""Joins and components that hold when one key has a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.llm.common import few, written

SALTS = 16


def left_join(rows: DataFrame, groups: DataFrame, key: list[str], weight: str, total: int, own: Column, hot: float = 0.001) -> DataFrame:
    """``rows`` left join ``groups``, which has one row for each key and its number of rows.

    Keys with more than ``hot`` of all rows, of which there are at most 1/hot, are broadcast; the
    others are shuffled. A row that is already resolved goes to the shuffle with a salt of its own,
    a hash of ``own`` that no group has, so that hot rows spread.
    """
    payload = [c for c in groups.columns if c not in key and c != weight]
    head = groups.filter(F.col(weight) > hot * total).select(*key, *[F.col(c).alias(f"_h_{c}") for c in payload], F.lit(1).alias("_hot"))
    tail = groups.filter(F.col(weight) <= hot * total).select(*[F.col(c).alias(f"_k_{c}") for c in key], *[F.col(c).alias(f"_t_{c}") for c in payload], F.lit(0).cast("long").alias("_s"))
    out = rows.join(F.broadcast(head), key, "left").withColumn("_s", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(F.xxhash64(own).bitwiseOR(F.lit(1))).cast("long"))
    out = out.join(tail, [out[c] == tail[f"_k_{c}"] for c in key] + [out["_s"] == tail["_s"]], "left")
    return out.select(*rows.columns, *[F.coalesce(f"_h_{c}", f"_t_{c}").alias(c) for c in payload])


def _salted_minimum(edges: DataFrame, rows: int) -> DataFrame:
    """edges (u, v), about ``rows``, with m, the smallest neighbour of u or u itself; hot nodes are dealt by salt."""
    least = written(few(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), rows), "least")
    least = least.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return dealt.join(least, ["u", "s"]).select("u", "v", "m")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) of the nodes in ``links`` (a, b), by
    alternating large-star and small-star steps; every round is a table in the shared folder."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(few(edges, links.count()), "edges")
    before, rows = None, edges.count()
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _salted_minimum(both, 2 * rows).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = written(few(large, 2 * rows), "large")
        # Small star: u's smaller neighbours and u itself hang from the smallest of them.
        small = _salted_minimum(large, 2 * rows)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = written(few(small, 2 * rows), "edges")
        after = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if after == before:
            break
        before, rows = after, after[0]
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
