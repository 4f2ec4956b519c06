"""Ranking, calibration and classification metrics over the embeddings and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from plyforge.functions.columns import argmax, rating_band, softmax
from plyforge.operators import metrics as M
from plyforge.plans.registry import query
from plyforge.plans.standins import GAMES_SQL, games
from plyforge.sources.tables import table

RANKED_SQL = """WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS score, generate_subscripts(embedding, 1) - 1 AS idx FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, idx) AS rank, COUNT(*) OVER (PARTITION BY vec_id) AS n FROM e)"""
WDL_SQL = """WITH e AS (SELECT vec_id, label, unnest(embedding[1:10]) AS x, generate_subscripts(embedding[1:10], 1) - 1 AS class FROM embeddings),
s AS (SELECT vec_id, label, class, exp(CAST(x AS DOUBLE)) AS w FROM e), t AS (SELECT vec_id, SUM(w) AS total FROM s GROUP BY vec_id),
p AS (SELECT s.vec_id, s.label, s.class, s.w / t.total AS p FROM s JOIN t ON s.vec_id = t.vec_id),
top AS (SELECT vec_id, label, class AS predicted, p AS conf FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) AS k FROM p) WHERE k = 1)"""


def _candidates(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("idx", "score"))
    return rows.withColumn("score", F.col("score").cast("double"))


def _probabilities(spark, d):
    logits = F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double"))
    return table(spark, d, "embeddings").select("vec_id", "label", softmax(logits).alias("p"))


@query(f"{RANKED_SQL} SELECT vec_id, CAST(rank AS INTEGER) AS rank FROM r WHERE idx = label")
def positive_ranks(spark, d):
    return M.ranked(_candidates(spark, d), "vec_id", "score", "idx").filter("idx = label").select("vec_id", "rank")


@query(
    f"{RANKED_SQL} SELECT COUNT(*) AS n_groups, round(AVG(n), 4) AS candidates_mean, MAX(n) AS candidates_max, MIN(n) AS candidates_min, round(quantile_cont(n, 0.5), 4) AS candidates_p50, round(quantile_cont(n, 0.9), 4) AS candidates_p90, round(quantile_cont(n, 0.95), 4) AS candidates_p95, round(AVG(1.0 / rank), 4) AS mrr, round(AVG(CASE WHEN rank <= 1 THEN 1.0 ELSE 0.0 END), 4) AS recall_at_1, round(AVG(CASE WHEN rank <= 5 THEN 1.0 ELSE 0.0 END), 4) AS recall_at_5, round(AVG(CASE WHEN rank <= 5 THEN 1.0 / log2(rank + 1.0) ELSE 0.0 END), 4) AS ndcg_at_5 FROM r WHERE idx = label"
)
def ranking_metrics(spark, d):
    ranks = M.ranked(_candidates(spark, d), "vec_id", "score", "idx").withColumn("n_candidates", F.count("*").over(M.Window.partitionBy("vec_id"))).filter("idx = label")
    out = M.ranking_metrics(ranks, ks=(1, 5)).drop("ndcg_at_1")
    return out.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


@query(f"{RANKED_SQL} SELECT vec_id, CAST(idx AS INTEGER) AS idx, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5")
def legal_top5(spark, d):
    return M.ranked(_candidates(spark, d), "vec_id", "score", "idx").filter("rank <= 5").select("vec_id", "idx", "rank")


@query("WITH e AS (SELECT vec_id, label % 2 AS y FROM embeddings) SELECT vec_id, CAST(SUM(y) AS BIGINT) AS positives FROM e GROUP BY vec_id HAVING SUM(y) <> 1")
def group_validation(spark, d):
    return M.invalid_groups(table(spark, d, "embeddings").select("vec_id", (F.col("label") % 2).alias("y")), "vec_id", "y")


@query(f"{WDL_SQL} SELECT round(AVG(b), 4) AS brier FROM (SELECT vec_id, SUM((p - CASE WHEN class = label THEN 1.0 ELSE 0.0 END) * (p - CASE WHEN class = label THEN 1.0 ELSE 0.0 END)) AS b FROM p GROUP BY vec_id)")
def brier(spark, d):
    return M.brier(_probabilities(spark, d), "label", "p").select(F.round("brier", 4).alias("brier"))


BINS = "(SELECT unnest(range(0, 15)) AS bin)"


@query(f"{WDL_SQL}, b AS (SELECT LEAST(CAST(floor(conf * 15) AS INTEGER), 14) AS bin, COUNT(*) AS n, AVG(conf) AS confidence, AVG(CASE WHEN predicted = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM top GROUP BY 1) SELECT CAST(k.bin AS INTEGER) AS bin, COALESCE(b.n, 0) AS n, round(COALESCE(b.confidence, 0), 4) AS confidence, round(COALESCE(b.accuracy, 0), 4) AS accuracy FROM {BINS} k LEFT JOIN b ON k.bin = b.bin")
def ece_bins(spark, d):
    out = M.top_label_bins(_probabilities(spark, d), "label", "p", 15)
    return out.select("bin", "n", F.round("confidence", 4).alias("confidence"), F.round("accuracy", 4).alias("accuracy"))


@query(f"{WDL_SQL}, b AS (SELECT LEAST(CAST(floor(conf * 15) AS INTEGER), 14) AS bin, COUNT(*) AS n, AVG(conf) AS c, AVG(CASE WHEN predicted = label THEN 1.0 ELSE 0.0 END) AS a FROM top GROUP BY 1) SELECT round(SUM(n * abs(a - c)) / SUM(n), 4) AS ece FROM b")
def ece(spark, d):
    return M.expected_calibration_error(M.top_label_bins(_probabilities(spark, d), "label", "p", 15)).select(F.round("ece", 4).alias("ece"))


@query(f"{WDL_SQL}, b AS (SELECT class, LEAST(CAST(floor(p * 15) AS INTEGER), 14) AS bin, COUNT(*) AS n, AVG(p) AS confidence, AVG(CASE WHEN class = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM p GROUP BY 1, 2), k AS (SELECT c.class, x.bin FROM (SELECT DISTINCT class FROM p) c CROSS JOIN {BINS} x) SELECT CAST(k.class AS INTEGER) AS class, CAST(k.bin AS INTEGER) AS bin, COALESCE(b.n, 0) AS n, round(COALESCE(b.confidence, 0), 4) AS confidence, round(COALESCE(b.accuracy, 0), 4) AS accuracy FROM k LEFT JOIN b ON k.class = b.class AND k.bin = b.bin")
def reliability(spark, d):
    out = M.class_bins(_probabilities(spark, d), "label", "p", 15)
    return out.select("class", "bin", "n", F.round("confidence", 4).alias("confidence"), F.round("accuracy", 4).alias("accuracy"))


def _predicted(spark, d):
    return _probabilities(spark, d).select("vec_id", F.col("label").alias("truth"), argmax(F.col("p")).alias("predicted"))


@query(f"{WDL_SQL} SELECT label AS truth, CAST(predicted AS INTEGER) AS predicted, COUNT(*) AS n FROM top GROUP BY 1, 2")
def confusion(spark, d):
    return M.confusion(_predicted(spark, d), "truth", "predicted")


@query(
    f"{WDL_SQL}, m AS (SELECT label AS t, predicted AS p, COUNT(*) AS n FROM top GROUP BY 1, 2), k AS (SELECT t AS class FROM m UNION SELECT p FROM m), a AS (SELECT k.class, COALESCE((SELECT SUM(n) FROM m WHERE m.t = k.class AND m.p = k.class), 0) AS hit, COALESCE((SELECT SUM(n) FROM m WHERE m.t = k.class), 0) AS re, COALESCE((SELECT SUM(n) FROM m WHERE m.p = k.class), 0) AS said FROM k), b AS (SELECT class, re, CASE WHEN said > 0 THEN hit * 1.0 / said ELSE 0.0 END AS precision_, CASE WHEN re > 0 THEN hit * 1.0 / re ELSE 0.0 END AS recall_ FROM a) SELECT CAST(class AS INTEGER) AS class, CAST(re AS BIGINT) AS support, round(precision_, 4) AS precision_, round(recall_, 4) AS recall_, round(CASE WHEN precision_ + recall_ > 0 THEN 2 * precision_ * recall_ / (precision_ + recall_) ELSE 0.0 END, 4) AS f1 FROM b"
)
def class_prf(spark, d):
    out = M.class_scores(M.confusion(_predicted(spark, d), "truth", "predicted"))
    return out.select(F.col("class").cast("int").alias("class"), "support", F.round("precision", 4).alias("precision_"), F.round("recall", 4).alias("recall_"), F.round("f1", 4).alias("f1"))


@query(f"{WDL_SQL} SELECT round(AVG(CASE WHEN predicted = label THEN 1.0 ELSE 0.0 END), 4) AS accuracy, round((SELECT AVG(-ln(p)) FROM p WHERE class = label), 4) AS log_loss FROM top")
def accuracy_log_loss(spark, d):
    rows = _probabilities(spark, d)
    return rows.agg(F.round(F.avg((argmax(F.col("p")) == F.col("label")).cast("double")), 4).alias("accuracy"), F.round(F.avg(-F.ln(F.get("p", F.col("label")))), 4).alias("log_loss"))


@query(f"WITH {GAMES_SQL}, b AS (SELECT *, CASE WHEN black_rating < 1200 THEN 'lt_1200' WHEN black_rating < 1600 THEN '1200_1599' WHEN black_rating < 2000 THEN '1600_1999' ELSE 'gte_2000' END AS band FROM games), u AS (SELECT 'result' AS dimension, result AS value, white_rating FROM b UNION ALL SELECT 'band', band, white_rating FROM b UNION ALL SELECT 'opening', opening, white_rating FROM b) SELECT dimension, value, COUNT(*) AS n, round(AVG(white_rating), 4) AS mean_rating FROM u GROUP BY dimension, value")
def subgroups(spark, d):
    rows = games(spark, d).withColumn("band", rating_band(F.col("black_rating")))
    return M.subgroups(rows, ["result", "band", "opening"], n=F.count("*"), mean_rating=F.round(F.avg("white_rating"), 4))


@query("SELECT 'o_totalprice' AS name, round(AVG(o_totalprice), 4) AS mean, round(stddev_pop(o_totalprice), 4) AS sd, COUNT(*) - COUNT(o_totalprice) AS missing FROM orders UNION ALL SELECT 'o_custkey', round(AVG(o_custkey), 4), round(stddev_pop(o_custkey), 4), COUNT(*) - COUNT(o_custkey) FROM orders")
def standardizer(spark, d):
    return M.standardizer(table(spark, d, "orders"), "o_totalprice", "o_custkey").select("name", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"), "missing")


@query("SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS code FROM (SELECT DISTINCT o_orderpriority AS value FROM orders)")
def category_map(spark, d):
    return M.categories(table(spark, d, "orders"), "o_orderpriority")


@query("SELECT round(MAX(g), 6) AS max_abs, round(quantile_cont(g, 0.99), 6) AS p99_abs, CAST(SUM(CASE WHEN g > 0.25 THEN 1 ELSE 0 END) AS BIGINT) AS over_tolerance FROM (SELECT abs(CAST(unnest(embedding[1:32]) AS DOUBLE) - CAST(unnest(embedding[33:64]) AS DOUBLE)) AS g FROM embeddings)")
def array_parity(spark, d):
    e = F.transform("embedding", lambda x: x.cast("double"))
    rows = table(spark, d, "embeddings").select(F.slice(e, 1, 32).alias("a"), F.slice(e, 33, 32).alias("b"))
    return M.array_parity(rows, "a", "b", 0.25).select(F.round("max_abs", 6).alias("max_abs"), F.round("p99_abs", 6).alias("p99_abs"), F.col("over").alias("over_tolerance"))


@query("SELECT round(SUM(l_discount * l_quantity) / SUM(l_quantity), 6) AS weighted FROM lineitem")
def weighted_mean(spark, d):
    return table(spark, d, "lineitem").agg(F.round(F.sum(F.col("l_discount") * F.col("l_quantity")) / F.sum("l_quantity"), 6).alias("weighted"))


@query("SELECT label, COUNT(*) AS positions, COUNT(DISTINCT vec_id) AS games FROM embeddings GROUP BY label")
def class_support(spark, d):
    return table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("positions"), F.countDistinct("vec_id").alias("games"))
