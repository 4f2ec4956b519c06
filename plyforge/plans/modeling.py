"""Sampling, splits, holdouts, leakage audit and the frequency policy."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plyforge.functions.identity import hash_score, sampled
from plyforge.operators import leakage
from plyforge.plans.registry import query
from plyforge.plans.standins import EXAMPLES_SQL, GAMES_SQL, SPLIT_SQL, examples, games, split_of

E, G = f"WITH {EXAMPLES_SQL}", f"WITH {GAMES_SQL}"
U64 = "CAST(('0x' || substr(sha256({}), 1, 16)) AS UBIGINT)"
SEED = "seed"


def u64_sql(namespace: str, token: str) -> str:
    return U64.format(f"'{namespace}|{SEED}|' || CAST({token} AS VARCHAR)")


@query(f"{G} SELECT game_id, CAST({u64_sql('game_sampling', 'game_id')} AS VARCHAR) AS score FROM games WHERE {u64_sql('game_sampling', 'game_id')} % 10000 < 1000")
def hash_sample(spark, d):
    score = hash_score("game_sampling", SEED, F.col("game_id"))
    return games(spark, d).filter(sampled("game_sampling", SEED, F.col("game_id"), 1000, 10_000)).select("game_id", score.cast("string").alias("score"))


@query(f"{G} SELECT game_id, CAST({u64_sql('topk', 'game_id')} AS VARCHAR) AS score FROM games ORDER BY {u64_sql('topk', 'game_id')}, game_id LIMIT 50")
def topk_hash(spark, d):
    rows = games(spark, d).select("game_id", hash_score("topk", SEED, F.col("game_id")).alias("u"))
    return rows.orderBy("u", "game_id").limit(50).select("game_id", F.col("u").cast("string").alias("score"))


@query(f"{E}, k AS (SELECT DISTINCT game_id, ply FROM examples) SELECT * FROM k ORDER BY {U64.format("CAST(game_id AS VARCHAR) || ':' || CAST(ply AS VARCHAR) || ':42'")}, game_id, ply LIMIT 200")
def seeded_select(spark, d):
    from plyforge.functions.identity import u64

    rows = examples(spark, d).select("game_id", "ply").distinct()
    return rows.orderBy(u64(F.concat_ws(":", F.col("game_id").cast("string"), F.col("ply").cast("string"), F.lit("42"))), "game_id", "ply").limit(200)


@query(f"{E}, c AS (SELECT DISTINCT game_id, position_id FROM examples), r AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY {U64.format("'neg|' || CAST(game_id AS VARCHAR) || '|' || position_id")}, position_id) AS place FROM c) SELECT game_id, position_id, CAST(place AS INTEGER) AS place FROM r WHERE place <= 2")
def neg_sampling(spark, d):
    return leakage.hash_ordered(examples(spark, d).select("game_id", "position_id").distinct(), "game_id", "position_id", "neg", 2)


@query(f"{G}, r AS (SELECT game_id, row_number() OVER (ORDER BY {u64_sql('half', 'game_id')}, game_id) AS place, COUNT(*) OVER () AS n FROM games) SELECT game_id, CASE WHEN place <= floor(n / 2) THEN 'fit' ELSE 'check' END AS half FROM r")
def game_half_split(spark, d):
    """Ranks all games without sorting them in one task: ranks within ranges of the hash, plus the games of the ranges before."""
    rows = games(spark, d).select("game_id", hash_score("half", SEED, F.col("game_id")).alias("u"))
    rows = rows.withColumn("range", F.floor(F.col("u") / F.lit(2**48)).cast("int"))
    # At most 65,537 ranges, whatever the number of games.
    ranges, every = rows.groupBy("range").agg(F.count("*").alias("m")), Window.orderBy("range")
    ranges = ranges.select("range", (F.sum("m").over(every) - F.col("m")).alias("before"), F.sum("m").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy("u", "game_id"))).join(F.broadcast(ranges), "range")
    return rows.select("game_id", F.when(F.col("before") + F.col("place") <= F.floor(F.col("n") / 2), "fit").otherwise("check").alias("half"))


HELD = f"{u64_sql('player_holdout', '{}')} % 100 < 10"


@query(f"{G}, a AS (SELECT game_id, {SPLIT_SQL} AS temporal_split, {HELD.format('white_player')} AS white_is_holdout, {HELD.format('black_player')} AS black_is_holdout FROM games) SELECT *, (white_is_holdout OR black_is_holdout) AS is_holdout_game, (temporal_split IS NOT NULL AND temporal_split = 'train' AND NOT white_is_holdout AND NOT black_is_holdout) AS eligible FROM a")
def assignments(spark, d):
    rows = games(spark, d).select("game_id", "white_player", "black_player", split_of(F.col("played_at")).alias("temporal_split"))
    rows = leakage.with_holdout(rows, "white_player", "black_player", SEED, 10, 100)
    return rows.drop("white_player", "black_player")


@query(f"{G}, p AS (SELECT white_player AS player FROM games UNION SELECT black_player FROM games) SELECT player FROM p WHERE {HELD.format('player')}")
def heldout_union(spark, d):
    g = games(spark, d)
    players = g.select(F.explode(F.array("white_player", "black_player")).alias("player")).distinct()
    return players.filter(sampled("player_holdout", SEED, F.col("player"), 10, 100))


@query(f"{G}, r AS (SELECT CASE WHEN {SPLIT_SQL} IS NULL THEN 'outside_declared_ranges' ELSE 'date_interval' END AS reason FROM games) SELECT reason, COUNT(*) AS n FROM r GROUP BY reason")
def reject_counts(spark, d):
    reason = F.when(split_of(F.col("played_at")).isNull(), "outside_declared_ranges").otherwise("date_interval")
    return games(spark, d).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(f"{E} SELECT game_id, ply, position_id, side_to_move, temporal_split, result FROM examples")
def examples_join(spark, d):
    return examples(spark, d).select("game_id", "ply", "position_id", "side_to_move", "temporal_split", "result")


@query(f"{E} SELECT game_id, ply, position_id FROM examples WHERE temporal_split = 'test' AND position_id IN (SELECT position_id FROM examples WHERE temporal_split = 'train')")
def semi_in(spark, d):
    e = examples(spark, d).select("game_id", "ply", "position_id", "temporal_split")
    return leakage.seen(e).drop("temporal_split")


@query(f"{E} SELECT game_id, ply, position_id FROM examples WHERE temporal_split = 'test' AND position_id NOT IN (SELECT position_id FROM examples WHERE temporal_split = 'train')")
def anti_notin(spark, d):
    e = examples(spark, d).select("game_id", "ply", "position_id", "temporal_split")
    return leakage.novel(e).drop("temporal_split")


@query(f"{E}, n AS (SELECT game_id, ply, position_id, 'novel_position_test' AS temporal_split FROM examples WHERE temporal_split = 'test' AND position_id NOT IN (SELECT position_id FROM examples WHERE temporal_split = 'train')) SELECT game_id, ply, position_id, temporal_split FROM examples UNION ALL SELECT * FROM n")
def novel_slice(spark, d):
    e = examples(spark, d).select("game_id", "ply", "position_id", "temporal_split")
    return e.unionByName(leakage.novel(e).withColumn("temporal_split", F.lit("novel_position_test")))


@query(f"{E}, h AS (SELECT DISTINCT white_player AS p FROM examples WHERE temporal_split = 'test'), k AS (SELECT DISTINCT black_player AS p FROM examples WHERE temporal_split = 'test') SELECT DISTINCT game_id FROM examples WHERE temporal_split = 'train' AND (white_player IN (SELECT p FROM h) OR black_player IN (SELECT p FROM k))")
def disjunctive_semi(spark, d):
    e = examples(spark, d)
    test, train = e.filter("temporal_split = 'test'"), e.filter("temporal_split = 'train'")
    held = test.select(F.explode(F.array(F.struct(F.lit("w").alias("side"), F.col("white_player").alias("p")), F.struct(F.lit("b").alias("side"), F.col("black_player").alias("p")))).alias("x")).select("x.*").distinct()
    sides = train.select("game_id", F.explode(F.array(F.struct(F.lit("w").alias("side"), F.col("white_player").alias("p")), F.struct(F.lit("b").alias("side"), F.col("black_player").alias("p")))).alias("x")).select("game_id", "x.*")
    return sides.join(held, ["side", "p"], "left_semi").select("game_id").distinct()


@query(f"{E} SELECT temporal_split, CAST(SUM(CASE WHEN position_id IN (SELECT position_id FROM examples WHERE temporal_split = 'train') THEN 1 ELSE 0 END) AS BIGINT) AS seen_in_train, COUNT(*) AS n FROM examples GROUP BY temporal_split")
def in_inside_sum(spark, d):
    return leakage.flagged(examples(spark, d)).groupBy("temporal_split").agg(F.sum("in_train").alias("seen_in_train"), F.count("*").alias("n"))


@query(f"{E} SELECT COUNT(*) AS overlap FROM (SELECT DISTINCT white_player FROM examples WHERE temporal_split = 'train') a JOIN (SELECT DISTINCT white_player FROM examples WHERE temporal_split = 'test') b ON a.white_player = b.white_player")
def distinct_overlap(spark, d):
    e = examples(spark, d)
    side = lambda s: e.filter(F.col("temporal_split") == s).select("white_player").distinct()
    return side("train").join(side("test"), "white_player").agg(F.count("*").alias("overlap"))


@query(f"{E} SELECT COUNT(*) AS overlap FROM (SELECT position_id FROM examples WHERE temporal_split = 'train' INTERSECT SELECT position_id FROM examples WHERE temporal_split = 'test')")
def intersect_keys(spark, d):
    e = examples(spark, d)
    side = lambda s: e.filter((F.col("temporal_split") == s) & F.col("position_id").isNotNull()).select("position_id")
    return side("train").intersect(side("test")).agg(F.count("*").alias("overlap"))


@query(f"{E}, p AS (SELECT temporal_split, white_player AS p FROM examples UNION ALL SELECT temporal_split, black_player FROM examples) SELECT COUNT(*) AS overlap FROM (SELECT p FROM p WHERE temporal_split = 'train' INTERSECT SELECT p FROM p WHERE temporal_split = 'validation')")
def players_intersect(spark, d):
    players = examples(spark, d).select("temporal_split", F.explode(F.array("white_player", "black_player")).alias("p"))
    side = lambda s: players.filter(F.col("temporal_split") == s).select("p")
    return side("train").intersect(side("validation")).agg(F.count("*").alias("overlap"))


SPLITS = "(SELECT unnest(['train', 'validation', 'test']) AS temporal_split)"


@query(f"{E} SELECT s.temporal_split, COUNT(e.game_id) AS n_rows, COUNT(DISTINCT e.position_id) AS n_positions FROM {SPLITS} s LEFT JOIN examples e ON e.temporal_split = s.temporal_split GROUP BY s.temporal_split")
def split_counts(spark, d):
    return leakage.split_counts(examples(spark, d))


AUDIT = f"{E}, t AS (SELECT DISTINCT position_id FROM examples WHERE temporal_split = 'train')"


@query(f"{AUDIT} SELECT s.temporal_split, COUNT(e.game_id) AS n_rows, COUNT(t.position_id) AS n_seen, CASE WHEN COUNT(e.game_id) > 0 THEN round(COUNT(t.position_id) * 100.0 / COUNT(e.game_id), 6) ELSE 0.0 END AS seen_percent FROM (SELECT unnest(['validation', 'test']) AS temporal_split) s LEFT JOIN examples e ON e.temporal_split = s.temporal_split LEFT JOIN t ON e.position_id = t.position_id GROUP BY s.temporal_split")
def overlap_pct(spark, d):
    return leakage.overlap(examples(spark, d))


BAND = "CASE WHEN ply < 2 THEN 'early' WHEN ply < 4 THEN 'middle' ELSE 'late' END"


@query(f"{AUDIT} SELECT e.temporal_split, {BAND} AS band, COUNT(*) AS n_rows, COUNT(t.position_id) AS n_seen FROM examples e LEFT JOIN t ON e.position_id = t.position_id WHERE e.temporal_split <> 'train' GROUP BY 1, 2")
def overlap_band(spark, d):
    return leakage.overlap_by_band(examples(spark, d), ((2, "early"), (4, "middle")), "late")


@query(f"{E} SELECT temporal_split, COUNT(*) AS n_moves, COUNT(DISTINCT game_id) AS n_games, COUNT(DISTINCT position_id) AS n_positions, MIN(white_rating) AS min_rating, MAX(white_rating) AS max_rating FROM examples GROUP BY temporal_split")
def split_summary(spark, d):
    return examples(spark, d).groupBy("temporal_split").agg(F.count("*").alias("n_moves"), F.countDistinct("game_id").alias("n_games"), F.countDistinct("position_id").alias("n_positions"), F.min("white_rating").alias("min_rating"), F.max("white_rating").alias("max_rating"))


@query(f"{E}, p AS (SELECT temporal_split, white_player AS player FROM examples UNION ALL SELECT temporal_split, black_player FROM examples) SELECT temporal_split, COUNT(DISTINCT player) AS n_players FROM p GROUP BY temporal_split")
def split_summary_players(spark, d):
    return examples(spark, d).select("temporal_split", F.explode(F.array("white_player", "black_player")).alias("player")).groupBy("temporal_split").agg(F.countDistinct("player").alias("n_players"))


@query(f"{E} SELECT white_player, COUNT(DISTINCT temporal_split) AS n_splits FROM examples GROUP BY white_player HAVING COUNT(DISTINCT temporal_split) > 1")
def multi_split_players(spark, d):
    return examples(spark, d).groupBy("white_player").agg(F.countDistinct("temporal_split").alias("n_splits")).filter("n_splits > 1")


@query(f"{E} SELECT temporal_split, COUNT(*) - COUNT(DISTINCT CAST(game_id AS VARCHAR) || ':' || CAST(ply AS VARCHAR)) AS n_repeated FROM examples GROUP BY temporal_split")
def duplicate_examples(spark, d):
    return examples(spark, d).groupBy("temporal_split").agg((F.count("*") - F.countDistinct("game_id", "ply")).alias("n_repeated"))


FREQ = f"{E}, f AS (SELECT time_control_raw AS band, opening AS phase, ply AS action FROM examples WHERE temporal_split = 'train')"


@query(f"{FREQ} SELECT band, phase, action, COUNT(*) AS n FROM f GROUP BY GROUPING SETS ((band, phase, action), (phase, action), (action))")
def freq_counts(spark, d):
    return leakage.frequency_levels(_train(spark, d))


def _train(spark, d):
    return examples(spark, d).filter("temporal_split = 'train'").select(F.col("time_control_raw").alias("band"), F.col("opening").alias("phase"), F.col("ply").alias("action"))


@query(
    f"{FREQ}, v AS (SELECT game_id, ply, time_control_raw AS band, opening AS phase, ply AS action FROM examples WHERE temporal_split = 'validation'), a AS (SELECT band, phase, action, COUNT(*) AS n FROM f GROUP BY 1, 2, 3), b AS (SELECT phase, action, COUNT(*) AS n FROM f GROUP BY 1, 2), c AS (SELECT action, COUNT(*) AS n FROM f GROUP BY 1) "
    "SELECT v.game_id, v.ply, CASE WHEN COALESCE(a.n, 0) > 0 THEN 3000000 + a.n WHEN COALESCE(b.n, 0) > 0 THEN 2000000 + b.n WHEN COALESCE(c.n, 0) > 0 THEN 1000000 + c.n ELSE 0 END AS score FROM v LEFT JOIN a ON v.band = a.band AND v.phase = a.phase AND v.action = a.action LEFT JOIN b ON v.phase = b.phase AND v.action = b.action LEFT JOIN c ON v.action = c.action"
)
def freq_score(spark, d):
    rows = examples(spark, d).filter("temporal_split = 'validation'").select("game_id", "ply", F.col("time_control_raw").alias("band"), F.col("opening").alias("phase"), F.col("ply").alias("action"))
    return leakage.frequency_scores(rows, _train(spark, d), (("band", "phase", "action"), ("phase", "action"), ("action",))).select("game_id", "ply", "score")


@query(f"{E}, b AS (SELECT temporal_split, MIN(game_id) AS first_game, MAX(game_id) AS last_game, MIN(ply) AS first_ply, MAX(ply) AS last_ply FROM examples GROUP BY temporal_split) SELECT * FROM b")
def split_bounds(spark, d):
    return examples(spark, d).groupBy("temporal_split").agg(F.min("game_id").alias("first_game"), F.max("game_id").alias("last_game"), F.min("ply").alias("first_ply"), F.max("ply").alias("last_ply"))


@query(f"{E} SELECT temporal_split, time_control_raw, opening, COUNT(*) AS n FROM examples GROUP BY 1, 2, 3")
def split_summary_controls(spark, d):
    return examples(spark, d).groupBy("temporal_split", "time_control_raw", "opening").agg(F.count("*").alias("n"))


@query(f"{G}, p AS (SELECT white_player AS player FROM games UNION ALL SELECT black_player FROM games) SELECT player, {HELD.format('player')} AS is_holdout, COUNT(*) AS n FROM p GROUP BY player")
def holdout_flags(spark, d):
    players = games(spark, d).select(F.explode(F.array("white_player", "black_player")).alias("player")).groupBy("player").agg(F.count("*").alias("n"))
    return players.select("player", sampled("player_holdout", SEED, F.col("player"), 10, 100).alias("is_holdout"), "n")


@query(f"{E}, t AS (SELECT game_id, ply, quantity, row_number() OVER (PARTITION BY temporal_split ORDER BY {U64.format("'cal|' || CAST(game_id AS VARCHAR) || '|' || CAST(ply AS VARCHAR)")}, game_id, ply, quantity) AS place, temporal_split FROM examples) SELECT temporal_split, CAST(SUM(CASE WHEN place <= 100 THEN quantity ELSE 0 END) AS BIGINT) AS quantity, COUNT(*) AS n FROM t WHERE place <= 100 GROUP BY temporal_split")
def capped_selection(spark, d):
    """The first 100 examples of each split in hash order: only the best 100 of each task are shuffled."""
    from plyforge.functions.identity import u64

    rows = examples(spark, d).select("temporal_split", "game_id", "ply", "quantity", u64(F.concat_ws("|", F.lit("cal"), F.col("game_id").cast("string"), F.col("ply").cast("string"))).alias("u"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("temporal_split").orderBy("u", "game_id", "ply", "quantity"))).filter("place <= 100")
    return rows.groupBy("temporal_split").agg(F.sum("quantity").alias("quantity"), F.count("*").alias("n"))
