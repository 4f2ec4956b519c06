"""Scalar functions, one query each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from plyforge.functions import columns as C
from plyforge.functions.identity import hash_score, hmac_sha256, player_hash
from plyforge.plans.registry import query
from plyforge.plans.standins import GAMES_SQL, MOVES_SQL, games, moves
from plyforge.sources.tables import table

G = f"WITH {GAMES_SQL}"

FEN = "'rnbqkbnr/pp1ppppp/8/2p5/4P3/8/PPPP1PPP/RNBQKBNR w KQkq ' || CASE WHEN game_id % 3 = 0 THEN 'c6' ELSE '-' END || ' 0 2'"


def _fen(c="game_id"):
    return F.concat(F.lit("rnbqkbnr/pp1ppppp/8/2p5/4P3/8/PPPP1PPP/RNBQKBNR w KQkq "), F.when(F.col(c) % 3 == 0, "c6").otherwise("-"), F.lit(" 0 2"))


@query(f"{G}, f AS (SELECT game_id, {FEN} AS fen FROM games) SELECT game_id, split_part(fen, ' ', 3) AS castling, nullif(split_part(fen, ' ', 4), '-') AS en_passant, split_part(fen, ' ', 9) AS beyond FROM f")
def fen_split(spark, d):
    rows = games(spark, d).select("game_id", _fen().alias("fen"))
    return rows.select("game_id", C.fen_part(F.col("fen"), 3).alias("castling"), F.nullif(C.fen_part(F.col("fen"), 4), F.lit("-")).alias("en_passant"), C.fen_part(F.col("fen"), 9).alias("beyond"))


@query("SELECT o_orderkey, nullif(regexp_extract('db_' || strftime(o_orderdate, '%Y-%m') || '.pgn.zst', '(\\d{4}-\\d{2})', 1), '') AS month, nullif(regexp_extract('plain' || o_orderstatus, '(\\d{4}-\\d{2})', 1), '') AS no_month FROM orders")
def regex_month(spark, d):
    o = table(spark, d, "orders")
    name = F.concat(F.lit("db_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".pgn.zst"))
    return o.select("o_orderkey", C.month_of_name(name).alias("month"), C.month_of_name(F.concat(F.lit("plain"), "o_orderstatus")).alias("no_month"))


@query("SELECT page_id, nullif(regexp_extract('[%clk 0:0' || CAST(page_id % 10 AS VARCHAR) || ':30]', '\\[%clk\\s+([^\\]]+)\\]', 1), '') AS clock FROM pages")
def clock_text(spark, d):
    comment = F.concat(F.lit("[%clk 0:0"), (F.col("page_id") % 10).cast("string"), F.lit(":30]"))
    return table(spark, d, "pages").select("page_id", C.clock_of_comment(comment).alias("clock"))


@query("SELECT o_orderkey, TRY_CAST(trim(CASE WHEN o_orderkey % 4 = 0 THEN ' ' || CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 4 = 1 THEN '?' WHEN o_orderkey % 4 = 2 THEN '' ELSE o_orderpriority END) AS INTEGER) AS rating FROM orders")
def header_int(spark, d):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"))).when(k == 1, "?").when(k == 2, "").otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", C.header_int(text).alias("rating"))


@query("SELECT o_orderkey, nullif(trim(CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE ' ' || o_orderstatus || ' ' END), '') AS cleaned FROM orders")
def string_clean(spark, d):
    text = F.when(F.col("o_orderkey") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")))
    return table(spark, d, "orders").select("o_orderkey", C.blank_to_null(text).alias("cleaned"))


DATE_TEXT = "CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y.%m.%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN '????.??.??' WHEN 3 THEN '' ELSE NULL END"


def _date_text():
    k = F.col("o_orderkey") % 5
    return F.when(k == 0, F.date_format("o_orderdate", "yyyy.MM.dd")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 2, "????.??.??").when(k == 3, "")


@query(f"WITH t AS (SELECT o_orderkey, {DATE_TEXT} AS x FROM orders) SELECT o_orderkey, CASE WHEN x LIKE '____%' AND x NOT LIKE '%?%' THEN replace(x, '.', '-') END AS day, CASE WHEN x IS NULL OR x = '' THEN 'missing' WHEN x LIKE '%?%' THEN 'invalid' END AS problem FROM t")
def parse_date(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", C.played_date(_date_text()).alias("p"))
    return rows.select("o_orderkey", F.col("p.day").cast("string").alias("day"), F.col("p.problem").alias("problem"))


@query(f"WITH t AS (SELECT o_orderkey, {DATE_TEXT} AS u, strftime(o_orderdate, '%Y.%m.%d') AS l FROM orders) SELECT o_orderkey, replace(CASE WHEN u LIKE '____%' AND u NOT LIKE '%?%' THEN u ELSE l END, '.', '-') AS day, CASE WHEN u LIKE '____%' AND u NOT LIKE '%?%' THEN 'utc_date' ELSE 'date' END AS source FROM t")
def canonical_date(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", C.canonical_date(_date_text(), F.date_format("o_orderdate", "yyyy.MM.dd")).alias("c"))
    return rows.select("o_orderkey", F.col("c.day").cast("string").alias("day"), F.col("c.source").alias("source"))


RANGES = (("train", date(1995, 1, 1), date(1998, 12, 31)), ("validation", date(1999, 1, 1), date(1999, 12, 31)), ("test", date(2000, 1, 1), date(2000, 12, 31)))
INTERVAL = "x LIKE '____%' AND x NOT LIKE '%?%'"


@query(
    f"WITH t AS (SELECT o_orderkey, {DATE_TEXT} AS x, year(o_orderdate) AS y FROM orders) SELECT o_orderkey, CASE WHEN NOT ({INTERVAL}) OR x IS NULL THEN 'train' WHEN y BETWEEN 1995 AND 1998 THEN 'train' WHEN y = 1999 THEN 'validation' WHEN y = 2000 THEN 'test' END AS split, CASE WHEN NOT ({INTERVAL}) OR x IS NULL THEN 'policy_assigned_missing_or_invalid' WHEN y BETWEEN 1995 AND 2000 THEN 'date_interval' ELSE 'outside_declared_ranges' END AS reason FROM t"
)
def temporal_split(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", C.temporal_split(C.played_date(_date_text()), RANGES, "train").alias("s"))
    return rows.select("o_orderkey", "s.split", "s.reason")


@query(f"WITH {GAMES_SQL}, {MOVES_SQL} SELECT m.game_id, m.ply, CASE WHEN g.result = '1/2-1/2' THEN 'draw' WHEN (m.side_to_move = 'w') = (g.result = '1-0') THEN 'win' ELSE 'loss' END AS label FROM moves m JOIN games g ON m.game_id = g.game_id")
def wdl_label(spark, d):
    rows = moves(spark, d).select("game_id", "ply", "side_to_move").join(games(spark, d).select("game_id", "result"), "game_id")
    return rows.select("game_id", "ply", C.value_label(F.col("side_to_move"), F.col("result")).alias("label"))


@query(f"{G} SELECT game_id, CASE WHEN r IS NULL THEN 'unknown' WHEN r < 1200 THEN 'lt_1200' WHEN r < 1600 THEN '1200_1599' WHEN r < 2000 THEN '1600_1999' ELSE 'gte_2000' END AS band FROM (SELECT game_id, nullif(black_rating % 2500, 0) AS r FROM games)")
def rating_band(spark, d):
    return games(spark, d).select("game_id", C.rating_band(F.nullif(F.col("black_rating") % 2500, F.lit(0))).alias("band"))


CONTROL = "CASE WHEN o_orderkey % 7 = 0 THEN '-' ELSE CAST(o_custkey AS VARCHAR) || '+' || CAST(o_orderkey % 5 AS VARCHAR) END"


@query(f"WITH t AS (SELECT o_orderkey, {CONTROL} AS x, o_custkey AS b FROM orders) SELECT o_orderkey, CASE WHEN x = '-' THEN 'unknown' WHEN b < 180 THEN 'bullet' WHEN b < 480 THEN 'blitz' WHEN b < 1500 THEN 'rapid' ELSE 'classical' END AS category FROM t")
def time_control(spark, d):
    raw = F.when(F.col("o_orderkey") % 7 == 0, "-").otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("+"), (F.col("o_orderkey") % 5).cast("string")))
    return table(spark, d, "orders").select("o_orderkey", C.time_control(raw).alias("category"))


@query("SELECT o_orderkey, COALESCE(nullif(substr(upper(trim(CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE o_orderpriority END)), 1, 1), ''), 'unknown') AS family FROM orders")
def opening_family(spark, d):
    code = F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", C.opening_family(code).alias("family"))


@query(f"{G}, f AS (SELECT game_id, {FEN} AS fen, game_id % 60 AS ply FROM games) SELECT game_id, CASE WHEN length(regexp_replace(split_part(fen, ' ', 1), '[^nbrqNBRQ]', '', 'g')) >= 12 AND ply < 40 THEN 'opening' WHEN length(regexp_replace(split_part(fen, ' ', 1), '[^nbrqNBRQ]', '', 'g')) >= 6 THEN 'middlegame' ELSE 'endgame' END AS phase FROM f")
def game_phase(spark, d):
    rows = games(spark, d).select("game_id", _fen().alias("fen"))
    return rows.select("game_id", C.game_phase(F.col("fen"), F.col("game_id") % 60).alias("phase"))


@query("SELECT vec_id, round(list_sum(list_transform(e, lambda x: exp(x / 1.5))), 4) AS total, round(list_max(e), 6) AS top FROM (SELECT vec_id, list_transform(embedding[1:10], lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)")
def softmax_parts(spark, d):
    e = F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double"))
    rows = table(spark, d, "embeddings").select("vec_id", e.alias("e"))
    return rows.select("vec_id", F.round(F.aggregate(F.transform("e", lambda x: F.exp(x / 1.5)), F.lit(0.0), lambda a, x: a + x), 4).alias("total"), F.round(F.array_max("e"), 6).alias("top"))


@query("WITH e AS (SELECT vec_id, unnest(embedding[1:10]) AS x, generate_subscripts(embedding[1:10], 1) - 1 AS class FROM embeddings), s AS (SELECT vec_id, class, exp(CAST(x AS DOUBLE) / 1.5) AS p FROM e), t AS (SELECT vec_id, SUM(p) AS total FROM s GROUP BY vec_id) SELECT s.vec_id, CAST(s.class AS INTEGER) AS class, round(s.p / t.total, 6) AS p FROM s JOIN t ON s.vec_id = t.vec_id")
def softmax_temp(spark, d):
    e = F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double"))
    rows = table(spark, d, "embeddings").select("vec_id", C.softmax(e, 1.5).alias("p"))
    return rows.select("vec_id", F.posexplode("p").alias("class", "p")).withColumn("p", F.round("p", 6))


@query(f"{G} SELECT game_id, sha256('archive|' || CAST(game_id AS VARCHAR)) AS sha_id, CAST(CAST(('0x' || substr(sha256('game_sampling|seed|' || CAST(game_id AS VARCHAR)), 1, 16)) AS UBIGINT) AS VARCHAR) AS score FROM games")
def sha_ids(spark, d):
    key = F.col("game_id")
    return games(spark, d).select("game_id", F.sha2(F.concat(F.lit("archive|"), key.cast("string")), 256).alias("sha_id"), hash_score("game_sampling", "seed", key).cast("string").alias("score"))


@query("SELECT c_custkey, 'player_' || substr(sha256('fixture-placeholder|' || lower(trim(c_name))), 1, 24) AS player FROM customer")
def player_ids(spark, d):
    return table(spark, d, "customer").select("c_custkey", player_hash(F.col("c_name")).alias("player"))


@query()
def player_hmac(spark, d):
    """HMAC has no SQL here; a test holds it against the standard library."""
    return table(spark, d, "customer").select("c_custkey", hmac_sha256(b"key", F.lower(F.trim("c_name"))).alias("digest"))
