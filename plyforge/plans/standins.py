"""Relations of the data model over the driver's tables, as DataFrames and as SQL for the oracle.

Orders stand for games, line items for moves, ``part-line`` keys for positions, customers for players.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.functions.columns import by_side
from plyforge.sources.tables import table

MONTH, DAY = "yyyy-MM", "yyyy-MM-dd"

GAMES_SQL = """games AS (SELECT o_orderkey AS game_id, strftime(o_orderdate, '%Y-%m') AS source_month,
  strftime(o_orderdate, '%Y.%m.%d') AS played_date, o_orderdate AS played_at,
  CASE o_orderstatus WHEN 'F' THEN '1-0' WHEN 'O' THEN '0-1' ELSE '1/2-1/2' END AS result,
  'c' || CAST(o_custkey AS VARCHAR) AS white_player, 'c' || CAST((o_custkey * 31) % 1500 AS VARCHAR) AS black_player,
  CAST(floor(o_totalprice) AS INTEGER) AS white_rating, CAST(floor(c_acctbal) AS INTEGER) AS black_rating,
  split_part(o_orderpriority, '-', 1) AS time_control_raw, o_orderpriority AS opening
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
MOVES_SQL = """moves AS (SELECT l_orderkey AS game_id, l_linenumber - 1 AS ply, l_partkey AS part_id,
  CAST(l_partkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS position_id,
  CASE l_linestatus WHEN 'O' THEN 'w' ELSE 'b' END AS side_to_move, strftime(l_shipdate, '%Y-%m') AS source_month,
  'c' || CAST(l_suppkey AS VARCHAR) AS supplier_player, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem)"""
SPLIT_SQL = """CASE WHEN played_at >= TIMESTAMP '1995-01-01' AND played_at < TIMESTAMP '1999-01-01' THEN 'train'
  WHEN played_at >= TIMESTAMP '1999-01-01' AND played_at < TIMESTAMP '2000-01-01' THEN 'validation'
  WHEN played_at >= TIMESTAMP '2000-01-01' AND played_at < TIMESTAMP '2001-01-01' THEN 'test' END"""
EXAMPLES_SQL = f"""{GAMES_SQL}, {MOVES_SQL}, assigned AS (SELECT *, {SPLIT_SQL} AS temporal_split FROM games),
examples AS (SELECT m.game_id, m.ply, m.position_id, m.side_to_move, a.temporal_split, a.white_player, a.black_player, a.result,
  a.white_rating, a.time_control_raw, a.opening, m.quantity
  FROM moves m JOIN assigned a ON m.game_id = a.game_id WHERE a.temporal_split IS NOT NULL)"""


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    result = F.when(F.col("o_orderstatus") == "F", "1-0").when(F.col("o_orderstatus") == "O", "0-1").otherwise("1/2-1/2")
    player = lambda key: F.concat(F.lit("c"), key.cast("string"))
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        F.col("o_orderkey").alias("game_id"), F.date_format("o_orderdate", MONTH).alias("source_month"), F.date_format("o_orderdate", "yyyy.MM.dd").alias("played_date"),
        F.col("o_orderdate").alias("played_at"), result.alias("result"), player(F.col("o_custkey")).alias("white_player"), player((F.col("o_custkey") * 31) % 1500).alias("black_player"),
        F.floor("o_totalprice").cast("int").alias("white_rating"), F.floor("c_acctbal").cast("int").alias("black_rating"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("time_control_raw"), F.col("o_orderpriority").alias("opening"),
    )


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), (F.col("l_linenumber") - 1).alias("ply"), F.col("l_partkey").alias("part_id"),
        F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string")).alias("position_id"),
        F.when(F.col("l_linestatus") == "O", "w").otherwise("b").alias("side_to_move"), F.date_format("l_shipdate", MONTH).alias("source_month"),
        F.concat(F.lit("c"), F.col("l_suppkey").cast("string")).alias("supplier_player"), F.col("l_quantity").cast("int").alias("quantity"),
    )


def split_of(played_at) -> "F.Column":
    ts = lambda y: F.lit(f"{y}-01-01").cast("timestamp_ntz")
    within = lambda a, b: (played_at >= ts(a)) & (played_at < ts(b))
    return F.when(within(1995, 1999), "train").when(within(1999, 2000), "validation").when(within(2000, 2001), "test")


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves of games with a split: games are assigned first, so the join carries only what is used."""
    assigned = games(spark, sf_dir).withColumn("temporal_split", split_of(F.col("played_at"))).filter("temporal_split IS NOT NULL")
    assigned = assigned.select("game_id", "temporal_split", "white_player", "black_player", "result", "white_rating", "time_control_raw", "opening")
    return moves(spark, sf_dir).select("game_id", "ply", "position_id", "side_to_move", "quantity").join(assigned, "game_id")


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves with their games: the flagship join; the mover's view of ratings is added by ``mover_view``."""
    g = games(spark, sf_dir).select("game_id", "white_rating", "black_rating", "result", "opening")
    return moves(spark, sf_dir).select("game_id", "ply", "position_id", "side_to_move").join(g, "game_id")


def mover_view(df: DataFrame, strict: bool = False) -> DataFrame:
    mover = by_side(F.col("side_to_move"), F.col("white_rating"), F.col("black_rating"), strict)
    other = by_side(F.col("side_to_move"), F.col("black_rating"), F.col("white_rating"), strict)
    return df.withColumns({"mover_rating": mover, "opponent_rating": other}).withColumn("rating_difference", F.col("mover_rating") - F.col("opponent_rating"))
