"""Staging, intermediate and mart relations with their data tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from plyforge.operators import checks
from plyforge.plans.registry import query
from plyforge.plans.standins import GAMES_SQL, MOVES_SQL, context, games, mover_view, moves
from plyforge.sources.tables import table

G, M, GM = f"WITH {GAMES_SQL}", f"WITH {MOVES_SQL}", f"WITH {GAMES_SQL}, {MOVES_SQL}"


@query(f"{G} SELECT game_id, source_month, played_date, result, white_player, black_player, white_rating, black_rating, time_control_raw FROM games")
def stg_games(spark, d):
    return games(spark, d).select("game_id", "source_month", "played_date", "result", "white_player", "black_player", "white_rating", "black_rating", "time_control_raw")


@query(f"{M} SELECT game_id, CAST(ply AS INTEGER) AS ply, part_id, position_id, side_to_move, source_month FROM moves")
def stg_moves(spark, d):
    return moves(spark, d).select("game_id", F.col("ply").cast("int").alias("ply"), "part_id", "position_id", "side_to_move", "source_month")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, strftime(ts, '%Y-%m-%d') AS day FROM events")
def struct_flatten(spark, d):
    rows = table(spark, d, "events").select("event_id", "ts", F.from_json("props", "k int").alias("props"))
    return rows.select("event_id", F.col("props.k").alias("k"), F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query(f"{G} SELECT game_id, result AS final_result_label, opening AS termination_label FROM games")
def fct_rename(spark, d):
    return games(spark, d).select("game_id", "result", "opening").withColumnsRenamed({"result": "final_result_label", "opening": "termination_label"})


@query(f"{GM} SELECT m.game_id, m.ply, m.position_id, m.side_to_move, g.white_rating, g.black_rating, g.result, g.opening FROM moves m JOIN games g ON m.game_id = g.game_id")
def move_context_join(spark, d):
    return context(spark, d)


RATINGS = """CASE side_to_move WHEN 'w' THEN white_rating WHEN 'b' THEN black_rating END AS mover_rating,
CASE side_to_move WHEN 'w' THEN black_rating WHEN 'b' THEN white_rating END AS opponent_rating"""


@query(f"{GM}, c AS (SELECT m.game_id, m.ply, m.position_id, m.side_to_move, {RATINGS} FROM moves m JOIN games g ON m.game_id = g.game_id) SELECT *, mover_rating - opponent_rating AS rating_difference FROM c")
def mart_case_rating(spark, d):
    return mover_view(context(spark, d)).select("game_id", "ply", "position_id", "side_to_move", "mover_rating", "opponent_rating", "rating_difference")


@query(f"{GM} SELECT m.position_id, MIN(m.part_id) AS part_id, MIN(m.side_to_move) AS side_to_move, MIN(g.source_month) AS first_month, MAX(g.source_month) AS last_month, MIN(m.ply) AS first_ply, COUNT(*) AS occurrences FROM moves m JOIN games g ON m.game_id = g.game_id GROUP BY m.position_id")
def positions_dim(spark, d):
    rows = moves(spark, d).select("game_id", "position_id", "part_id", "side_to_move", "ply").join(games(spark, d).select("game_id", "source_month"), "game_id")
    return rows.groupBy("position_id").agg(F.min("part_id").alias("part_id"), F.min("side_to_move").alias("side_to_move"), F.min("source_month").alias("first_month"), F.max("source_month").alias("last_month"), F.min("ply").alias("first_ply"), F.count("*").alias("occurrences"))


@query(f"{GM} SELECT m.game_id, m.ply, m.source_month AS move_month, g.source_month AS game_month FROM moves m JOIN games g ON m.game_id = g.game_id WHERE m.source_month <> g.source_month")
def month_mismatch(spark, d):
    m = moves(spark, d).select("game_id", "ply", F.col("source_month").alias("move_month"))
    return m.join(games(spark, d).select("game_id", F.col("source_month").alias("game_month")), "game_id").filter("move_month <> game_month")


EXPECTED = "CAST(4 AS BIGINT)"


@query(f"{GM} SELECT g.game_id, {EXPECTED} AS expected, x.n AS n_children FROM games g JOIN (SELECT game_id, COUNT(*) AS n FROM moves GROUP BY game_id) x ON g.game_id = x.game_id WHERE x.n <> 4")
def ply_count_inner(spark, d):
    return checks.count_mismatch_inner(games(spark, d).select("game_id"), moves(spark, d), "game_id", F.lit(4))


@query(f"{GM} SELECT g.game_id, {EXPECTED} AS expected, COALESCE(x.n, 0) AS n_children FROM games g LEFT JOIN (SELECT game_id, COUNT(*) AS n FROM moves GROUP BY game_id) x ON g.game_id = x.game_id WHERE COALESCE(x.n, 0) <> 4")
def ply_count_left(spark, d):
    return checks.count_mismatch_left(games(spark, d).select("game_id"), moves(spark, d), "game_id", F.lit(4))


@query("SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL")
def orphan_rows(spark, d):
    return checks.orphans(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query(f"{GM} SELECT m.game_id, m.ply FROM moves m LEFT JOIN games g ON m.game_id = g.game_id WHERE g.game_id IS NULL")
def orphan_moves(spark, d):
    return checks.orphans(moves(spark, d).select("game_id", "ply"), games(spark, d), "game_id")


@query("SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing, CAST(SUM(CASE WHEN l.quality = 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def coverage_audit(spark, d):
    rows = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", F.lit(1).alias("hit"), "quality"), "doc_id", "left")
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col("hit").isNull()).alias("missing"), F.count_if(F.col("quality") == 0).alias("invalid"))


@query("SELECT d.doc_id, COALESCE(CAST(l.quality AS VARCHAR), 'unlabelled') AS quality_source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def enrich_left(spark, d):
    rows = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rows.select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("unlabelled")).alias("quality_source"))


@query("SELECT (SELECT COUNT(*) FROM orders) AS n_games, (SELECT COUNT(*) FROM lineitem) AS n_moves, (SELECT COUNT(*) FROM orders) - (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS games_without_moves")
def manifest_cross(spark, d):
    g = table(spark, d, "orders").agg(F.count("*").alias("n_games"))
    m = table(spark, d, "lineitem").agg(F.count("*").alias("n_moves"), F.countDistinct("l_orderkey").alias("k"))
    return g.crossJoin(m).select("n_games", "n_moves", (F.col("n_games") - F.col("k")).alias("games_without_moves"))


@query("SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1")
def dup_key1(spark, d):
    return checks.duplicate_keys(table(spark, d, "orders"), "o_custkey")


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def dup_key2(spark, d):
    return checks.duplicate_keys(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT o_custkey, COUNT(DISTINCT o_orderstatus) AS n_values FROM orders GROUP BY o_custkey HAVING COUNT(DISTINCT o_orderstatus) > 1")
def fd_violation(spark, d):
    return checks.dependency_violations(table(spark, d, "orders"), "o_custkey", "o_orderstatus")


@query(f"{M} SELECT game_id, CAST(MIN(ply) AS BIGINT) AS min_step, CAST(MAX(ply) AS BIGINT) AS max_step, COUNT(*) AS n_rows, COUNT(DISTINCT ply) AS n_steps FROM moves GROUP BY game_id HAVING MIN(ply) <> 0 OR MAX(ply) <> COUNT(*) - 1 OR COUNT(DISTINCT ply) <> COUNT(*)")
def contiguity(spark, d):
    return checks.gaps(moves(spark, d), "game_id", "ply")


@query("SELECT conv_id, CAST(MIN(turn) AS BIGINT) AS min_step, CAST(MAX(turn) AS BIGINT) AS max_step, COUNT(*) AS n_rows, COUNT(DISTINCT turn) AS n_steps FROM conversations GROUP BY conv_id HAVING MIN(turn) <> 0 OR MAX(turn) <> COUNT(*) - 1 OR COUNT(DISTINCT turn) <> COUNT(*)")
def contiguity_conversations(spark, d):
    return checks.gaps(table(spark, d, "conversations"), "conv_id", "turn")


@query("SELECT (SELECT COUNT(*) FROM lineitem) AS expected, (SELECT COUNT(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS observed")
def count_compare(spark, d):
    m, g = table(spark, d, "lineitem").select("l_orderkey"), table(spark, d, "orders").select("o_orderkey")
    return m.agg(F.count("*").alias("expected")).crossJoin(m.join(g, m["l_orderkey"] == g["o_orderkey"]).agg(F.count("*").alias("observed")))


@query("SELECT 'orders' AS relation, COUNT(*) AS n FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem UNION ALL SELECT 'events', COUNT(*) FROM events")
def count_union(spark, d):
    one = lambda n: table(spark, d, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("relation"), "n")
    return one("orders").unionByName(one("lineitem")).unionByName(one("events"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def accepted_values(spark, d):
    return checks.unaccepted(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"])


@query("SELECT CAST(SUM(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_o_orderkey, CAST(SUM(CASE WHEN o_orderdate IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_o_orderdate FROM orders")
def not_null_counts(spark, d):
    return checks.nulls(table(spark, d, "orders"), "o_orderkey", "o_orderdate")


@query("SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem WHERE NOT (CAST(l_quantity AS INTEGER) BETWEEN 5 AND 45)")
def range_guard(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"))
    return rows.filter(~F.col("quantity").between(5, 45))


@query(f"{G} SELECT result, COUNT(*) AS n, MIN(LEAST(white_rating, black_rating)) AS min_rating, MAX(GREATEST(white_rating, black_rating)) AS max_rating, COUNT(DISTINCT white_player) AS players FROM games GROUP BY result")
def profile(spark, d):
    return games(spark, d).groupBy("result").agg(F.count("*").alias("n"), F.min(F.least("white_rating", "black_rating")).alias("min_rating"), F.max(F.greatest("white_rating", "black_rating")).alias("max_rating"), F.countDistinct("white_player").alias("players"))


@query(f"{G} SELECT DISTINCT source_month FROM games")
def distinct_months(spark, d):
    return games(spark, d).select("source_month").distinct()


@query(f"{G}, s AS (SELECT source_month, COUNT(*) AS games FROM games GROUP BY source_month) SELECT COUNT(*) AS shards, CAST(SUM(games) AS BIGINT) AS accepted, MAX(games) AS most_games, CASE WHEN SUM(games) > 0 THEN round(COUNT(*) / SUM(games), 6) ELSE 0 END AS shards_per_game FROM s")
def manifest_rollup(spark, d):
    shards = games(spark, d).groupBy("source_month").agg(F.count("*").alias("games"))
    return shards.agg(F.count("*").alias("shards"), F.sum("games").alias("accepted"), F.max("games").alias("most_games"), F.when(F.sum("games") > 0, F.round(F.count("*") / F.sum("games"), 6)).otherwise(F.lit(0.0)).alias("shards_per_game"))


@query(f"{G}, s AS (SELECT source_month, COUNT(*) AS n FROM games GROUP BY source_month), r AS (SELECT CAST(row_number() OVER (ORDER BY source_month) - 1 AS INTEGER) AS idx, CAST(SUM(n) OVER (ORDER BY source_month) AS BIGINT) - n AS range_start, CAST(SUM(n) OVER (ORDER BY source_month) AS BIGINT) AS range_end FROM s), k AS (SELECT idx, CASE WHEN idx % 10 = 9 THEN range_start + 1 ELSE range_start END AS range_start, range_end FROM r), w AS (SELECT *, lag(range_end, 1, 0) OVER (ORDER BY idx) AS before FROM k) SELECT * FROM w WHERE before <> range_start")
def range_gap(spark, d):
    """Shard ranges of which every tenth starts one too late; a manifest has few rows."""
    from pyspark.sql import Window

    w = Window.orderBy("source_month")
    s = games(spark, d).groupBy("source_month").agg(F.count("*").alias("n"))
    r = s.select((F.row_number().over(w) - 1).alias("idx"), F.sum("n").over(w).alias("range_end"), "n")
    r = r.select("idx", (F.col("range_end") - F.col("n") + F.when(F.col("idx") % 10 == 9, 1).otherwise(0)).alias("range_start"), "range_end")
    return checks.range_gaps(r, "idx", "range_start", "range_end")


@query("SELECT lower(column_name) AS name, lower(column_name) IN ('o_orderstatus', 'o_totalprice') AS forbidden FROM information_schema.columns WHERE table_name = 'orders'")
def catalog_columns(spark, d):
    """From the schema alone; no job reads the table."""
    df = table(spark, d, "orders")
    bad = checks.forbidden_columns(df, {"o_orderstatus", "o_totalprice"})
    return spark.createDataFrame([(c.lower(), c in bad) for c in df.columns], "name string, forbidden boolean")


@query("SELECT l_returnflag, COUNT(*) AS n, CAST(SUM(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY l_returnflag")
def file_list_scan(spark, d):
    """An explicit list of files with a declared schema, which also prunes the columns."""
    from pyspark.sql.types import IntegerType, StringType, StructType

    from plyforge.sources.tables import file_list

    schema = StructType().add("l_returnflag", StringType()).add("l_linenumber", IntegerType())
    return file_list(spark, [f"{d}/lineitem.parquet"], schema).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


@query("SELECT regexp_extract('source_month=' || strftime(o_orderdate, '%Y-%m') || '/part-000000.parquet', 'source_month=([^/\\\\]+)', 1) AS month, COUNT(*) AS n FROM orders GROUP BY 1")
def partition_path_month(spark, d):
    path = F.concat(F.lit("source_month="), F.date_format("o_orderdate", "yyyy-MM"), F.lit("/part-000000.parquet"))
    return table(spark, d, "orders").groupBy(F.regexp_extract(path, r"source_month=([^/\\]+)", 1).alias("month")).agg(F.count("*").alias("n"))
