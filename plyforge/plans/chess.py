"""Board-aware functions over positions that the driver's keys pick; they have no SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from plyforge.functions import board as B
from plyforge.functions import chess_udf as U
from plyforge.functions import columns as C
from plyforge.functions.identity import position_id
from plyforge.plans.registry import query
from plyforge.sources.tables import table


#: Legal moves after up to three moves; there are 9323 such games.
_openings: dict[tuple[int, ...], list[B.Move]] = {}


@F.pandas_udf(StringType())
def _walk(keys: pd.Series) -> pd.Series:
    """A position reached by up to 24 legal moves that the key chooses."""

    def one(key):
        board, state, path = B.Board(), int(key), ()
        for _ in range(int(key) % 25):
            legal = _openings.get(path)
            if legal is None:
                legal = sorted(board.legal())
                if len(path) <= 3:
                    _openings[path] = legal
            if not legal:
                break
            state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
            at = (state >> 33) % len(legal)
            board.push(legal[at])
            path = (*path, at) if len(path) <= 3 else path
        return board.fen()

    return keys.map(one)


# Marked so that the optimizer doesn't call them once for a filter and again for each column above it.
_walk = _walk.asNondeterministic()
_legal = F.pandas_udf(U.legal_actions.func, U.legal_actions.returnType).asNondeterministic()


def _positions(spark, d):
    # Few bytes a row and much work: the rows go over all cores before the Arrow function.
    rows = table(spark, d, "customer").select("c_custkey").repartition(spark.sparkContext.defaultParallelism)
    return rows.select("c_custkey", _walk("c_custkey").alias("fen"))


@query()
def chess_positions(spark, d):
    rows = _positions(spark, d).withColumn("normalized", U.normalize_fen("fen"))
    return rows.select("c_custkey", "normalized", position_id(F.col("normalized")).alias("position_id"))


@query()
def chess_candidates(spark, d):
    rows = _positions(spark, d).select("c_custkey", F.explode(U.candidates("fen")).alias("m"))
    return rows.select("c_custkey", "m.*", C.move_index(F.col("m.uci")).alias("index_by_columns"))


@query()
def chess_context(spark, d):
    rows = _positions(spark, d).withColumn("context", U.position_context("fen"))
    material = (C.material(F.col("fen"), True) - C.material(F.col("fen"), False)).alias("material_balance")
    return rows.select("c_custkey", "context.*", material, C.castling_flag(F.col("fen"), "K").alias("white_short"))


@query()
def chess_legality_audit(spark, d):
    """Rows whose target isn't among the legal actions; none is expected."""
    rows = _positions(spark, d).select("c_custkey", _legal("fen").alias("legal"))
    # One filter: the target of a position without moves is null, and so is the condition.
    rows = rows.withColumn("target", F.get("legal", F.lit(0)))
    return rows.filter(~F.array_contains("legal", F.col("target"))).select("c_custkey", "target")


@query()
def chess_tensor(spark, d):
    rows = _positions(spark, d).select("c_custkey", U.board_tensor("fen").alias("t"))
    return rows.select("c_custkey", F.size("t").alias("size"), F.aggregate(F.slice("t", 1, 768), F.lit(0.0), lambda a, x: a + x).cast("int").alias("pieces"))
