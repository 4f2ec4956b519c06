"""Arrow functions over positions; everything else is a column expression."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, FloatType, IntegerType, StringType, StructType

from plyforge.functions import board as B



def _struct(**fields: DataType) -> StructType:
    """Types are objects, not text, so that importing needs no session."""
    out = StructType()
    for name, kind in fields.items():
        out = out.add(name, kind)
    return out


@F.pandas_udf(StringType())
def normalize_fen(fens: pd.Series) -> pd.Series:
    return fens.map(lambda f: None if f is None else B.normalized_fen(f))


@F.pandas_udf(ArrayType(FloatType()))
def board_tensor(fens: pd.Series) -> pd.Series:
    return fens.map(lambda f: None if f is None else B.tensor(B.Board(f)))


@F.pandas_udf(ArrayType(IntegerType()))
def legal_actions(fens: pd.Series) -> pd.Series:
    return fens.map(lambda f: None if f is None else B.legal_indices(B.Board(f)))


@F.pandas_udf(StringType())
def decode_action(fens: pd.Series, actions: pd.Series) -> pd.Series:
    return pd.Series([None if f is None or pd.isna(a) else B.uci(B.decode(int(a), B.Board(f))) for f, a in zip(fens, actions, strict=True)], dtype=object)


@F.pandas_udf(_struct(value=IntegerType(), error=StringType()))
def policy_target(fens: pd.Series, moves: pd.Series) -> pd.DataFrame:
    """The action of a played move, or why there is none: it must be legal and decode to itself."""

    def one(fen, text):
        try:
            board, move = B.Board(fen), B.parse_uci(text)
            if move not in board.legal():
                return None, "illegal_move"
            index = B.encode(move)
            return (index, None) if B.decode(index, board) == move else (None, "round_trip")
        except (ValueError, TypeError, AttributeError):
            return None, "unreadable"

    return pd.DataFrame([one(f, m) for f, m in zip(fens, moves, strict=True)], columns=["value", "error"]).astype({"value": "Int32"})


FEATURES = list(B.move_features(B.Board(), B.parse_uci("e2e4")))
CANDIDATE = ArrayType(_struct(action=IntegerType(), uci=StringType(), **{k: IntegerType() for k in FEATURES}))


@F.pandas_udf(CANDIDATE)
def candidates(fens: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """All legal moves of a position by action, with their features."""
    for batch in fens:
        out = []
        for fen in batch:
            board = B.Board(fen)
            out.append([{"action": i, "uci": B.uci(m), **B.move_features(board, m)} for i, m in sorted((B.encode(m), m) for m in board.legal())])
        yield pd.Series(out, dtype=object)


PAWNS = [f"{side}_{k}" for side in ("white", "black") for k in B.pawn_structure(B.Board(), True)]
CONTEXT = _struct(legal_moves=IntegerType(), in_check=BooleanType(), **{k: IntegerType() for k in PAWNS})


@F.pandas_udf(CONTEXT)
def position_context(fens: pd.Series) -> pd.DataFrame:
    def one(fen):
        board = B.Board(fen)
        return {"legal_moves": len(board.legal()), "in_check": board.in_check(), **{f"{side}_{k}": v for side in ("white", "black") for k, v in B.pawn_structure(board, side == "white").items()}}

    return pd.DataFrame([one(f) for f in fens])
