"""Fixed, versioned schemas; a dataset's files must equal them in names and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

SCHEMA_VERSION = "1.2.0"


def _schema(required: str, optional: str = "") -> StructType:
    fields = [StructField(f.name, f.dataType, False) for f in _parse_datatype_string(required).fields] if required else []
    return StructType(fields + ([StructField(f.name, f.dataType, True) for f in _parse_datatype_string(optional).fields] if optional else []))


GAMES = ("game_id string, source_game_index long, source_month string, result string, ply_count int", "played_date string, white_player_hash string, black_player_hash string, white_rating int, black_rating int, time_control_raw string, eco string, opening string, termination string")
MOVES = ("game_id string, source_month string, ply int, san string, played_move_uci string, pre_move_fen string, normalized_pre_move_fen string, position_id string, side_to_move string", "clock string")
POSITIONS = ("position_id string, normalized_fen string, occurrences long", "")
ERRORS = ("game_id string, source_game_index long, source_month string, error_code string", "message string")
TABLES = {"games": GAMES, "moves": MOVES, "positions": POSITIONS, "ingestion_errors": ERRORS}


def of(name: str) -> StructType:
    """Needs an active session, which parses the types."""
    return _schema(*TABLES[name])


def differences(df: DataFrame, wanted: StructType) -> list[str]:
    """Names and types that are missing, additional or different; no job runs. Files don't carry nullability."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in wanted}
    out = [f"missing {n}" for n in want if n not in have] + [f"additional {n}" for n in have if n not in want]
    return out + [f"{n} is {have[n].simpleString()}, not {t.simpleString()}" for n, t in want.items() if n in have and have[n] != t]


def null_violations(df: DataFrame, wanted: StructType) -> dict[str, int]:
    """Nulls in required columns, counted in one pass."""
    required = [f.name for f in wanted if not f.nullable]
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
    return {c: row[c] for c in required if row[c]}
