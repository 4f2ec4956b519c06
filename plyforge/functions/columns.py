"""Column expressions for dates, splits, labels, bands and positions. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bands, phases and piece weights.
RATING_BANDS = ((1200, "lt_1200"), (1600, "1200_1599"), (2000, "1600_1999"))
TIME_CONTROLS = ((180, "bullet"), (480, "blitz"), (1500, "rapid"))
PIECE_VALUES = {"p": 1, "n": 3, "b": 3, "r": 5, "q": 9}


def blank_to_null(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed != "", trimmed)


def header_int(text: Column) -> Column:
    """A whole number, or null for blank, ``?`` and anything else."""
    return F.trim(text).try_cast("int")


def month_of_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2})", 1), F.lit(""))


def clock_of_comment(comment: Column) -> Column:
    return F.nullif(F.regexp_extract(comment, r"\[%clk\s+([^\]]+)\]", 1), F.lit(""))


def played_date(text: Column) -> Column:
    """struct(day, problem): problem is null, ``missing`` or ``invalid``; dots or dashes, padded or not."""
    t = F.trim(text)
    day = F.coalesce(F.try_to_date(t, "yyyy.M.d"), F.try_to_date(t, "yyyy-M-d"))
    missing, unclear = t.isNull() | (t == ""), t.contains("?")
    return F.struct(
        F.when(~missing & ~unclear, day).alias("day"),
        F.when(missing, "missing").when(unclear | day.isNull(), "invalid").alias("problem"),
    )


def strict_date(text: Column) -> Column:
    """Padded dates only, dots and dashes may mix; null otherwise."""
    return F.when(text.rlike(r"^\d{4}[.-]\d{2}[.-]\d{2}$"), F.try_to_date(F.replace(text, F.lit("."), F.lit("-")), "yyyy-MM-dd"))


def canonical_date(utc: Column, local: Column) -> Column:
    """struct(day, source): the UTC date if valid, else the local one, else ``missing_or_invalid``."""
    u, d = strict_date(utc), strict_date(local)
    return F.struct(F.coalesce(u, d).alias("day"), F.when(u.isNotNull(), "utc_date").when(d.isNotNull(), "date").otherwise("missing_or_invalid").alias("source"))


def check_ranges(ranges: Sequence[tuple[str, date, date]]) -> None:
    """Each range starts before it ends and after the one before it."""
    for name, start, end in ranges:
        if start > end:
            raise ValueError(f"range {name} ends before it starts")
    for (a, _, end), (b, start, _) in zip(ranges, ranges[1:], strict=False):
        if end >= start:
            raise ValueError(f"ranges {a} and {b} overlap or are out of order")


def temporal_split(parsed: Column, ranges: Sequence[tuple[str, date, date]], assign_to: str | None = None) -> Column:
    """struct(split, reason) of a ``played_date``. A day outside all ranges has no split, even under a policy."""
    check_ranges(ranges)
    day, problem = parsed["day"], parsed["problem"]
    split = F.when(problem.isNotNull(), F.lit(assign_to))
    for name, start, end in ranges:
        split = split.when(day.between(F.lit(start), F.lit(end)), F.lit(name))
    bad = F.lit("policy_assigned_missing_or_invalid") if assign_to else F.concat(problem, F.lit("_date"))
    return F.struct(split.alias("split"), F.when(problem.isNotNull(), bad).when(split.isNotNull(), "date_interval").otherwise("outside_declared_ranges").alias("reason"))


def value_label(side: Column, result: Column) -> Column:
    """win, draw or loss for the side to move; null where side or result is unknown."""
    won = ((side == "w") & (result == "1-0")) | ((side == "b") & (result == "0-1"))
    lost = ((side == "w") & (result == "0-1")) | ((side == "b") & (result == "1-0"))
    return F.when(side.isin("w", "b") & (result == "1/2-1/2"), "draw").when(won, "win").when(lost, "loss")


def by_side(side: Column, white: Column, black: Column, strict: bool = False) -> Column:
    """The mover's value; an unknown side gives null, or raises where ``strict``."""
    out = F.when(side == "w", white).when(side == "b", black)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown side: "), F.coalesce(side, F.lit("null"))))) if strict else out


def rating_band(rating: Column) -> Column:
    out = F.when(rating.isNull(), "unknown")
    for below, name in RATING_BANDS:
        out = out.when(rating < below, name)
    return out.otherwise("gte_2000")


def time_control(raw: Column) -> Column:
    """By the base seconds before ``+``."""
    base = F.when(raw.contains("+"), F.trim(F.split_part(raw, F.lit("+"), F.lit(1))).try_cast("int"))
    out = F.when(base.isNull(), "unknown")
    for below, name in TIME_CONTROLS:
        out = out.when(base < below, name)
    return out.otherwise("classical")


def opening_family(code: Column) -> Column:
    return F.coalesce(F.nullif(F.substring(F.upper(F.trim(code)), 1, 1), F.lit("")), F.lit("unknown"))


def board_of(fen: Column) -> Column:
    return F.split_part(fen, F.lit(" "), F.lit(1))


def game_phase(fen: Column, ply: Column) -> Column:
    pieces = F.length(F.regexp_replace(board_of(fen), "[^nbrqNBRQ]", ""))
    return F.when((pieces >= 12) & (ply < 40), "opening").when(pieces >= 6, "middlegame").otherwise("endgame")


def material(fen: Column, white: bool) -> Column:
    board = board_of(fen)
    terms = [F.regexp_count(board, F.lit(p.upper() if white else p)) * v for p, v in PIECE_VALUES.items()]
    return sum(terms[1:], terms[0])


def castling_flag(fen: Column, right: str) -> Column:
    return F.split_part(fen, F.lit(" "), F.lit(3)).contains(right)


def fen_part(fen: Column, part: int) -> Column:
    return F.split_part(fen, F.lit(" "), F.lit(part))


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Probabilities of an array of scores, with the largest subtracted first."""
    if not temperature > 0:
        raise ValueError("temperature must be positive")
    raised = F.transform(logits, lambda x: F.exp((x - F.array_max(logits)) / temperature))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, y: a + y))


def argmax(values: Column) -> Column:
    """Place of the largest value from 0, the first of equal ones."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def move_index(uci: Column) -> Column:
    """``from * 73 + plane`` of a move in coordinates: 56 sliding planes (direction, distance), 8 knight
    planes and 9 underpromotions. Raises for moves that no plane stands for."""
    file = lambda i: F.ascii(F.substring(uci, i, 1)) - F.ascii(F.lit("a"))
    rank = lambda i: F.ascii(F.substring(uci, i, 1)) - F.ascii(F.lit("1"))
    df, dr = file(3) - file(1), rank(4) - rank(2)
    under = F.array_position(F.array(*[F.lit(x) for x in "nbr"]), F.substring(uci, 5, 1))
    # Directions clockwise from north, and knight steps in the same manner.
    slides = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))
    knights = ((1, 2), (2, 1), (2, -1), (1, -2), (-1, -2), (-2, -1), (-2, 1), (-1, 2))
    place = lambda steps, reach: F.array(*[F.lit(steps.index((f, r)) if (f, r) in steps else None).cast("int") for f in range(-reach, reach + 1) for r in range(-reach, reach + 1)])
    far = F.greatest(F.abs(df), F.abs(dr))
    slide = F.get(place(slides, 1), (F.signum(df).cast("int") + 1) * 3 + F.signum(dr).cast("int") + 1)
    hop = F.get(place(knights, 2), (df + 2) * 5 + dr + 2)
    plane = F.when(under > 0, F.when((F.abs(df) <= 1) & (F.abs(dr) == 1), 64 + (df + 1) * 3 + under - 1))
    plane = plane.when((df == 0) | (dr == 0) | (F.abs(df) == F.abs(dr)), F.when(far > 0, slide * 7 + far - 1)).when(far <= 2, 56 + hop)
    index = ((rank(2) * 8 + file(1)) * 73 + plane).cast("int")
    return F.when(uci.rlike("^[a-h][1-8][a-h][1-8][nbrq]?$") & plane.isNotNull(), index).otherwise(F.raise_error(F.concat(F.lit("no plane for move "), F.coalesce(uci, F.lit("null")))).cast("int"))
