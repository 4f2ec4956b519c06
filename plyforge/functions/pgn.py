"""PGN text to typed records, or to one error with its reason."""

from __future__ import annotations

import re
from typing import Any

from plyforge.functions.board import START, Board, uci

HEADER = re.compile(r'^\[(\w+)\s+"((?:[^"\\]|\\.)*)"\]\s*$', re.M)
RESULTS = ("1-0", "0-1", "1/2-1/2", "*")
ERRORS = ("pgn_parse_error", "unsupported_variant", "invalid_fen", "illegal_move", "empty_game", "incomplete_game")
TOKEN = re.compile(r"\{[^}]*\}|;[^\n]*|\(|\)|\$\d+|[^\s{}();]+")
CLOCK = re.compile(r"\[%clk\s+([^\]]+)\]")


class Rejected(Exception):
    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


def headers_of(text: str) -> dict[str, str]:
    return {k: re.sub(r"\\(.)", r"\1", v) for k, v in HEADER.findall(text)}


def main_line(text: str) -> list[tuple[str, str | None]]:
    """(move, clock) of the main line; comments, variations, glyphs, numbers and the result are skipped."""
    body = HEADER.sub("", text)
    depth, out = 0, []
    for token in TOKEN.findall(body):
        if token == "(":
            depth += 1
        elif token == ")":
            depth = max(0, depth - 1)
        elif depth or token[0] in ";$":
            continue
        elif token[0] == "{":
            if out and (m := CLOCK.search(token)):
                out[-1] = (out[-1][0], m[1])
        else:
            token = re.sub(r"^\d+\.+", "", token)
            if token and token not in RESULTS and not re.fullmatch(r"\d+|[!?]+", token):
                out.append((token, None))
    return out


def parse_game(text: str) -> dict[str, Any]:
    """{headers, result, moves: [{ply, san, uci, fen_before, position, clock, side}]}; raises Rejected.

    Order of checks: text, variant, start position, moves, emptiness.
    """
    headers = headers_of(text)
    if not headers and not main_line(text):
        raise Rejected("pgn_parse_error", "neither headers nor moves")
    if headers.get("Variant", "Standard") not in ("Standard", "Chess", ""):
        raise Rejected("unsupported_variant", headers["Variant"])
    try:
        board = Board(headers.get("FEN", START))
    except ValueError as e:
        raise Rejected("invalid_fen", str(e)) from e
    moves = []
    for ply, (san, clock) in enumerate(main_line(text)):
        try:
            move = board.san(san)
        except ValueError as e:
            raise Rejected("illegal_move", str(e)) from e
        moves.append({"ply": ply, "san": san, "uci": uci(move), "fen_before": board.fen(), "position": board.fen4(), "clock": clock, "side": "w" if board.white else "b"})
        board.push(move)
    if not moves:
        raise Rejected("empty_game", "no moves")
    return {"headers": headers, "result": headers.get("Result", "*"), "moves": moves}


def is_complete(game: dict[str, Any]) -> bool:
    return game["result"] in RESULTS[:3] and bool(game["moves"])
