import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plyforge.functions import board as B
from plyforge.functions import columns as C
from plyforge.functions import pgn
from plyforge.sources import pgn as source


@pytest.mark.parametrize(("fen", "counts"), [
    (B.START, [20, 400, 8902]),
    ("r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1", [48, 2039]),
    ("8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1", [14, 191, 2812]),
    ("rnbq1k1r/pp1Pbppp/2p5/8/2B5/8/PPP1NnPP/RNBQK2R w KQ - 1 8", [44, 1486]),
])
def test_perft(fen, counts):
    assert [B.perft(B.Board(fen), i + 1) for i in range(len(counts))] == counts


# Planes of moves.
PLANES = [
    ("4k3/8/8/8/3Q4/8/8/4K3 w - - 0 1", {"d4d5": 0, "d4e5": 7, "d4e4": 14, "d4e3": 21, "d4d3": 28, "d4c3": 35, "d4c4": 42, "d4c5": 49, "d4d8": 3, "d4h4": 17}),
    ("4k3/8/8/8/3N4/8/8/4K3 w - - 0 1", {"d4e6": 56, "d4f5": 57, "d4f3": 58, "d4e2": 59, "d4c2": 60, "d4b3": 61, "d4b5": 62, "d4c6": 63}),
    ("4k3/8/8/8/8/8/8/R3K2R w KQ - 0 1", {"e1g1": 15, "e1c1": 43}),
    ("r3k2r/8/8/8/8/8/8/4K3 b kq - 0 1", {"e8g8": 15, "e8c8": 43}),
    ("4k3/8/8/3pP3/8/8/8/4K3 w - d6 0 1", {"e5d6": 49}),
    ("1k6/P7/8/8/8/8/8/7K w - - 0 1", {"a7a8n": 67, "a7a8b": 68, "a7a8r": 69}),
    ("1n2k3/P7/8/8/8/8/8/4K3 w - - 0 1", {"a7b8n": 70, "a7b8b": 71, "a7b8r": 72}),
    ("4k3/8/8/8/8/8/7p/6NK b - - 0 1", {"h2g1n": 64, "h2g1b": 65, "h2g1r": 66}),
]


def test_planes_by_board_and_by_columns(spark):
    pairs = [(m, p) for _, moves in PLANES for m, p in moves.items()]
    for fen, moves in PLANES:
        board = B.Board(fen)
        for m, p in moves.items():
            move = B.parse_uci(m)
            assert move in board.legal() and B.encode(move) == move[0] * 73 + p and B.decode(B.encode(move), board) == move
    got = {r.uci: r.i for r in spark.createDataFrame(pairs, "uci string, p int").select("uci", C.move_index(F.col("uci")).alias("i")).collect()}
    assert got == {m: B.encode(B.parse_uci(m)) for m, _ in pairs} and B.encode(B.parse_uci("e2e4")) == 877


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 1000), max_size=40))
def test_round_trips_along_random_games(choices):
    board = B.Board()
    for c in choices:
        legal = sorted(board.legal())
        if not legal:
            break
        assert [B.decode(i, board, legal_only=True) for i in B.legal_indices(board)] and len(B.legal_indices(board)) == len(legal)
        assert all(B.decode(B.encode(m), board) == m for m in legal)
        board.push(legal[c % len(legal)])
        assert B.Board(board.fen()).fen() == board.fen()


def test_normalized_fen_and_tensor():
    assert B.normalized_fen("8/8/8/8/8/8/8/8 w - - 37 81") == "8/8/8/8/8/8/8/8 w - -"
    assert B.normalized_fen("4k3/8/8/8/4P3/8/8/4K3 b - e3 0 1").endswith(" -")
    t = B.tensor(B.Board("8/8/8/8/3pP3/8/8/4K2k b - e3 0 1"))
    assert t[17 * 64 + 2 * 8 + 4] == 1.0 and sum(t[17 * 64 :]) == 1.0 and sum(t[12 * 64 : 13 * 64]) == 0
    t = B.tensor(B.Board("8/8/8/3Q4/8/8/8/4k2K w - - 0 1"))
    assert t[4 * 64 + 4 * 8 + 3] == t[11 * 64 + 4] == t[5 * 64 + 7] == 1.0 and sum(t[12 * 64 : 13 * 64]) == 64
    for bad in ("not-a-fen", "8/8/8/8/8/8/8 w - - 0 1", "9/8/8/8/8/8/8/8 w - - 0 1"):
        with pytest.raises(ValueError):
            B.Board(bad)


@pytest.mark.parametrize(("text", "code"), [
    ('[Event "x"]\n[FEN "not-a-fen"]\n\n1. e4 *', "invalid_fen"), ('[Event "x"]\n\n1. e5 *', "illegal_move"), ('[Event "x"]\n[Variant "Crazyhouse"]\n\n1. e4 *', "unsupported_variant"), ('[Event "x"]\n\n*', "empty_game"), ("", "pgn_parse_error"),
])
def test_rejections(text, code):
    with pytest.raises(pgn.Rejected) as e:
        pgn.parse_game(text)
    assert e.value.code == code


def test_main_line_skips_comments_and_variations():
    game = pgn.parse_game('[Event "x"]\n[Result "1-0"]\n\n1. e4 {[%clk 0:03:00] a (b)} e5 $1 (1... c5 2. Nf3 (2. c3)) 2. Nf3! ; rest\n 2... Nc6 3. Bb5 a6 4. O-O?? 1-0')
    assert [m["uci"] for m in game["moves"]] == ["e2e4", "e7e5", "g1f3", "b8c6", "f1b5", "a7a6", "e1g1"]
    assert game["moves"][0]["clock"] == "0:03:00" and pgn.is_complete(game)


def test_archive_to_records(spark, tmp_path):
    games = ['[Event "a"]\n[White "Ann"]\n[Black " "]\n[WhiteElo "1500"]\n[BlackElo "?"]\n[Result "1-0"]\n\n1. Nf3 Nf6 2. Ng1 Ng8 3. Nf3 Nf6 1-0\n\n', '[Event "b"]\n\n1. e5 *\n\n', '[Event "c"]\n[Result "*"]\n\n1. e4 {[Event trap] in a line} *\n']
    path = tmp_path / "db_2013-01.pgn"
    path.write_text("".join(games))
    raw = source.raw_games(spark, str(path))
    assert [r.text.strip() for r in raw.orderBy("local_index").collect()] == [g.strip() for g in games]
    assert source.raw_games(spark, str(path), max_games=0).count() == 0
    with pytest.raises(ValueError):
        source.raw_games(spark, str(path), max_games=-1)
    out = source.records(source.parsed(raw), "sha", "2013-01", offset=10)
    (game,) = out["games"].collect()
    assert (game.white_rating, game.black_rating, game.ply_count, game.source_game_index, game.black_player_hash) == (1500, None, 6, 10, None)
    assert out["moves"].count() == 6 and out["positions"].count() == 4
    assert {r.error_code for r in out["ingestion_errors"].collect()} == {"illegal_move", "incomplete_game"}


def test_audit_evaluates_a_position_once(spark, sf_dir):
    from plyforge.plans import QUERIES

    for name in ("chess_legality_audit", "chess_context"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("[_walk(") == 1 and plan.count("ArrowEvalPython [") == 2 and plan.count("_walk(") == 1
    assert QUERIES["chess_legality_audit"](spark, sf_dir).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("pnbrqkPNBRQK" + "." * 24), min_size=64, max_size=64), st.booleans(), st.sampled_from([None, 16, 20, 40, 43]))
def test_legal_moves_by_shields_are_those_by_trial(cells, white, ep):
    board = B.Board()
    board.cells, board.white, board.ep = cells, white, ep
    assert board.legal() == [m for m in board.candidates() if board.is_legal(m)]


def test_legal_moves_try_only_what_may_expose_the_king(monkeypatch):
    tried = []
    trial = B.Board.is_legal
    monkeypatch.setattr(B.Board, "is_legal", lambda self, move: tried.append(move) or trial(self, move))
    assert len(B.Board("r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1").legal()) == 48 and len(tried) <= 8
