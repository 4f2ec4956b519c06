import io

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from plyforge.operators import selection
from plyforge.sources import sharding
from plyforge.sources.pgn import raw_games

GAMES = [f'[Event "g{i}"]\n[Result "{r}"]\n[White "n{i}"]\n\n1. e4 {{a [Event trap] in a line}} {r}\n\n'.encode() for i, r in enumerate(["1-0", "*", "0-1", "1/2-1/2", "1-0"])]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 64), st.sampled_from([b"", b"\xef\xbb\xbf", b"junk before\n"]))
def test_split_is_lossless_for_any_chunk(chunk, before):
    assert list(sharding.iter_game_bytes(io.BytesIO(before + b"".join(GAMES)), chunk)) == GAMES


def test_limits_and_empty_streams(tmp_path):
    assert list(sharding.iter_game_bytes(io.BytesIO(b""))) == [] and list(sharding.iter_game_bytes(io.BytesIO(b"no game"))) == []
    with pytest.raises(ValueError):
        list(sharding.iter_game_bytes(io.BytesIO(b'[Event "x"]\n' + b"a" * 300), 50, 200))
    (tmp_path / "a.pgn.zst").write_bytes(zstandard.compress(b"".join(GAMES[:2])) + zstandard.compress(b"".join(GAMES[2:])))
    assert sharding.count_zst_games(str(tmp_path / "a.pgn.zst")) == 5
    (tmp_path / "bad.zst").write_bytes(b"not compressed")
    with pytest.raises(zstandard.ZstdError):
        sharding.count_zst_games(str(tmp_path / "bad.zst"))


def test_shards_and_their_manifest(spark, tmp_path):
    (tmp_path / "a.pgn").write_bytes(b"".join(GAMES))
    rows = sharding.write_shards(spark, str(tmp_path / "a.pgn"), str(tmp_path / "out"), 2).orderBy("idx").collect()
    assert [(r.idx, r.range_start, r.range_end, r.games) for r in rows] == [(0, 0, 2, 2), (1, 2, 4, 2), (2, 4, 5, 1)]
    whole = sorted(r.text.strip() for r in raw_games(spark, str(tmp_path / "out")).collect())
    assert whole == sorted(g.decode().strip() for g in GAMES)
    sample = sharding.fixture(raw_games(spark, str(tmp_path / "a.pgn")), 2).collect()
    assert [r.local_index for r in sample] == [0, 2] and all('[White "?"]' in r.text for r in sample)


def test_selection(spark):
    df = spark.range(100).toDF("k")
    a = [r.k for r in selection.hash_selected(df, ["k"], "s", 10).collect()]
    assert a == [r.k for r in selection.hash_selected(df.repartition(7), ["k"], "s", 10).collect()] and len(set(a)) == 10
    assert a != [r.k for r in selection.hash_selected(df, ["k"], "s", 10, "other").collect()] and selection.hash_selected(df, ["k"], "s", 0).count() == 100
    assert selection.fingerprint([(1, 2), (3, 4)]) != selection.fingerprint([(3, 4), (1, 2)])
    assert selection.compatible({"dataset_id": 1, "seed": 2, "fingerprint": 3}, {"dataset_id": 1, "seed": 2}) == ["fingerprint"]
    assert selection.candidate_rows(10, 4)["rows"] == 50 and selection.candidate_rows(10, None)["rows"] == 2180
