from dataclasses import dataclass
from datetime import date

import pytest

from plyforge.__main__ import main
from plyforge.plans import build
from plyforge.sources import config

GAMES = [("2013.01.05", "1-0", "e4 e5"), ("2013.01.24", "0-1", "d4 d5"), ("2013.01.29", "1/2-1/2", "c4 e5")]
TEXT = "".join(f'[Event "g"]\n[White "w{i}"]\n[Black "b{i}"]\n[WhiteElo "{1500 + i}"]\n[BlackElo "1400"]\n[UTCDate "{d}"]\n[TimeControl "300+0"]\n[Result "{r}"]\n\n1. {m} {r}\n\n' for i, (d, r, m) in enumerate(GAMES))
CONFIG = build.DatasetConfig("seed", 10_000, 10_000, 0, 100, (("train", date(2013, 1, 1), date(2013, 1, 20)), ("validation", date(2013, 1, 21), date(2013, 1, 26)), ("test", date(2013, 1, 27), date(2013, 1, 31))), "train")


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("bronze")
    (root / "db_2013-01.pgn").write_text(TEXT + '[Event "bad"]\n\n1. e5 *\n')
    manifest = build.ingest(spark, [str(root / "db_2013-01.pgn")], str(root / "out"), "sha", "2013-01")
    assert manifest["counts"] == {"games": 3, "moves": 6, "positions": 4, "ingestion_errors": 1}
    assert build.ingest(spark, [str(root / "db_2013-01.pgn")], str(root / "out"), "sha", "2013-01") == manifest
    read = lambda n: spark.read.parquet(f"{root}/out/{manifest['dataset_id']}/{n}")
    return root, read("games"), read("moves")


def test_strict_ingestion_stops(spark, bronze):
    with pytest.raises(ValueError, match="1 games were rejected"):
        build.ingest(spark, [str(bronze[0] / "db_2013-01.pgn")], str(bronze[0] / "other"), "sha", "2013-01", strict=True)


def test_gaps_are_found(bronze):
    _, games, moves = bronze
    tables = {"games": games, "moves": moves.filter("ply <> 0")}
    assert any("gaps in plies" in p for p in build.bronze_problems(tables))


def test_dataset(spark, bronze, tmp_path):
    _, games, moves = bronze
    out = build.build_dataset(spark, games, moves, str(tmp_path), "up", CONFIG)
    assert out["counts"] == {"game_assignments": 3, "policy_examples": 7} and out["rejects"] == {}
    assert {r["temporal_split"]: r["n_rows"] for r in out["audit"]["splits"]} == {"train": 2, "validation": 2, "test": 2}
    rows = spark.read.parquet(f"{tmp_path}/{out['dataset_id']}/policy_examples")
    assert {r.policy_target for r in rows.filter("temporal_split = 'train' AND ply = 0").collect()} == {877}
    assert rows.filter("temporal_split = 'novel_position_test'").count() == 1
    assert {(r.side_to_move, r.value_label) for r in rows.filter("temporal_split = 'train'").collect()} == {("w", "win"), ("b", "loss")}
    model = build.value_baseline(rows)
    assert model.transform(rows.na.fill({"rating_difference": 0})).count() == 7


def test_illegal_targets_are_rejected_with_a_reason(spark, bronze):
    from pyspark.sql import functions as F

    _, games, moves = bronze
    bad = moves.withColumn("played_move_uci", F.when(F.col("ply") == 0, "e7e5").otherwise(F.col("played_move_uci")))
    rows = build.policy_examples(bad, build.assign_games(games, CONFIG))
    assert {r.reject_reason for r in rows.filter("ply = 0").collect()} == {"illegal_move"}


@dataclass
class Inner:
    seed: str


@dataclass
class Outer:
    inner: Inner
    limit: int
    out_path: str = "x"


def test_strict_configuration(tmp_path):
    ok = config.typed(Outer, {"inner": {"seed": "s"}, "limit": 3})
    assert ok.inner.seed == "s" and config.configuration_hash(ok) == config.configuration_hash(config.typed(Outer, {"limit": 3, "inner": {"seed": "s"}}))
    for bad in ({"inner": {"seed": "s"}}, {"inner": {"seed": 1}, "limit": 3}, {"inner": {"seed": "s"}, "limit": True}, {"inner": {"seed": "s"}, "limit": 3, "z": 1}, {"inner": {"seed": "s"}, "limit": 3, "out_path": "../x"}):
        with pytest.raises(config.ConfigError):
            config.typed(Outer, bad)
    (tmp_path / "c.yaml").write_text("a: 1\n")
    assert config.read_document(str(tmp_path / "c.yaml")) == {"a": 1}
    assert config.file_sha256(str(tmp_path / "c.yaml")) == config.hashlib.sha256(b"a: 1\n").hexdigest()
    assert config.estimated_bytes(1000, 10, 100) == 13_000
    assert config.provenance_problems("full", {"g": 3}, {"g": 4}) and not config.provenance_problems("sample", {"g": 3}, {"g": 4})
    with pytest.raises(config.ConfigError):
        config.resolved_root(None, "PLYFORGE_NO_SUCH", [str(tmp_path), "/tmp"])


def test_command_line(capsys, tmp_path):
    assert main(["estimate", "1000", "10", "100"]) == 0 and main(["queries"]) == 0
    assert "mart_case_rating" in capsys.readouterr().out
    (tmp_path / "db_2013-01.pgn").write_text(TEXT)
    assert main(["ingest", str(tmp_path / "db_2013-01.pgn"), str(tmp_path / "o"), "--dry-run"]) == 0
    assert '"month": "2013-01"' in capsys.readouterr().out
