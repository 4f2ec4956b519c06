"""Ordinals of games over blocks and shards, and partitioned, resumable bronze."""

import pytest

from plyforge.plans import build
from plyforge.sources import pgn


def game(i, result="1-0", moves="1. e4 e5"):
    return f'[Event "g{i}"]\n[Site "{"x" * (i % 37)}"]\n[White "w{i}"]\n[Black "b{i}"]\n[UTCDate "2013.01.05"]\n[Result "{result}"]\n\n{moves} {result}\n\n'


@pytest.mark.parametrize("preamble", ["", "; kept by nobody\n\n", "\ufeff"])
def test_ordinals_hold_where_a_file_is_split(spark, tmp_path, preamble):
    (tmp_path / "a.pgn").write_text(preamble + "".join(map(game, range(400))))
    (tmp_path / "b.pgn").write_text("".join(map(game, range(400, 450))))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = pgn.raw_games(spark, [str(tmp_path / "a.pgn"), str(tmp_path / "b.pgn")])
        assert rows.rdd.getNumPartitions() > 1
        got = sorted((r.run_index, r.local_index, r.text) for r in rows.collect())
        first = pgn.raw_games(spark, [str(tmp_path / "a.pgn"), str(tmp_path / "b.pgn")], max_games=410)
        assert sorted(r.run_index for r in first.collect()) == list(range(410))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r[0] for r in got] == list(range(450)) and [r[1] for r in got] == [*range(400), *range(50)]
    assert all(f'"g{i}"' in text.split("\n")[0] for i, _, text in got)


def test_shards_make_distinct_and_stable_games(spark, tmp_path):
    whole, names = "".join(map(game, range(8))) + game(8, "*", ""), []
    (tmp_path / "whole.pgn").write_text(whole)
    for k in range(2):
        names.append(str(tmp_path / f"part-{k}.pgn"))
        (tmp_path / f"part-{k}.pgn").write_text("".join(map(game, range(4 * k, 4 * k + 4))))
    ids = lambda paths, offset=0: {r.source_game_index: r.game_id for r in pgn.records(pgn.parsed(pgn.raw_games(spark, paths)), "sha", "2013-01", offset)["games"].collect()}
    want = ids([str(tmp_path / "whole.pgn")])
    assert len(set(want.values())) == 8 and ids(names) == want and ids(names[1:], 4) == {i: want[i] for i in range(4, 8)}
    manifest = build.ingest(spark, names, str(tmp_path / "out"), "sha", "2013-01", lock=str(tmp_path / "lock"))
    assert manifest["counts"]["games"] == 8 and manifest["counts"]["ingestion_errors"] == 0 and not (tmp_path / "lock").exists()
    root = tmp_path / "out" / manifest["dataset_id"]
    assert {p.name for p in (root / "moves").iterdir() if p.is_dir()} == {"source_month=2013-01"} == {p.name for p in (root / "ingestion_errors").iterdir() if p.is_dir()}
    assert spark.read.parquet(str(root / "ingestion_errors")).columns[-1] == "source_month"
    assert build.ingest(spark, names, str(tmp_path / "out"), "sha", "2013-01") == manifest
    games = spark.read.parquet(str(root / "positions"))
    changed = games.withColumn("occurrences", games.occurrences + 1).collect()
    spark.createDataFrame(changed, games.schema).write.mode("overwrite").parquet(str(root / "positions"))
    with pytest.raises(ValueError, match="positions .* has changed"):
        build.ingest(spark, names, str(tmp_path / "out"), "sha", "2013-01")
