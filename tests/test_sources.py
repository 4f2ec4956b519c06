import os

import pytest
from pyspark.sql import functions as F

from plyforge import schemas
from plyforge.operators import checks
from plyforge.sources import sinks, tables
from plyforge.streaming import shards
from plyforge.streaming.lock import WriterLock


def test_partitioned_writer_and_path_check(spark, tmp_path):
    df = spark.createDataFrame([(i, f"2013-0{i % 3 + 1}") for i in range(50)], "k long, source_month string")
    sinks.write_partitioned(df, f"{tmp_path}/t", "source_month", ["k"])
    got = spark.read.parquet(f"{tmp_path}/t")
    assert got.count() == 50 and {p for p in os.listdir(tmp_path / "t") if "=" in p} == {f"source_month=2013-0{i}" for i in (1, 2, 3)}
    assert checks.path_partition_mismatch(got, "source_month").count() == 0
    assert got.filter("source_month = '2013-01'").count() == 17


def test_empty_part_keeps_schema(spark, tmp_path):
    df = spark.createDataFrame([], "k long, source_month string")
    sinks.write_empty_part(spark, df, f"{tmp_path}/t", "source_month", "2013-01")
    assert spark.read.parquet(f"{tmp_path}/t").columns == ["k", "source_month"]


def test_publish_reuse_and_tampering(spark, tmp_path):
    df, identity, root = spark.range(10).toDF("k"), {"config": "a", "version": 1}, str(tmp_path)
    first = sinks.publish(spark, root, identity, {"games": df}, lambda t: [])
    assert first["counts"] == {"games": 10} and sinks.publish(spark, root, identity, {"games": df}, lambda t: ["not run"]) == first
    spark.range(3).toDF("k").write.mode("append").parquet(f"{root}/{first['dataset_id']}/games")
    with pytest.raises(ValueError, match="changed"):
        sinks.publish(spark, root, identity, {"games": df}, lambda t: [])


@pytest.mark.parametrize("keep", [True, False])
def test_failed_validation_publishes_nothing(spark, tmp_path, keep):
    identity = {"config": "b"}
    with pytest.raises(ValueError, match="gaps"):
        sinks.publish(spark, str(tmp_path), identity, {"games": spark.range(2).toDF("k")}, lambda t: ["gaps"], keep_failed=keep)
    staged = tmp_path / "staging" / sinks.identity_of(identity)
    assert staged.exists() == keep and not (tmp_path / sinks.identity_of(identity)).exists()


def test_schemas(spark):
    wanted = schemas.of("positions")
    good = spark.createDataFrame([("p", "f", 1)], wanted)
    assert schemas.differences(good, wanted) == [] and schemas.null_violations(good, wanted) == {}
    assert schemas.differences(good.withColumn("occurrences", F.lit(1)).drop("normalized_fen").withColumn("x", F.lit(1)), wanted) == ["missing normalized_fen", "additional x", "occurrences is int, not bigint"]
    assert schemas.null_violations(spark.createDataFrame([(None, "f", 1)], "position_id string, normalized_fen string, occurrences long"), wanted) == {"position_id": 1}
    assert tables.file_list(spark, [], wanted).count() == 0


def test_unsafe_paths_and_flattening():
    for bad in ("", "/a", "../a", "a/../b", "a\\b"):
        with pytest.raises(ValueError):
            sinks.safe_name(bad)
    assert sinks.flattened({"a": {"b": 1, "c": True, "d": [1]}, "e": float("nan"), "f": 2.5}) == {"a.b": 1, "f": 2.5}


def test_shards_resume_exactly_once(spark, tmp_path):
    schema = "game_id string, utc_date string, date string"
    rows = lambda n: spark.createDataFrame([(f"g{n}", "2017.01.14", "2017.01.15"), (f"h{n}", "????", "2017-01-15"), (f"i{n}", "2017.02.31", "????")], schema).coalesce(1)
    run = lambda: shards.process_new(spark, f"{tmp_path}/in", rows(0).schema, f"{tmp_path}/out", f"{tmp_path}/check", most_shards=1)
    rows(0).write.parquet(f"{tmp_path}/in")
    rows(1).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == 2 and run() == 0
    rows(2).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == 1
    out = spark.read.parquet(f"{tmp_path}/out/data")
    assert out.count() == 9 and {(r.played_date, r.date_source) for r in out.collect()} == {("2017-01-14", "utc_date"), ("2017-01-15", "date"), (None, "missing_or_invalid")}
    total = spark.read.parquet(f"{tmp_path}/out/manifest").agg(F.sum("games"), F.sum("missing_or_invalid"), F.count("*")).first()
    assert tuple(total) == (9, 3, 3)
    assert shards.committed_prefix({0, 1, 3}) == 2


def test_lock(tmp_path):
    path = str(tmp_path / "lock")
    with WriterLock(path):
        with pytest.raises(RuntimeError), WriterLock(path):
            pass
    (tmp_path / "lock").write_text('{"pid": 999999999, "started": "1"}')
    with WriterLock(path):
        assert os.path.exists(path)
    assert not os.path.exists(path)
