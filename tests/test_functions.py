import hashlib
import hmac
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plyforge.functions import columns as C
from plyforge.functions import identity as I
from plyforge.operators import leakage
from plyforge.operators import metrics as M


def one(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_labels_bands_and_controls(spark):
    rows = [("w", "1-0"), ("w", "0-1"), ("b", "1-0"), ("b", "0-1"), ("w", "1/2-1/2"), ("x", "1-0")]
    assert one(spark, "s string, r string", rows, C.value_label(F.col("s"), F.col("r"))) == [("win",), ("loss",), ("loss",), ("win",), ("draw",), (None,)]
    assert one(spark, "r int", [(1199,), (1599,), (1700,), (2000,), (None,)], C.rating_band(F.col("r"))) == [("lt_1200",), ("1200_1599",), ("1600_1999",), ("gte_2000",), ("unknown",)]
    assert one(spark, "t string", [("60+0",), ("180+2",), ("600+0",), ("1800+0",), (None,), ("-",), (" 300 +0",)], C.time_control(F.col("t"))) == [("bullet",), ("blitz",), ("rapid",), ("classical",), ("unknown",), ("unknown",), ("blitz",)]
    assert one(spark, "s string, w int, b int", [("w", 1700, 1500), ("q", 1, 2)], C.by_side(F.col("s"), F.col("w"), F.col("b"))) == [(1700,), (None,)]
    with pytest.raises(Exception, match="unknown side"):
        one(spark, "s string, w int, b int", [("q", 1, 2)], C.by_side(F.col("s"), F.col("w"), F.col("b"), strict=True))


def test_dates_and_splits(spark):
    rows = [("2013.01.07",), ("2013-01-08",), ("2017.1.5",), ("????.??.??",), (None,), ("",), ("2013.02.31",)]
    assert [(str(d) if d else None, p) for d, p in one(spark, "t string", rows, C.played_date(F.col("t"))["day"], C.played_date(F.col("t"))["problem"])] == [("2013-01-07", None), ("2013-01-08", None), ("2017-01-05", None), (None, "invalid"), (None, "missing"), (None, "missing"), (None, "invalid")]
    both = [("2017.01.14", "2017.01.15"), ("????", "2017.01.15"), ("2017.02.31", "????"), ("2017-01.05", None)]
    c = C.canonical_date(F.col("u"), F.col("d"))
    assert [(str(d) if d else None, s) for d, s in one(spark, "u string, d string", both, c["day"], c["source"])] == [("2017-01-14", "utc_date"), ("2017-01-15", "date"), (None, "missing_or_invalid"), ("2017-01-05", "utc_date")]
    ranges = [("train", date(2013, 1, 1), date(2013, 1, 20)), ("validation", date(2013, 1, 21), date(2013, 1, 25))]
    s = C.temporal_split(C.played_date(F.col("t")), ranges, "train")
    assert one(spark, "t string", [("2013-01-22",), (None,), ("2014-01-01",)], s["split"], s["reason"]) == [("validation", "date_interval"), ("train", "policy_assigned_missing_or_invalid"), (None, "outside_declared_ranges")]
    for bad in ([("a", date(2013, 1, 2), date(2013, 1, 1))], [ranges[1], ranges[0]]):
        with pytest.raises(ValueError):
            C.check_ranges(bad)


def test_identity(spark):
    assert one(spark, "t string", [("abc",)], I.hash_score("game_sampling", "seed", F.col("t")).cast("string")) == [("6437552247477660887",)]
    assert I.sampling_rate(1000, 10_000) == 10.0 and I.canonical_json({"b": 1, "a": "é"}) == '{"a":"\\u00e9","b":1}'
    names = [("Ann ",), ("x" * 300,), ("",)]
    for key in (b"key", b"k" * 100):
        got = [r[0] for r in one(spark, "n string", names, I.hmac_sha256(key, F.col("n")))]
        assert got == [hmac.new(key, n.encode(), hashlib.sha256).hexdigest() for (n,) in names]
    assert one(spark, "n string", [(" Ann",), ("  ",), (None,)], I.player_hash(F.col("n"))) == [("player_" + hashlib.sha256(b"fixture-placeholder|ann").hexdigest()[:24],), (None,), (None,)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=30), st.integers(1, 20))
def test_top_k_is_the_sorted_prefix(spark, tokens, k):
    score = lambda t: int.from_bytes(hashlib.sha256(f"n|s|{t}".encode()).digest()[:8], "big")
    df = spark.createDataFrame([(t,) for t in tokens], "t string").withColumn("u", I.hash_score("n", "s", F.col("t")))
    assert [r.t for r in df.orderBy("u", "t").limit(k).collect()] == sorted(tokens, key=lambda t: (score(t), t))[:k]


def test_leakage_literals(spark):
    rows = spark.createDataFrame([("train", "pos_a", 0), ("train", "pos_b", 1), ("validation", "pos_b", 2), ("test", "pos_b", 3), ("test", "pos_c", 4)], "temporal_split string, position_id string, ply int")
    assert {r.temporal_split: r.n_rows for r in leakage.split_counts(rows).collect()} == {"train": 2, "validation": 1, "test": 2}
    assert [r.position_id for r in leakage.novel(rows).collect()] == ["pos_c"]
    assert {(r.temporal_split, r.n_seen, r.seen_percent) for r in leakage.overlap(rows).collect()} == {("validation", 1, 100.0), ("test", 1, 50.0)}
    empty = {r.temporal_split: (r.n_rows, r.n_positions) for r in leakage.split_counts(rows.filter("false")).collect()}
    assert empty == {"train": (0, 0), "validation": (0, 0), "test": (0, 0)}


def test_frequency_backoff_order(spark):
    train = [("1600_1999", "opening", 100)] + [("1600_1999", "opening", 200)] * 2 + [("lt_1200", "opening", 100)] * 9
    df = spark.createDataFrame(train, "band string, phase string, action int")
    rows = spark.createDataFrame([("1600_1999", "opening", 100), ("1600_1999", "opening", 200), ("1600_1999", "endgame", 200), ("x", "y", 7)], "band string, phase string, action int")
    first = {(r.phase, r.action): r.score for r in leakage.frequency_scores(rows, df, (("band", "phase", "action"), ("phase", "action"), ("action",))).collect()}
    assert first[("opening", 200)] > first[("opening", 100)] and first[("endgame", 200)] == 1_000_002 and first[("y", 7)] == 0
    second = {(r.phase, r.action): r.score for r in leakage.frequency_scores(rows, df, (("phase", "action"), ("band", "phase", "action"), ("action",))).collect()}
    assert second[("opening", 100)] > second[("opening", 200)]


def test_holdout(spark):
    games = spark.createDataFrame([("train", "a", "b"), ("test", "a", "b"), (None, "a", None)], "temporal_split string, w string, b string")
    rows = leakage.with_holdout(games, "w", "b", "seed", 0, 100).collect()
    assert [r.eligible for r in rows] == [True, False, False]
    rows = leakage.with_holdout(games, "w", "b", "seed", 100, 100)
    assert rows.filter("eligible").count() == 0 and leakage.holdout_leaks(rows).count() == 0
    with pytest.raises(ValueError):
        leakage.ordered_splits({"train": ("2013-01-01", "2013-02-01"), "validation": ("2013-01-15", "2013-03-01")})


def test_ranking_and_calibration_literals(spark):
    rows = spark.createDataFrame([(1, 10, 1, 0.9), (1, 20, 0, 0.2), (1, 30, 0, 0.1), (2, 40, 0, 0.8), (2, 50, 1, 0.7), (2, 60, 0, 0.1)], "g int, action int, y int, score double")
    ranks = M.ranked(rows, "g", "score", "action").withColumn("n_candidates", F.lit(3)).filter("y = 1")
    (m,) = M.ranking_metrics(ranks).collect()
    assert (m.recall_at_1, m.mrr, m.candidates_mean, m.candidates_max, m.candidates_min) == (0.5, 0.75, 3.0, 3, 3)
    assert M.invalid_groups(rows, "g", "y").count() == 0
    p = spark.createDataFrame([(0, [0.8, 0.1, 0.1]), (1, [0.2, 0.6, 0.2]), (2, [0.1, 0.3, 0.6])], "y int, p array<double>")
    assert M.brier(p, "y", "p").first().brier == pytest.approx(0.56 / 3)
    bins = M.top_label_bins(p, "y", "p", 5)
    assert bins.count() == 5 and M.class_bins(p, "y", "p", 4).count() == 12 and 0 <= M.expected_calibration_error(bins).first().ece <= 1
    scores = {r["class"]: (r.precision, r.recall) for r in M.class_scores(M.confusion(spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "t int, q int"), "t", "q")).collect()}
    assert scores == {0: (1.0, 0.5), 1: (pytest.approx(1 / 3), 1.0), 2: (0.0, 0.0)}


def test_bootstrap_and_temperature():
    data = [(10, 5.0), (20, 12.0), (5, 1.0), (8, 6.0)]
    assert M.bootstrap(data, 0, 1) == {"point": 24 / 43, "low": 24 / 43, "high": 24 / 43}
    b = M.bootstrap(data, 500, 1)
    assert b["low"] <= b["point"] <= b["high"] and b == M.bootstrap(data, 500, 1)
    assert M.fitted_temperature(lambda t: (t - 2.5) ** 2) == pytest.approx(2.5, rel=1e-3) and M.fitted_temperature(lambda t: abs(t - 1.0)) == pytest.approx(1.0, rel=1e-3)
