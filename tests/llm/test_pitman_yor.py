import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyforge.llm import pitman_yor as py
from plyforge.llm.common import remainder
from tests.llm.helpers import ODD, docs


def test_base_scores_and_counts_equal_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()] + ODD
    for head in (50, 50_000):
        got = py.score(docs(spark, rows), remainder(F.col("doc_id")) == 1, head=head).collect()
        counts, held = Counter(), [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
        words = [[*(t or "").encode().lower().split(), b""] for _, t in rows]
        for h, w in zip(held, words, strict=True):
            if not h:
                counts.update(w)
        n, v = sum(counts.values()), len(counts)
        want = sorted((str(i), h, len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 5)) for (i, _), h, w in zip(rows, held, words, strict=True))
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
        assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_model_beats_base_on_held_out(spark):
    from plyforge.llm import queries

    held = queries.op5_pitman_yor(spark, "/root/testdata/sf0.01").filter("held_out").toPandas()
    assert len(held) > 150 and held["score"].sum() > held["base_score"].sum()


def test_empty_table_and_no_training(spark):
    assert py.score(docs(spark, []), F.lit(False)).collect() == []
    (row,) = py.score(docs(spark, [(1, "alpha beta")]), F.lit(True)).collect()
    assert row.train_tokens == 0 and row.base_score == 0.0 and math.isfinite(row.score)


@pytest.fixture(scope="module")
def letters():
    words = [w for w in "the then there other mother father feather weather reading leading nation station ration relation".split() for _ in range(3)]
    spelling = py.Spelling([ord(c) for c in "etahoinrdgwfmlsx"])
    keys, counts = np.unique(spelling.keys(words)[0], return_counts=True)
    return spelling, py.sample_letters(keys, counts, size=18)


def test_letters_are_distributions(letters):
    spelling, model = letters
    for context in {int(k) >> py.DISH_BITS for k in model.cells[-1]} | {12345}:
        keys = np.array([(context << py.DISH_BITS) | dish for dish in range(18)])
        p = model.grams(keys)
        p[py.OTHER] *= py.CODE_POINTS
        assert np.allclose(p.sum(axis=0), 1.0, atol=1e-5)


def test_letters_learn(letters):
    spelling, model = letters
    p = model.words(spelling, ["other", "rhote", "ration", "noitar", ""]).mean(axis=1)
    assert p[0] > 100 * p[1] and p[2] > 100 * p[3] and 0 < p[4] < 1


def _leave(tables: list, rng) -> None:
    """One customer, any of them alike, leaves; a table without customers goes."""
    k = rng.choice(len(tables), p=np.array(tables) / sum(tables))
    tables[k] -= 1
    if not tables[k]:
        tables.pop(k)


def _sit(tables: list, d: float, new: float, rng) -> bool:
    """One customer sits down; whether at a new table."""
    weights = np.array([n - d for n in tables] + [new])
    k = rng.choice(len(weights), p=weights / weights.sum())
    if k == len(tables):
        tables.append(1)
        return True
    tables[k] += 1
    return False


def test_seating_matches_gibbs_by_single_customers():
    rng = np.random.default_rng(3)
    for c, a, d in ((3, 0.7, 0.6), (12, 0.7, 0.6), (25, 4.0, 0.3)):
        fast = py.seat(np.full(20_000, c), np.full(20_000, a), d, lambda active, _: rng.random(len(active)))
        tables, slow = [c], []
        for turn in range(400 * c + 12_000):
            _leave(tables, rng)
            _sit(tables, d, a, rng)
            if turn >= 400 * c:
                slow.append(len(tables))
        assert fast.min() >= 1 and fast.max() <= c and abs(fast.mean() - np.mean(slow)) < 0.06 * np.mean(slow)
    assert py.seat(np.array([0, 1, 10**7]), np.ones(3), 0.5, lambda active, _: rng.random(len(active)))[:2].tolist() == [0, 1]


def test_word_sweeps_match_gibbs_by_single_customers():
    """One word in two contexts with a shared parent, among the seats of other words that stand still."""
    rng, counts, d, strength, p = np.random.default_rng(5), (6, 9), (0.4, 0.7), 1.0, 1e-3
    rooms, customers, parents = np.array([400.0, 300.0]), 700.0, 500.0
    size = py.Sizes([0, 0], [[400], [300]], [700], [500], d, strength)
    n, c = 4000, np.tile(np.array(counts, dtype=float), (4000, 1))
    t, up = np.ones((n, 2)), np.ones(n)
    others = (np.tile(rooms, (n, 1)), np.full(n, customers), np.full(n, parents))
    for _ in range(30):
        t, up = py.sweep_once(c, t, up, np.full(n, p), others, size, lambda at: lambda active, step: rng.random(len(active)))

    # Every table of a context is a customer of one parent's table: [size, parent's table].
    seats, above, seen = [[[x, 0]] for x in counts], [2], []
    for turn in range(14_000):
        for z in range(2):
            k = rng.choice(len(seats[z]), p=np.array([x[0] for x in seats[z]]) / counts[z])
            seats[z][k][0] -= 1
            if not seats[z][k][0]:
                above[seats[z].pop(k)[1]] -= 1
            live = [i for i, x in enumerate(above) if x]
            old = [x[0] - d[1] for x in seats[z]]
            spelled = (strength + d[0] * (parents + len(live))) * p
            new = (strength + d[1] * (rooms[z] + len(seats[z]))) / (customers + sum(above) + strength)
            by = [*old, *(new * (above[i] - d[0]) for i in live), new * spelled]
            k = rng.choice(len(by), p=np.array(by) / sum(by))
            if k < len(old):
                seats[z][k][0] += 1
            elif k < len(old) + len(live):
                above[live[k - len(old)]] += 1
                seats[z].append([1, live[k - len(old)]])
            else:
                above.append(1)
                seats[z].append([1, len(above) - 1])
        if turn > 2000:
            seen.append((len(seats[0]), len(seats[1]), sum(x > 0 for x in above)))
    want = np.mean(seen, axis=0)
    got = np.array([t[:, 0].mean(), t[:, 1].mean(), up.mean()])
    assert np.all(np.abs(got - want) < 0.08 * want), (got, want)


def test_sizes_follow_the_seats_and_the_seed(spark):
    rows = [(i, f"the cat {'sat' * (i % 3)} on mat{i % 7} the") for i in range(40)]
    first, again = (sorted((r.doc_id, r.score) for r in py.score(docs(spark, rows), remainder(F.col("doc_id")) == 1).collect()) for _ in range(2))
    assert first == again


def test_word_probabilities_sum_to_one():
    """The parent's and a context's predictive probabilities over all words that have seats, and the rest."""
    size = py.Sizes([9, 5], [[4], [3]], [7], [5], (0.4, 0.7), 1.0)
    t, up = np.array([[2, 1], [1, 1], [1, 1]], dtype=float)[:, :, None], np.array([[2], [2], [1]], dtype=float)
    spelled = np.array([[0.2], [0.1], [0.05]])
    parent = size.parent(t.sum(axis=1), up, spelled)
    rest = (1.0 + 0.4 * 5) / (7 + 1.0) * (1 - spelled.sum())
    assert parent.sum() + rest == pytest.approx(1.0)
    c = np.array([[5, 2], [3, 2], [1, 1]], dtype=float)
    full = size.context(c, t, parent)
    open_ = (1.0 + 0.7 * np.array([4, 3])) / (np.array([9, 5]) + 1.0) * rest
    assert full.sum(axis=0)[:, 0] + open_ == pytest.approx(np.ones(2))


def test_rising_products():
    for a in (1e-9, 0.3, 7.0, 5000.0):
        for n in (1, 2, 5, 40, 3000):
            assert py.rising(np.array([a]), np.array([n]))[0] == pytest.approx(sum(math.log10(a + j) for j in range(n)), rel=1e-9, abs=1e-7)
