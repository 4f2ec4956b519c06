import random

import numpy as np

from plyforge.llm import near_dup
from plyforge.llm.skew import components
from tests.llm.helpers import ODD, docs


def brute(rows, k, percent):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {j for x in s for j in where[x] if j < i}
        for j in near:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common) and root(i) != root(j):
                up[root(i)] = root(j)
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            if rows[j][0] == a and a is not None and sets[i] and sets[j]:
                up[root(i)] = root(j)
    least = {}
    for i, (a, _) in enumerate(rows):
        if a is not None:
            least[root(i)] = min(a, least.get(root(i), a))
    return sorted((str(a), len(sets[i]), str(least.get(root(i)) if sets[i] else a)) for i, (a, _) in enumerate(rows))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def check(spark, rows, **options):
    got = near_dup.classify(docs(spark, rows), **options).collect()
    have = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got)
    assert have == brute(rows, options["words"], options["percent"])


def test_classes_equal_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows + [(i + 500_000 if i is not None else None, t) for i, t in ODD], words=3, percent=85)


def test_large_groups_equal_brute_force(spark):
    rng = random.Random(5)
    one = [f"a{rng.randrange(500)}" for _ in range(120)]
    two = [f"b{rng.randrange(500)}" for _ in range(90)]
    rows = [(i, edited(rng, one, rng.randrange(9))) for i in range(120)] + [(200 + i, edited(rng, two, rng.randrange(7))) for i in range(50)]
    rows += [(300 + i, " ".join(one)) for i in range(40)] + [(400 + i, " ".join(two[:60]) + f" tail{i} end{i}") for i in range(30)]
    for options in ({"words": 3, "percent": 85, "cold": 4, "block": 24}, {"words": 5, "percent": 80, "cold": 10, "block": 500}):
        check(spark, rows, **options)


def test_empty_table_and_single(spark):
    assert near_dup.classify(docs(spark, [])).collect() == []
    assert [tuple(r) for r in near_dup.classify(docs(spark, [(4, "a b c d e f")])).collect()] == [(4, 2, 4)]


def test_components_of_chains(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 5), (200, 201), (201, 199)] + [(300, 300 + i) for i in range(1, 40)]
    rng.shuffle(chain)
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 0, 199: 199, 200: 199, 201: 199, **{i: 300 for i in range(300, 340)}}


def test_signature_estimates_similarity():
    shingle = near_dup.Shingler(3)
    rng = random.Random(2)
    words = [f"v{rng.randrange(10**6)}" for _ in range(400)]
    a, b = shingle(" ".join(words)), shingle(" ".join(words[:360] + [f"z{i}" for i in range(40)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((near_dup.signature(a, 512) == near_dup.signature(b, 512)).mean() - true) < 0.06


def test_long_lists_record_every_posted_place(spark, monkeypatch):
    seen = {}
    postings, collisions = near_dup.postings, near_dup.collisions
    monkeypatch.setattr(near_dup, "postings", lambda reps, coordinates, prefix, sketch: postings(reps, coordinates, seen.setdefault("prefix", prefix), sketch))
    monkeypatch.setattr(near_dup, "collisions", lambda posted, cold, first: collisions(posted, cold, seen.setdefault("first", first)))
    near_dup.classify(docs(spark, [(1, "a b c d"), (2, "a b c e")]), words=3, percent=85).collect()
    assert seen["first"] == seen["prefix"] == 18
