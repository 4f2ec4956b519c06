import math
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plyforge.llm import packing, queries, topk
from tests.llm.helpers import ODD, docs


def test_packing_round_trip(spark, sf_dir):
    from tokenizers import Tokenizer

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows += [r for r in ODD if r[0] is not None] + [(77_777, "special <|endoftext|> here"), (77_778, " " * 3000 + "x"), (77_779, " " * 1_200_000 + "y")]
    rows = list({i: (i, t) for i, t in rows}.values())
    files = queries.tokenizer_files()
    slow = Tokenizer.from_file(files["vocabulary"])
    want = {i: np.array([*slow.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, t in rows}
    got = packing.pack_documents(docs(spark, rows), **files).collect()
    by_doc, by_bin = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())
    assert set(by_doc) == set(want)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and sum(r.length for r in pieces) == len(want[i])
        assert [r.start for r in pieces] == [sum(x.length for x in pieces[:k]) for k in range(len(pieces))]
        assert all(r.length == 2048 for r in pieces[1:]) and (len(pieces) == 1 or len(want[i]) > 2048)
    for inside in by_bin.values():
        at = 0
        for r in sorted(inside, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_bin) <= 1.2 * math.ceil(sum(map(len, want.values())) / 2048)


def test_packing_empty_table(spark):
    assert packing.pack_documents(docs(spark, []), **queries.tokenizer_files()).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200), st.integers(1, 8))
def test_best_fit_equals_plain(lengths, bins):
    fit, open_, count = packing.BestFit(32, bins), {}, 0
    for n in lengths:
        bin_, offset = fit.place(n)
        fitting = [f for f in open_.values() if f >= n]
        if fitting:
            assert open_[bin_] == min(fitting)
        else:
            if len(open_) >= bins:
                fullest = min(open_.values())
                gone = [b for b in open_ if open_[b] == fullest]
                for b in gone[:1] if len(gone) == 1 else []:
                    open_.pop(b)
                if len(gone) > 1:
                    left = {b for level in fit.levels for b in level}
                    open_.pop(next(b for b in gone if b not in left))
            assert bin_ == count
            count += 1
            open_[bin_] = 32
        assert offset == 32 - open_[bin_]
        open_[bin_] -= n
        if not open_[bin_]:
            open_.pop(bin_)
        assert len(open_) <= bins


def brute_topk(rows, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries_ = {}
    for i, v in sorted(((i, v) for i, v in good if i % 50 == 0), key=lambda r: r[1], reverse=True):
        queries_[i] = v
    out = []
    for q, v in queries_.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_topk_equals_brute_force(spark, sf_dir):
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.3))) if rng.random() < 0.7 else 0.0 for _ in range(8)]) for i in range(600)]
    same = rows[7][1]
    rows += [(600 + i, list(same)) for i in range(40)] + [(1000, None), (1001, [None] * 8), (1002, [float("nan")] * 8), (1050, [float("inf")] + [0.0] * 7), (1100, []), (1150, [0.5, -0.5]), (None, same), (603, list(same))]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, rank int")
    got = sorted(tuple(r) for r in topk.exact_topk(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, group_rows=100, block_rows=5).collect())
    assert got == brute_topk(rows)


def test_topk_few_and_none(spark):
    make = lambda rows: topk.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)
    assert make([]).collect() == []
    assert [tuple(r) for r in make([(0, [1.0]), (3, [2.0])]).collect()] == [(0, 1, 3, 256 * 512)]
