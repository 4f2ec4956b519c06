import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plyforge.llm import language, queries, toxicity
from tests.llm.helpers import ODD, docs

MEDIUM = "/root/testdata/sf0.01"


def test_language_accuracy_on_held_out(spark):
    got = queries.op4_language_id(spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").toPandas()
    assert len(held) > 150 and (held["lang_pred"] == held["lang"]).mean() >= 0.97
    assert held["score"].between(0, 1).all()


def test_language_odd_rows(spark):
    rows = [(i, t, "en") for i, t in ODD] + [(70, "1234 !!", "xx"), (71, "der und die nicht das ist ein", "de"), (72, "der und die nicht das ist ein", None)]
    df = docs(spark, rows)
    langs, prototypes = language.fit(df, F.lit(True))
    assert langs == ["de", "en"]
    got = language.predict(df, langs, prototypes).collect()
    by = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in got}
    assert len(got) == len(rows) and by[(5, None)] == by[(4, "")] == by[(70, "1234 !!")] == ("und", 0.0)
    assert by[(72, "der und die nicht das ist ein")][0] == "de" and by[(2**40, ODD[7][1])][0] == "en"
    nothing = language.fit(df, F.lit(False))
    assert {r.lang_pred for r in language.predict(df, *nothing).collect()} == {"und"}
    assert language.predict(docs(spark, []), langs, prototypes).collect() == []


def test_language_vectors_bind_and_rotate():
    e = language.Encoder(256, 3)
    v = np.roll(e.letter(32), 2).astype(int) * np.roll(e.letter(97), 1) * e.letter(32)
    assert np.allclose(e.vector("A!"), v / np.linalg.norm(v))
    small = language.Encoder(256, 3, keep=2)
    assert np.allclose(small.vector("banana split"), e.vector("banana split"))


def test_toxicity_on_held_out(spark):
    got = queries.op9_toxicity(spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "toxic"), "doc_id")
    held = got.filter("held_out").toPandas()
    y, p = held["toxic"].to_numpy(), held["score"].to_numpy()
    above = (p[y == 1][:, None] > p[y == 0][None, :]).mean() + 0.5 * (p[y == 1][:, None] == p[y == 0][None, :]).mean()
    assert above > 0.75 and ((p >= 0.5) == held["predicted"]).all()
    assert (held["predicted"][y == 0] == 0).mean() > 0.95


@pytest.fixture(scope="module")
def chars():
    words = "idiot loser stupid trash clown moron the and that thing other reading tension here there nation".split()
    counts = {}
    for w in words:
        for g in toxicity.trigrams(w):
            counts[g] = counts.get(g, 0) + 30
    return toxicity.CharModel(counts)


@pytest.mark.parametrize(("hidden", "word"), [("1d10t", "idiot"), ("l0s3r", "loser"), ("s.t.u.p.i.d", "stupid"), ("looooser", "loser"), ("tr@sh", "trash"), ("cl0wn", "clown"), ("m-o-r-o-n", "moron"), ("$tupid", "stupid"), ("m0r0n", "moron")])
def test_decoding(chars, hidden, word):
    assert toxicity.Reader(chars, None).restored(hidden) == word


@pytest.mark.parametrize(("text", "word"), [("you are a s t u p i d person", "stupid"), ("what a l o s e r", "loser"), ("y o u a r e s t u p i d", "stupid"), ("a stu pid person", "stupid"), ("a  m o r o n, really", "moron"), ("such a 1 d 1 0 t", "idiot")])
def test_spaced_words_come_apart(word, text):
    counts = {}
    for w in "idiot loser stupid trash clown moron you are a person what such the and that thing other".split():
        for g in toxicity.trigrams(w):
            counts[g] = counts.get(g, 0) + 30
    assert toxicity.Reader(toxicity.CharModel(counts), {word: 0})(text) == {0}
    assert toxicity.Reader(toxicity.CharModel(counts), {word: 0})("what other thing and you are a person") == set()


def every_reading(token, model, context="^^", last="", out=""):
    """Scores of all ways through a token's lattice."""
    if not token:
        yield model.log(context, "$"), out
        return
    c, rest = token[0], token[1:]
    options = [(x, toxicity.CHANGED) for x in toxicity.LEET.get(c, "")] + ([(c, 0.0)] if c in toxicity.LETTERS else [])
    if c == " ":
        ended = model.log(context, "$") if context != "^^" else 0.0
        yield from ((s + ended, o) for s, o in every_reading(rest, model, "^^", c, out + " " * (context != "^^")))
    for x, cost in options:
        yield from ((s + cost + model.log(context, x), o) for s, o in every_reading(rest, model, context[1] + x, c, out + x))
    droppable = c in toxicity.SEPARATORS + " " or c == last or not options
    if droppable and (c != " " or context != "^^"):
        cost = toxicity.DROPPED if c in toxicity.SEPARATORS + " " or c == last else 2 * toxicity.DROPPED
        yield from ((s + cost, o) for s, o in every_reading(rest, model, context, c, out))


@settings(max_examples=80, deadline=None)
@given(st.text("iad0t1@ .-o!ü9", min_size=1, max_size=9))
def test_decoding_equals_brute_force(text):
    model = toxicity.CharModel({g: 7 + i for i, g in enumerate(g for w in ("idiot", "toad", "dot", "add", "iota") for g in toxicity.trigrams(w))})
    best = max((s for s, _ in every_reading(text, model)), default=-math.inf)
    got, word = toxicity.decoded(text, model)
    assert got == pytest.approx(best) and any(o == word and s == pytest.approx(best) for s, o in every_reading(text, model))


def test_nothing_that_hides_is_passed_over(chars):
    draw, words = random.Random(4), "idiot loser stupid the and other reading here there that a I".split()
    wanted = {f: i for i, f in enumerate(dict.fromkeys(x for w in ("idiot", "loser", "stupid") for x in toxicity.features_of(w)))}
    ways = [str.upper, lambda w: " ".join(w), lambda w: "-".join(w), lambda w: w.replace("o", "0").replace("s", "$"), lambda w: w[:2] + w[2:3] * 80 + w[2:], lambda w: w[0] + "." * 90 + w[1:], lambda w: f"({w})!", lambda w: w[:3] + " " + w[3:], str]
    for _ in range(150):
        text = " ".join(draw.choice(ways)(draw.choice(words)) for _ in range(12))
        read = toxicity.Reader(chars, wanted)
        found = set(text.split()).union(*(read.apart(x) for x in toxicity.STRETCH.findall(text)))
        assert read(text) == {wanted[f] for x in found for f in toxicity.features_of(read.restored(x)) if f in wanted}


def test_only_what_may_hide_a_feature_is_read(chars):
    """The whole text is searched at once, with what reading every token finds; other tokens aren't looked at."""
    draw, names = random.Random(5), ["idiot", "^stup", "^lose", "scum", "#tag", "привет", "1,5", "the"]
    wanted = {f: i for i, f in enumerate(names)}
    plain, leet = ["idiot", "stupid", "loser", "scum", "#tag", "привет", "1,5", "the", "of", "losing", "I", "İs"], {c: k for k, v in toxicity.LEET.items() for c in v}

    def word():
        out = "".join((leet[c] if c in leet and draw.random() < 0.2 else c.upper() if draw.random() < 0.1 else c) * draw.choice([1, 1, 1, 3]) + (draw.choice(" \t.-*\n_'") if draw.random() < 0.2 else "") for c in draw.choice(plain))
        return draw.choice(["", "", "(", "!", "…#", "—", "'"]) + out + draw.choice(["", "", "!", ").", "…"])

    for _ in range(400):
        text = draw.choice([" ", "  ", "\xa0", "\n"]).join(word() for _ in range(draw.randint(1, 12)))
        read, slow = toxicity.Reader(chars, wanted), toxicity.Reader(chars, wanted)
        assert read(text) == {f for x in slow.tokens(text) for f in slow.of_word(x)}, text
    read = toxicity.Reader(chars, {"idiot": 0})
    assert read("word " + " ".join(f"other{i} w0rds a b{i}" for i in range(500)) + "\n1d i0t") == {0} and set(read.seen) == {"1d", "idiot"}


@pytest.mark.parametrize("text", ["s" + 70 * "-" + "tupid", "what an (idiot)!", "l" + "o" * 90 + "ser", "1d10t!!", "+rash"])
def test_long_and_bracketed_tokens(chars, text):
    assert toxicity.Reader(chars, {"stupid": 0, "idiot": 0, "loser": 0, "trash": 0})(text) == {0}


def test_regression_is_at_its_minimum():
    draw = np.random.default_rng(3)
    x, weight = draw.random((80, 6)) < 0.4, draw.random(80) + 0.5
    y = (x[:, 0] | (draw.random(80) < 0.3)).astype(float)
    w = toxicity._regress([np.flatnonzero(r) for r in x], 6, y, weight, steps=3000)
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    slope = np.concatenate([[weight @ (p - y)], x.T.astype(float) @ (weight * (p - y)) + 0.05 * w[1:]])
    assert np.abs(slope).max() < 1e-3


def test_restored_text(chars):
    assert toxicity.restored_text("that l o s e r here, 1d10t and 127.0.0.1", chars) == "that loser here, idiot and 127.0.0.1"


def test_toxicity_odd_rows(spark):
    rows = ODD + [(100 + i, f"nice words number {i} all fine") for i in range(40)] + [(200 + i, f"you idiot number {i} all fine") for i in range(40)] + [(400, "what an 1d10t number"), (401, "what a nice number")]
    labels = spark.createDataFrame([(100 + i, 0) for i in range(40)] + [(200 + i, 1) for i in range(40)] + [(5, None), (200, 0), (None, 1)], "doc_id long, toxic int")
    df = docs(spark, rows)
    model = toxicity.fit(df, labels, F.lit(True), least_z=3.0)
    got = toxicity.score(df, model).collect()
    by = {r.doc_id: r.toxicity for r in got}
    assert len(got) == len(rows) and all(0 <= r.toxicity <= 1 for r in got)
    assert by[400] > 0.5 > by[401] and by[5] < 0.5
    none = toxicity.fit(df, labels.filter("toxic = 0"), F.lit(True))
    assert all(r.toxicity < 0.5 for r in toxicity.score(df, none).collect())
    assert toxicity.score(docs(spark, []), model).collect() == []


def test_prototypes_and_least_scores_come_from_all_documents(spark):
    rows = [(i, "der und die nicht das ist ein" if i % 3 else f"wort {i} und noch eines", "de") for i in range(2600)]
    langs, prototypes = language.fit(docs(spark, rows), F.lit(True))
    encode = language.Encoder(1024, 5)
    whole = sum(np.rint(encode.vector(t) * language.SCALE) for _, t, _ in rows)
    assert langs == ["de"] and np.allclose(prototypes[0], whole / np.linalg.norm(whole))
    named = spark.createDataFrame([("de", "de", i / 5000) for i in range(5000)] + [("de", "en", 0.0), ("en", "und", 0.0)], "lang string, lang_pred string, score double")
    assert language.least_scores(named, ["de", "en"], 0.005) == {"de": 24 / 5000, "en": 24 / 5000}


def test_toxicity_is_fitted_on_all_labelled_rows(spark, monkeypatch):
    rows = [(i, f"nice words number {'abcdefghij'[i % 10]} all fine {i:05d}") for i in range(13_000)] + [(20_000 + i, f"you rotter number {i} all fine") for i in range(30)]
    df, labels = docs(spark, rows), spark.createDataFrame([(i, int(i >= 20_000)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(df, labels, F.lit(True))
    assert model.chars["^^n"] == 2 * 13_000 + 30 and model.chars["^^y"] == 30


def test_toxicity_is_fitted_alike_in_the_cluster(spark):
    df, labels = (spark.read.parquet(f"{MEDIUM}/{name}.parquet") for name in ("documents", "labels"))
    here, far = (toxicity.fit(df, labels, F.lit(True), most_patterns=n) for n in (10**6, 0))
    assert here.places == far.places and here.chars == far.chars
    a, b = ({r.doc_id: r.toxicity for r in toxicity.score(df, m).select("doc_id", "toxicity").collect()} for m in (here, far))
    assert max(abs(a[i] - b[i]) for i in a) < 0.02


def test_toxicity_counts_copies_once(spark):
    rows = [(i, f"nice words {i}") for i in range(40)] + [(100 + i, "you idiot") for i in range(5)] + [(100, "you idiot"), (100, "an other text"), (200, None)]
    known = spark.createDataFrame([(i, int(i >= 100)) for i in [*range(40), *range(100, 105), 200]], "doc_id long, y int")
    got = sorted((r.text, r.y) for r in toxicity._labelled(docs(spark, rows), known).collect())
    assert got == sorted([(f"nice words {i}", 0) for i in range(40)] + [("you idiot", 1), ("an other text", 1), ("", 1)])
