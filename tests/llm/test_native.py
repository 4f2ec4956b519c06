import hashlib
import math
import random
import re
import string
import time

from pyspark.sql import functions as F

from plyforge.llm import queries, secrets, url_filter, winnow
from tests.llm.helpers import ODD, docs

BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def base_spans(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p, g, least) in enumerate(BASE) for m in p.finditer(text) if len(m.group(g)) >= least]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def test_secret_base_spans_equal_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(i, "x " * 40 + "token=abcdefgh1 é " * n + "API_KEY: 'zzzzzzzzzz' AKIA1234567890AB ") for i, n in ((900_001, 1), (900_002, 300))]
    got = {(r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex): r.spans for r in secrets.report(docs(spark, rows + ODD)).collect()}
    for i, text in rows + ODD:
        want = base_spans(text or "")
        n = [sum(x.startswith(k) for x in want) for k in ("assign", "access", "hex")]
        key = (i, hashlib.sha256(",".join(want).encode()).hexdigest(), *n)
        assert key in got
        assert [x for x in got[key].split(",") if x and not x.startswith("random")] == want


def test_secret_method_finds_random_runs_and_leaves_words(spark):
    rows = [(1, "key 9fQ2xLk8Rz7VbN3mTt6YcW1aHs5Dg0Pj4Ue end"), (2, "see the_quick_brown_fox_jumps_over_1999_lazy_dogs now"), (3, "Donaudampfschifffahrtsgesellschaft1 und aaaaaaaaaaaaaaaaaaaaaaaa1")]
    got = {r.doc_id: r.spans for r in secrets.report(docs(spark, rows)).collect()}
    assert got == {1: "random:4:39", 2: "", 3: ""}


def test_secret_behind_names_and_prefixes(spark):
    key, low = "wJa9rXUtnFEMI/K7MDENGbPxRfiCYzQ3Ls+8Vd2h", "9f2xlk8rz7vbn3mtt6ycw1ahs5dg0pj4"
    heads = ["AWS_SECRET_ACCESS_KEY=", "https://a.org/x?sig=", "AUTH=", "x=1&next=", "key-"]
    rows = [(i, f"{h}{key} end") for i, h in enumerate(heads)] + [(10, f"é key-{low} end"), (11, f"api_{low}-x end"), (12, f"AUTH={key}== end"), (13, "AWS_SECRET_ACCESS_KEY=the_quick_brown_fox_jumps_over_1999_lazy_dogs")]
    got = {r.doc_id: r.spans for r in secrets.report(docs(spark, rows)).collect()}
    for i, h in enumerate(heads[:4]):
        assert got[i] == f"random:{len(h)}:{len(h) + 40}"
    # With "key-" before it the whole run is a candidate of the mixed alphabet too, and contains the other.
    assert got[4] in ("random:0:44", "random:4:44")
    assert got[10] == "random:6:38" and got[11] == "random:4:36" and got[12] == "random:5:47" and got[13] == ""
    masked = {r.doc_id: r.text for r in secrets.redacted(docs(spark, rows)).collect()}
    assert masked[0] == "AWS_SECRET_ACCESS_KEY=[SECRET] end" and masked[10] == "é key-[SECRET] end"


def test_secret_redaction(spark):
    rows = [(1, "é password=abcdefgh12 tail"), (2, "clean"), (3, None)]
    df = docs(spark, rows).withColumn("spans", F.lit("kept")).withColumn("_base", F.lit(9))
    out = secrets.redacted(df)
    assert out.columns == df.columns
    got = {r.doc_id: (r.text, r.n_chars, r.spans, r._base) for r in out.collect()}
    assert got == {1: ("é [SECRET] tail", 15, "kept", 9), 2: ("clean", 5, "kept", 9), 3: (None, None, "kept", 9)}


def normal(z):
    z = max(-8.0, min(8.0, z))
    return 1 / (1 + math.exp(-1.5976 * z - 0.07056 * z**3))


def brute_battery(value, alphabet, match):
    """(p_random, p_text) straight from the definitions."""
    x = [alphabet.index(c) for c in (value.lower() if alphabet == alphabet.lower() else value.translate(str.maketrans("-_", "+/")))]
    n, size = len(x), len(alphabet)
    chi, df = sum((x.count(a) - n / size) ** 2 / (n / size) for a in range(size)), size - 1
    p_chi = max(1e-12, normal(-((max(chi, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))))
    up = [a >= size // 2 for a in x]
    runs, high = 1 + sum(a != b for a, b in zip(up, up[1:])), sum(up)
    expected = 2 * high * (n - high) / n + 1
    spread = (expected - 1) * (expected - 2) / (n - 1)
    p_runs = max(1e-12, 2 * normal(-abs((runs - expected) / math.sqrt(spread)))) if spread > 0 else 1e-12
    mean = sum(x) / n
    power = sum((a - mean) ** 2 for a in x)
    serial = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:])) / power if power else 0
    p_serial = max(1e-12, 2 * normal(-abs((serial + 1 / n) * math.sqrt(n)))) if power else 1e-12
    half = -(math.log(p_chi) + math.log(p_runs) + math.log(p_serial))
    shift = n * (size * match - 1)
    return math.exp(-half) * (1 + half + half * half / 2), normal((chi - df - shift) / math.sqrt(2 * df + 4 * shift))


def brute_random(text, base, rate=0.05, keep=0.001):
    """Spans that the battery adds, by testing every candidate and every threshold."""
    found = sorted({m.span() for run in secrets.RUNS for m in re.finditer(run, text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])})
    values = []
    for a, b in found:
        bare = text[a:b].rstrip("=")
        name = next(((n, letters) for n, pattern, letters in secrets.ENCODINGS if re.search(pattern, bare)), None)
        p_random, p_text = brute_battery(bare, name[1], secrets.TEXT_MATCH[name[0]]) if name else (0.0, 1.0)
        values.append(1.0 if p_random < keep else p_text)
    most = max((p for p in values if p <= rate * sum(q <= p for q in values) / len(values)), default=-1)
    out = []
    for (a, b), p in zip(found, values):
        if p <= most and not any(x < b and a < y for x, y in base):
            if out and a < out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
    return out


def test_battery_equals_brute_force(spark):
    draw = random.Random(8)
    letters = string.ascii_letters + string.digits
    key = lambda n, of: "".join(draw.choice(of) for _ in range(n))
    kinds = [lambda: key(40, letters + "+/"), lambda: key(24, letters[:26] + letters[52:]), lambda: key(26, "0123456789abcdef"), lambda: key(32, letters[26:52] + "234567"), lambda: "some_long_identifier_name_2_with_words", lambda: "token=" + key(30, letters), lambda: "key-" + key(32, letters + "_-") + "==", lambda: "the words of 3 lines", lambda: "aB1" * 12, lambda: "AKIA" + key(16, letters[26:])]
    rows = [(i, draw.choice(" \n,")[0].join(draw.choice(kinds)() for _ in range(draw.choice([1, 2, 5, 20])))) for i in range(60)]
    for r in secrets.report(docs(spark, rows)).collect():
        spans = [x.split(":") for x in r.spans.split(",") if x]
        base = [(int(a), int(b)) for k, a, b in spans if k != "random"]
        assert [(int(a), int(b)) for k, a, b in spans if k == "random"] == brute_random(rows[r.doc_id][1], base), rows[r.doc_id]


def test_ten_thousand_candidates_of_one_text(spark):
    draw = random.Random(2)
    text = " ".join(("token=" if i % 2 else "") + "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(32)) for i in range(10_000))
    text += " " + "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(100_000))
    start = time.monotonic()
    row = secrets.report(docs(spark, [(1, text)])).collect()[0]
    hidden = secrets.redacted(docs(spark, [(1, text)])).collect()[0]
    assert row.n_assign == 5000 and row.n_random > 4900 and time.monotonic() - start < 120
    assert hidden.text.count("[SECRET]") == row.n_assign + row.n_random and hidden.n_chars == len(hidden.text)


def brute_tokens(text, cut):
    out = []
    for run in re.findall(r"[^ \t\n\x0b\f\r]+", text):
        out += [run] if len(run) <= cut else [run[i : i + cut] for i in range(len(run))]
    return out


def brute_fingerprint(spark, texts, k, w, cut):
    """Hashes that roll from place to place, and a scan of every window."""
    tokens = [brute_tokens(t, cut) for t in texts]
    flat = sorted({x for t in tokens for x in t})
    one = {r.t: r.h % winnow.PRIME for r in spark.createDataFrame([(x,) for x in flat], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    out = []
    for t in tokens:
        hs, picks, value = [], [], 0
        for i, x in enumerate(t):
            if i >= k:
                value -= one[t[i - k]] * pow(winnow.BASE, k - 1, winnow.PRIME)
            value = (value * winnow.BASE + one[x]) % winnow.PRIME
            if i >= k - 1 or i == len(t) - 1:
                hs.append(value)
        for i in range(max(len(hs) - w + 1, min(len(hs), 1))):
            window = hs[i : i + w]
            at = max(j for j, x in enumerate(window) if x == min(window)) + i
            if not picks or picks[-1] != (hs[at], at):
                picks.append((hs[at], at))
        out.append(picks)
    return out


def test_winnowing_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()] + ODD
    got = winnow.edit_report(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    tie = {r.text: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "text string").select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -tie[r[1] or ""]))
    want = []
    prints = {}
    edits = []
    for at, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        edits.append((i, text, text[: len(text) - cut] + following[:cut], following))
    texts = sorted({x for e in edits for x in e[1:]})
    prints = dict(zip(texts, brute_fingerprint(spark, texts, 3, 4, 12), strict=True))
    show = lambda t: " ".join(f"{h:x}@{p}" for h, p in prints[t])

    def like(a, b):
        a, b = ({h for h, _ in prints[x]} for x in (a, b))
        return round(len(a & b) / len(a | b), 9) if a | b else 1.0

    for i, text, edited, following in edits:
        want.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), show(text), show(edited), like(text, edited), like(text, following)))
    have = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint.lower(), r.edited_fingerprint.lower(), round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(have) == sorted(want)


def test_winnowing_empty_table(spark):
    assert winnow.edit_report(docs(spark, [])).collect() == []


def test_winnowing_unspaced_text_is_aligned_by_content(spark):
    draw = random.Random(6)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "".join(chr(0x4E00 + i) for i in range(400))):
        text = "".join(draw.choice(letters) for _ in range(600))
        rows = [(1, text), (2, letters[0] + text), (3, "other " + text[100:500])]
        sets = {r.doc_id: set(r.s) for r in winnow.fingerprints(docs(spark, rows)).select("doc_id", winnow.hash_set(F.col("chosen")).alias("s")).collect()}
        assert len(sets[1] & sets[2]) > 0.9 * len(sets[1]) and len(sets[3] & sets[1]) > 0.9 * len(sets[3])


def test_next_document_where_ids_are_skewed(spark):
    rows = [(i, f"text {i}") for i in range(300)] + [(2**62, "far"), (7, "again"), *((50, f"same {i}") for i in range(300)), *((None, f"none {i}") for i in range(200))]
    df = docs(spark, rows).select("doc_id", "text")
    got = winnow.with_next(df, ["text"], ranges=16)
    slots = [r["count"] for r in got.filter("NOT guest").groupBy("slot").count().collect()]
    assert max(slots) < 200 and sum(slots) == len(rows)
    tie = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = [t for _, t in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -tie[r[1]]))]
    want = dict(zip(ordered, [*ordered[1:], ordered[0]], strict=True))
    assert {r.text: r.next_text for r in got.filter("NOT guest").collect()} == want


def test_winnowing_guarantee(spark):
    shared = "alpha beta gamma delta epsilon zeta"  # w + k - 1 tokens
    rows = [(1, f"one two three {shared} four"), (2, f"{shared} other words follow here now")]
    sets = [set(r.s) for r in winnow.fingerprints(docs(spark, rows)).select(winnow.hash_set(F.col("chosen")).alias("s")).collect()]
    assert sets[0] & sets[1]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<html>", "k") for i, u in enumerate(urls)], "page_id long, url string, html string, key string")


def test_url_rules_and_parts(spark):
    urls = [None, "", "no scheme", "http://A.Example.com/en/1?x#y", "https://www.example.com/en/2", "http://net/es/", "http://b.net/fr/x", "ftp://x.org", "http://q.com?z=/en/", "http://com/a://b", "http://notexample.com/en/"]
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(pages(spark, urls * 2), queries.RULES).collect()}
    want = [("", "", None), ("", "", None), ("", "", None), ("a.example.com", "/en/1", "example.com/en/"), ("www.example.com", "/en/2", "www.example.com/en/"), ("net", "/es/", "net/es/"), ("b.net", "/fr/x", "net/fr/"), ("x.org", "", None), ("q.com", "", None), ("com", "/a://b", "com/"), ("notexample.com", "/en/", "com/")]
    assert [got[i] for i in range(len(urls))] == want and [got[i + len(urls)] for i in range(len(urls))] == want


def test_url_reputation_shrinks(spark):
    bad = [f"http://bad.evil.net/es/{i}" for i in range(30)] + ["http://bad.evil.net/en/1", "http://new.evil.net/en/1"]
    good = [f"http://www.good.com/{i}" for i in range(30)] + ["http://unknown.org/1"]
    rows = url_filter.judge(pages(spark, bad + good), queries.RULES).collect()
    verdict = {r.host + r.path: r.verdict for r in rows}
    assert verdict["bad.evil.net/en/1"] == "block" and verdict["unknown.org/1"] == "allow"
    mean = {r.host: r.block_rate for r in rows}
    assert mean["bad.evil.net"] >= mean["new.evil.net"] > mean["unknown.org"] > mean["www.good.com"]


def test_url_empty_table(spark):
    assert url_filter.judge(pages(spark, []), queries.RULES).collect() == []


def test_registered_domains(spark):
    want = {"a.b.co.uk": ("b.co.uk", "co.uk"), "10.0.0.1": ("10.0.0.1", "(ip)"), "www.x.com:8080": ("x.com", "com"), "co.uk": ("co.uk", "co.uk"), "[::1]:80": ("[::1]", "(ip)"), "": ("", ""), "localhost": ("localhost", "localhost"), "a.b.c.org": ("c.org", "org")}
    rows = spark.createDataFrame([(h,) for h in want], "host string").select("host", *url_filter.registered(F.col("host"))).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == want


def test_url_repeated_and_null_ids_ties_and_extra_columns(spark):
    urls = ["http://a.net/es/1", "http://a.net/en/1", "http://b.co.uk/1", None] * 30
    rows = spark.createDataFrame([(None if i % 3 else i % 7, u, "own", "host", "r") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string, key string")
    got = url_filter.judge(rows, queries.RULES).collect()
    assert sorted(r.host for r in got) == sorted(u.split("/")[2] if u else "" for u in urls)
    assert {(r.host, r.path, r.rule) for r in got} == {("a.net", "/es/1", "net/es/"), ("a.net", "/en/1", None), ("b.co.uk", "/1", None), ("", "", None)}
