"""Secret scans, in DataFrame expressions only.

Base kinds are fixed patterns. Besides them, every run of 20 or more encoding characters is a candidate, for
each of four sets of them: letters and digits alone, with base64's '+' and '/', with its URL form's '-' and
'_', and with all four. So a name, a path or a prefix before a secret is cut off, and '=' always ends a
run; only padding at the very end belongs to it. A candidate's encoding (hex, base32, base36 or base64) is inferred from its characters and a battery asks
whether its symbols look drawn at random: chi-squared for a uniform alphabet, the runs test around the
alphabet's middle and the lag-1 serial correlation, their p-values combined by Fisher's method.

Only runs that one of the encodings may explain are candidates: all four need a digit and a letter, so words
and numbers alone are no hypotheses.

The null hypothesis of a candidate is "text or identifier". It gives the chi-squared statistic a noncentrality
that grows with the length, so short candidates, of which nothing can be told, keep large p-values; a candidate whose
combined battery rejects randomness keeps its null hypothesis (p-value 1). The p-values of a
document's candidates, nested ones too, go through Benjamini and Hochberg's step-up procedure together;
discoveries that overlap are one span. Work is nearly linear in a text's candidates.

Null text counts as empty and has no spans. Repeated rows are kept. An empty table gives an
empty result. Offsets count code points, ends are exclusive. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.llm.common import ascii_lower, spread

# The base kinds' patterns (assign is matched on A-Z lower-cased text).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

#: Runs by their characters besides letters and digits; '=' belongs to a run only where it pads its end.
RUNS = tuple(rf"(?<![A-Za-z0-9{more}])[A-Za-z0-9{more}]{{20,}}(?:=+(?![A-Za-z0-9+/_=-]))?" for more in ("+/_-", "", "+/", "_-"))
#: name, pattern of the whole candidate, alphabet in order.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[A-Za-z])([a-z0-9]+|[A-Z0-9]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
#: Sum of squared symbol frequencies that text in an alphabet has at least.
TEXT_MATCH = {"hex": 0.1, "base32": 0.065, "base36": 0.06, "base64": 0.05}
BLOCK, MASKED = 128, 4096


def _bound(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _starts(gaps: Column, found: Column) -> Column:
    """Where each match starts, by sums over blocks, so that many matches stay cheap."""
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.char_length(g).cast("long").alias("g"), F.char_length(m).cast("long").alias("m")))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x["g"] + x["m"])

    def placed(s: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / BLOCK).cast("int")), lambda b: total(F.slice(s, b * BLOCK + 1, F.lit(BLOCK))))

        def at(sums: Column) -> Column:
            before = lambda b: F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0).cast("long"), lambda x, y: x + y)
            inside = lambda b, i: total(F.slice(s, b * BLOCK + 1, i - b * BLOCK))
            block = lambda i: F.floor(i / BLOCK).cast("int")
            return F.transform(s, lambda x, i: before(block(i)) + inside(block(i), i) + x["g"])

        return _bound(blocks, at)

    return F.when(F.size(found) == 0, F.array().cast("array<bigint>")).otherwise(_bound(steps, placed))


def matches(text: Column, pattern: str, wanted: Column, group: int = 0) -> Column:
    """array<struct<start, end, value>> of the leftmost matches that don't overlap; where
    ``wanted`` isn't true, empty without a search. value: the text of ``group``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)

    def spans(b: Column) -> Column:
        return F.transform(
            F.arrays_zip(_starts(b["gaps"], b["found"]).alias("a"), b["found"].alias("f"), b["values"].alias("v")),
            lambda x: F.struct(x["a"].alias("start"), (x["a"] + F.char_length(x["f"])).alias("end"), x["v"].alias("value")),
        )

    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(wanted, _bound(F.struct(gaps.alias("gaps"), found.alias("found"), values.alias("values")), spans)).otherwise(none)


def _normal(z: Column) -> Column:
    """Standard normal distribution function, by a logistic approximation."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def _two_sided(z: Column) -> Column:
    return F.greatest(F.lit(1e-12), 2 * _normal(-F.abs(z)))


def battery(value: Column, alphabet: str, match: float) -> Column:
    """struct(p_random, p_text) of a candidate in ``alphabet``."""
    size = len(alphabet)
    cased = F.lower(value) if alphabet == alphabet.lower() else F.translate(value, "-_", "+/")
    symbols = F.transform(F.split(cased, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)

    def sums(s: Column) -> Column:
        """What the tests need, each in one pass."""
        number = lambda x: F.coalesce(x, F.lit(0)).cast("double")
        total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda t, x: t + f(x))
        pairs = F.zip_with(F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s)), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
        counts = F.transform(F.array_distinct(s), lambda x: F.size(F.filter(s, lambda y: y == x)))
        return F.struct(
            F.size(s).cast("double").alias("n"), total(counts, lambda c: number(c) * c).alias("squares"), total(s, lambda x: F.when(x >= size // 2, 1.0).otherwise(0.0)).alias("high"),
            total(s, number).alias("sum"), total(s, lambda x: number(x) * x).alias("power"), F.get(s, 0).cast("double").alias("first"), F.element_at(s, -1).cast("double").alias("last"),
            _bound(pairs, lambda p: F.struct(total(p, lambda q: F.when((q["x"] >= size // 2) != (q["y"] >= size // 2), 1.0).otherwise(0.0)).alias("turns"), total(p, lambda q: number(q["x"]) * q["y"]).alias("lagged"))).alias("p"),
        )

    def statistics(t: Column) -> Column:
        n, high, mean = t["n"], t["high"], t["sum"] / t["n"]
        expected = 2 * high * (n - high) / n + 1
        power = t["power"] - t["sum"] * mean
        lagged = t["p"]["lagged"] - mean * (2 * t["sum"] - t["first"] - t["last"]) + (n - 1) * mean * mean
        return F.struct(
            n.alias("n"), (t["squares"] * size / n - n).alias("chi"), (1 + t["p"]["turns"] - expected).alias("runs"),
            ((expected - 1) * (expected - 2) / (n - 1)).alias("spread"), power.alias("power"), F.when(power > 0, lagged / power).alias("serial"),
        )

    def p_values(t: Column) -> Column:
        df = size - 1.0
        third = F.pow(F.greatest(t["chi"], F.lit(0.0)) / df, F.lit(1 / 3))
        p_chi = F.greatest(F.lit(1e-12), _normal(-(third - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5))
        p_runs = F.when(t["spread"] > 0, _two_sided(t["runs"] / F.sqrt(t["spread"]))).otherwise(F.lit(1e-12))
        p_serial = F.when(t["power"] > 0, _two_sided((t["serial"] + 1 / t["n"]) * F.sqrt(t["n"]))).otherwise(F.lit(1e-12))
        shift = t["n"] * (size * match - 1)
        p_text = _normal((t["chi"] - df - shift) / F.sqrt(2 * df + 4 * shift))
        return F.struct((-(F.log(p_chi) + F.log(p_runs) + F.log(p_serial))).alias("half"), p_text.alias("p_text"))

    fisher = lambda t: F.struct((F.exp(-t["half"]) * (1 + t["half"] + t["half"] * t["half"] / 2)).alias("p_random"), t["p_text"].alias("p_text"))
    return _bound(_bound(_bound(_bound(symbols, sums), statistics), p_values), fisher)


def discoveries(candidates: Column, rate: float = 0.05, keep: float = 0.001) -> Column:
    """The candidates' spans that are random, at false discovery rate ``rate`` in the document."""
    nothing = F.struct(F.lit(0.0).alias("p_random"), F.lit(1.0).alias("p_text"))

    def tested(x: Column) -> Column:
        bare = F.rtrim(x["value"], F.lit("="))
        tests = None
        for name, pattern, alphabet in ENCODINGS:
            one = battery(bare, alphabet, TEXT_MATCH[name])
            tests = F.when(bare.rlike(pattern), one) if tests is None else tests.when(bare.rlike(pattern), one)
        p = tests.otherwise(nothing)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), p.alias("p"))

    def p_value(x: Column) -> Column:
        return F.when(x["p"]["p_random"] < keep, F.lit(1.0)).otherwise(x["p"]["p_text"])

    def stepped(all_: Column) -> Column:
        """Each value is bound once: the sorted p-values, then the largest one under its step."""
        limit = lambda ps: F.coalesce(F.array_max(F.filter(ps, lambda p, i: p <= (i + 1) * (F.lit(rate) / F.size(ps)))), F.lit(-1.0))
        limits = F.transform(F.array(F.array_sort(F.transform(all_, p_value))), limit)
        passing = F.flatten(F.transform(limits, lambda most: F.filter(all_, lambda x: p_value(x) <= most)))
        return F.transform(passing, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    return _bound(F.transform(candidates, tested), stepped)


def _tops_before(values: Column) -> Column:
    """Of each place the largest of all values before it, -1 at the first; by the largest of whole blocks."""

    def tops(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda b: F.array_max(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))

    def before(x: Column) -> Column:
        block = lambda i: F.floor(i / BLOCK).cast("int")
        inside = lambda i: F.array_max(F.slice(x["v"], block(i) * BLOCK + 1, i - block(i) * BLOCK))
        return F.transform(x["v"], lambda _, i: F.greatest(F.array_max(F.slice(x["tops"], F.lit(1), block(i))), inside(i), F.lit(-1).cast("long")))

    return _bound(_bound(values, lambda v: F.struct(v.alias("v"), tops(v).alias("tops"))), before)


def _merged(spans: Column) -> Column:
    """array<struct<start, end>> of one span at least, by start, overlapping ones joined."""

    def heads(s: Column) -> Column:
        """(start, largest end before) of the spans that begin behind all before them, then the largest end of all."""
        places = F.arrays_zip(F.transform(s, lambda x: x["start"]).alias("start"), _tops_before(F.transform(s, lambda x: x["end"])).alias("top"))
        last = F.struct(F.lit(0).cast("long").alias("start"), F.array_max(F.transform(s, lambda x: x["end"])).alias("top"))
        return F.concat(F.filter(places, lambda x: x["start"] >= x["top"]), F.array(last))

    def joined(h: Column) -> Column:
        return F.zip_with(F.slice(h, F.lit(1), F.size(h) - 1), F.slice(h, F.lit(2), F.size(h)), lambda x, y: F.struct(x["start"].alias("start"), y["top"].alias("end")))

    return _bound(_bound(F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))), heads), joined)


def _apart(spans: Column, base: Column) -> Column:
    """The ``spans`` that overlap none of ``base`` (disjoint ones by start): the first base that ends behind a span's start begins behind its end."""

    def passed(b: Column) -> Column:
        """By blocks of bases: their last ends."""
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(b) - 1) / BLOCK).cast("int")), lambda k: F.get(b, F.least(k * BLOCK + BLOCK, F.size(b)) - 1)["end"])

    def kept(x: Column, b: Column) -> Column:
        whole = F.size(F.filter(b["lasts"], lambda e: e <= x["start"])) * BLOCK
        part = F.filter(F.slice(b["base"], whole + 1, F.lit(BLOCK)), lambda y: y["end"] > x["start"])
        return F.coalesce(F.get(part, 0)["start"] >= x["end"], F.lit(True))

    bound = _bound(base, lambda b: F.array(F.struct(b.alias("base"), passed(b).alias("lasts"))))
    return F.flatten(F.transform(bound, lambda b: F.filter(spans, lambda x: kept(x, b))))


def scan(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """doc_id, text and spans: array<struct<start, kind_no, end, kind>>, by start, then kind."""
    docs = spread(docs).withColumn("text", F.coalesce("text", F.lit("")))
    lower, text = ascii_lower(F.col("text")), F.col("text")
    docs = docs.withColumn("_lower", lower)
    named = F.lit(False)
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        named = named | F.contains("_lower", F.lit(word))
    kind = lambda no: (lambda x: F.struct(x["start"].alias("start"), F.lit(no).alias("kind_no"), x["end"].alias("end"), F.lit(KINDS[no]).alias("kind")))
    docs = docs.withColumns({
        "_assign": F.filter(matches(F.col("_lower"), ASSIGN, named, 2), lambda x: F.char_length(x["value"]) >= 8),
        "_access": matches(text, ACCESS, F.contains(text, F.lit("AKIA"))),
        "_hex": matches(text, HEX, text.rlike(HEX)),
        "_runs": matches(text, RUNS[0], text.rlike(r"[A-Za-z0-9+/_-]{20}") & text.rlike("[0-9]")),
    })
    base = F.array_sort(F.concat(*[F.transform(c, kind(i)) for i, c in enumerate(("_assign", "_access", "_hex"))]))
    mixed = lambda runs: F.filter(runs, lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]"))
    docs = docs.withColumn("_base", base).withColumn("_runs", mixed(F.col("_runs")))
    # Every other run lies in one of these, and differs from it only where that holds '+', '/', '_' or '-'.
    parted = F.exists("_runs", lambda x: x["value"].rlike("[+/_-]"))
    docs = docs.withColumn("_runs", F.array_sort(F.concat("_runs", *[mixed(matches(text, run, parted)) for run in RUNS[1:]])))
    # Equal runs of several sets are neighbours now; the first stays.
    docs = docs.withColumn("_runs", F.filter("_runs", lambda x, i: (i == 0) | (F.get("_runs", i - 1) != x)))
    none = lambda of: F.array().cast(f"array<struct<{of}>>")
    docs = docs.withColumn("_found", F.when(F.size("_runs") == 0, none("start:bigint,end:bigint")).otherwise(discoveries(F.col("_runs"), rate)))
    docs = docs.withColumn("_found", F.when((F.size("_base") == 0) | (F.size("_found") == 0), F.col("_found")).otherwise(_apart(F.col("_found"), _merged(F.col("_base")))))
    found = F.when(F.size("_found") == 0, none("start:bigint,kind_no:int,end:bigint,kind:string")).otherwise(F.transform(_merged(F.col("_found")), kind(3)))
    docs = docs.withColumn("spans", F.array_sort(F.concat("_base", found)))
    return docs.drop("_lower", "_assign", "_access", "_hex", "_runs", "_base", "_found")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of every document's spans."""
    rows = scan(docs.select(F.col("doc_id").cast("long"), "text"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda x: x["kind_no"] < 3)
    return rows.select("doc_id", *map(count, KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """Documents with every span (overlaps merged by the leftmost) replaced by ``mask``; n_chars
    follows the new text. Documents without spans stay as they are."""
    columns = docs.columns
    rows = scan(docs.select("text", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_doc")))

    def masked(text: Column, spans: Column) -> Column:
        """Blocks of the text, each without its parts of the spans; so time is in proportion to the text."""

        def cut(block: Column, at: Column, all_: Column) -> Column:
            end = at + F.char_length(block)
            first = F.struct(F.lit("").alias("out"), at.alias("at"))

            def step(s: Column, x: Column) -> Column:
                begin = F.greatest(x["start"], s["at"])
                kept = F.substring(block, (s["at"] - at).cast("int") + 1, (begin - s["at"]).cast("int"))
                return F.struct(F.concat(s["out"], kept, F.when(x["start"] >= at, F.lit(mask)).otherwise(F.lit(""))).alias("out"), F.greatest(s["at"], F.least(x["end"], end)).alias("at"))

            rest = lambda s: F.concat(s["out"], F.substring(block, (s["at"] - at).cast("int") + 1, (end - s["at"]).cast("int")))
            return F.aggregate(F.filter(all_, lambda x: (x["start"] < end) & (x["end"] > at)), first, step, rest)

        blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{MASKED}}}"), F.lit(0))
        bound = F.array(F.struct(blocks.alias("blocks"), _merged(spans).alias("all")))
        joined = F.transform(bound, lambda b: F.array_join(F.transform(b["blocks"], lambda x, i: cut(x, i.cast("long") * MASKED, b["all"])), ""))
        return F.element_at(joined, 1)

    some = F.size("spans") > 0
    rows = rows.withColumn("_text", F.when(some, masked(F.col("text"), F.col("spans"))).otherwise(F.col("_doc")["text"]))
    new = {"text": F.col("_text"), "n_chars": F.when(some, F.char_length("_text").cast("long"))}
    return rows.select(*[(F.coalesce(new[c], F.col("_doc")[c]) if c in new else F.col("_doc")[c]).alias(c) for c in columns])
