"""Winnowed document fingerprints, in DataFrame expressions only.

A text becomes tokens: runs of at most ``cut`` characters that aren't white space. A longer run (a script without
spaces, minified code) gives a token at every character, the ``cut`` characters from there on, so tokens don't
depend on where the run begins. Every run of ``k`` tokens has a Karp-Rabin rolling hash: the tokens' hashes as digits of
a number in base ``BASE`` modulo a prime, evaluated over whole arrays by shifting them against each other (a
lambda keeps no state from one place to the next). In each window of ``w`` successive hashes the smallest is chosen, the rightmost of
equal ones, and kept with its position. Two texts that share ``w + k - 1`` successive tokens (in a long run: ``w + k + cut - 2``
characters) share a fingerprint at least; none shorter than ``k`` tokens is ever matched.

Hash and position share a long, hash above and position (counted down) below, so that one
``least`` finds the minimum with rightmost ties.

Null text counts as empty; a text without tokens has an empty fingerprint; one with fewer than
``k`` tokens has the hash of all; one with fewer than ``w`` hashes is one window. Two empty fingerprints
have likeness 1, an empty and another 0. Repeated rows and ids are kept; null ids come last in
the order of documents. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITION_BITS = 28
POSITIONS = (1 << POSITION_BITS) - 1
#: The largest prime below 2**35, and a base whose products with it fit in a long.
PRIME, BASE = (1 << 35) - 31, 94_906_249


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def token_pattern(cut: int) -> str:
    """Group 1 is the token: a whole short run, or what follows a place within a long one, which goes on by a character."""
    short = rf"(?<!\S)\S{{1,{cut}}}(?!\S)"
    return rf"(?=({short}|\S{{1,{cut}}}))(?:{short}|\S)"


def grams(text: Column, k: int, cut: int) -> Column:
    """Packed (hash, position) of every run of ``k`` tokens, in order; of all tokens, where there are fewer."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(token_pattern(cut)), F.lit(1))
    tokens = F.transform(found, lambda t: F.pmod(F.xxhash64(t), F.lit(PRIME)))

    def rolled(h: Column) -> Column:
        digit = lambda a, b: F.pmod(a * F.lit(BASE) + b, F.lit(PRIME))
        width = F.size(h) - (k - 1)
        value = F.slice(h, F.lit(1), width)
        for j in range(1, k):
            value = F.zip_with(value, F.slice(h, F.lit(j + 1), width), digit)
        few = F.array(F.aggregate(h, F.lit(0).cast("long"), digit))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(width < 1, few).otherwise(value)

    pack = lambda x, i: x * F.lit(1 << POSITION_BITS) + (F.lit(POSITIONS) - i)
    return F.transform(_bound(tokens, rolled), pack)


def windowed(packed: Column, w: int) -> Column:
    """The packed minima that any window of ``w`` chooses, in order of position."""

    def minima(v: Column) -> Column:
        count = F.greatest(F.size(v) - (w - 1), F.least(F.size(v), F.lit(1)))
        least = lambda x, i: reduce(F.least, [F.coalesce(F.get(v, i + j), x) for j in range(1, w)], x)
        return F.array_distinct(F.transform(F.slice(v, F.lit(1), count), least))

    return _bound(packed, minima)


def fingerprint(text: Column, k: int = 3, w: int = 4, cut: int = 12) -> Column:
    """array<bigint>: the chosen hashes with their positions."""
    return windowed(grams(text, k, cut), w)


def shown(chosen: Column) -> Column:
    """``hash@position`` of each choice, joined by spaces."""
    one = lambda x: F.concat(F.lower(F.hex(F.shiftright(x, POSITION_BITS))), F.lit("@"), (F.lit(POSITIONS) - x.bitwiseAND(F.lit(POSITIONS))).cast("string"))
    return F.array_join(F.transform(chosen, one), " ")


def hash_set(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, POSITION_BITS)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def quantile_bounds(docs: DataFrame, ranges: int, accuracy: int) -> list[int]:
    """Ascending ids between which about equal numbers of documents lie; an id that many documents share is repeated."""
    shares = [i / ranges for i in range(1, ranges)]
    got = docs.agg(F.percentile_approx("doc_id", shares, accuracy)).first()[0]
    return [int(x) for x in got or []]


def slot_of(bounds: list[int], side: int = 64) -> tuple[Column, Column]:
    """(how many bounds are at most the id, how many equal it), found by blocks of ``side`` bounds; null for a null id."""
    blocks = [bounds[i : i + side] for i in range(0, len(bounds), side)]
    numbers = lambda x: F.array(*[F.lit(v) for v in x]).cast("array<bigint>")
    lasts, nested, id_ = numbers([b[-1] for b in blocks]), F.array(*[numbers(b) for b in blocks]), F.col("doc_id")
    whole = F.size(F.filter(lasts, lambda x: x < id_))
    inside = F.coalesce(F.get(nested, whole), F.array().cast("array<bigint>"))
    below = whole * side + F.size(F.filter(inside, lambda x: x < id_))
    first = {}
    for i, x in enumerate(bounds):
        first.setdefault(x, [i, 0])[1] += 1
    repeated = {x: n for x, (_, n) in first.items() if n > 1}
    equal = F.coalesce(F.get(F.map_values(F.map_filter(F.create_map(*[F.lit(y) for x in repeated.items() for y in x]), lambda key, _: key == id_)), 0), F.lit(1)) if repeated else F.lit(1)
    return below, equal


def with_next(docs: DataFrame, columns: list[str], ranges: int | None = None) -> DataFrame:
    """Adds next_<c> of the document that follows by descending doc_id; after the last, the first.

    Ids fall into ranges of about equal numbers of documents, by approximate quantiles; an id that fills several of them, and rows
    without an id, are spread over ranges by their texts' hashes. The first document of a range also goes to the range
    before it as a guest, so each range finds its own neighbours; no task sees all documents.
    Ties follow the text's hash.
    """
    spark = docs.sparkSession
    ranges = ranges or max(4096, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = quantile_bounds(docs, ranges, 4 * ranges)
    tie = F.xxhash64("text")
    share = lambda n: F.floor(F.shiftrightunsigned(tie.bitwiseXOR(F.lit(-(2**63))), 33) * n / F.lit(2**31)).cast("long")  # noqa: E731 - 0 to n - 1, ascending with the hash
    below, equal = slot_of(bounds) if bounds else (F.lit(0), F.lit(1))
    at = F.when(F.col("doc_id").isNull(), share(F.lit(ranges)) - ranges).otherwise(below.cast("long") + F.when(equal > 1, share(equal)).otherwise(F.lit(0)))
    rows = docs.withColumns({"range": at, "tie": tie})
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    # One small row per range that holds documents; the first row's guest goes to the last range.
    heads = rows.groupBy("range").agg(F.max(key).alias("head"))
    following = Window.orderBy("range")
    heads = heads.withColumn("host", F.coalesce(F.lead("range").over(following), F.min("range").over(Window.partitionBy())))
    heads = heads.select(F.col("range").alias("r"), "head", "host")
    rows = rows.join(F.broadcast(heads), (F.col("range") == F.col("r")) & (key.eqNullSafe(F.col("head"))), "left")
    place = lambda r, guest: F.struct(r.alias("slot"), F.lit(guest).alias("guest"))
    places = F.when(F.col("host").isNull(), F.array(place(F.col("range"), False))).otherwise(F.array(place(F.col("range"), False), place(F.col("host"), True)))
    rows = rows.select("doc_id", "tie", *columns, F.explode(places).alias("place")).select("doc_id", "tie", *columns, "place.*")
    return rows.withColumns({f"next_{c}": F.lead(c).over(in_order()) for c in columns})


def in_order() -> Window:
    """Descending ids within a range, its guest last."""
    return Window.partitionBy("slot").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("tie"))


def edited_text(text: Column, following: Column) -> Column:
    """The last third replaced by as many first characters (or all) of the next text."""
    n = F.char_length(text)
    tail = F.floor(n / 3).cast("int")
    return F.concat(F.left(text, n - tail), F.left(following, tail))


def fingerprints(docs: DataFrame, k: int = 3, w: int = 4, cut: int = 12) -> DataFrame:
    """doc_id, text, chosen: a row per document with its fingerprint."""
    return docs.select("doc_id", "text", fingerprint(F.col("text"), k, w, cut).alias("chosen"))


def edit_report(docs: DataFrame, k: int = 3, w: int = 4, cut: int = 12) -> DataFrame:
    """Every document's fingerprint against its edited text's and the next document's."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, ["text"])
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", "tie", "slot", "guest", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text"), k, w, cut).alias("own"), fingerprint(F.col("edited"), k, w, cut).alias("changed"))
    rows = rows.withColumn("own_set", hash_set(F.col("own")))
    rows = rows.withColumn("next_set", F.lead("own_set").over(in_order())).filter(~F.col("guest"))
    return rows.select("doc_id", "n_chars", "edited_sha256", shown(F.col("own")).alias("fingerprint"), shown(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own_set"), hash_set(F.col("changed"))).alias("near_edited"), likeness(F.col("own_set"), F.col("next_set")).alias("near_next"))
