"""Language-model scores from a hierarchical Pitman-Yor model.

Restaurants of words serve the tokens of the training texts, one for each context (a column of the
training documents, such as the language); they share one parent, whose customers are their tables. The
parent's base, which prices a word that opens a new table there, spells the word letter by letter in
restaurants of letter contexts: the context of four letters has the one of three as its parent,
that the one of two, and so on to a root over single letters; contexts with the same ending share their
parents. So letters are learned from types, and frequent words from tokens. Each text opens a
restaurant of its own (discount 0) below its context's, so that it predicts its own repetitions. A text's
context isn't given to scoring: its probability is the mixture over contexts, weighted by their training texts.

Seating is sampled by Gibbs at every level: a dish's customers in a restaurant leave and sit down again given all
others' seats; tables are the customers of the level above, and the tables of the words' parent are what the
letters' restaurants are told. Up to 32 customers of a dish are seated by an exact draw; the rest of a
larger party follows one by one and in growing groups. Words meet only in their restaurants' totals, so tasks sweep
their words side by side, several times a round; after each round the totals and the letters are renewed. Independent
chains give one state each, after all earlier sweeps as burn-in; the mean of their predictive probabilities
scores the tokens. No restaurant knows the words before.

Contexts see the 62 most frequent letters singly (a boundary and one class for all others make
64), the fourth letter in 8 classes; 1022 letters are dishes of their own. So the letters' model has a
size that the corpus can't exceed, and alone goes to the driver. Counts of words cover all texts, are
kept in tables and joined by shuffle; the ``head`` most frequent words are broadcast and never shuffled.

Null text counts as empty (its end token only). Repeated rows and ids are scored as often as they
occur; a null id counts as empty text in the split. Without training texts the words' restaurant is
empty and the spelling uniform. Null or rare context values are one context of their own. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.llm.common import small_batches, spread, written

DISH_BITS, LETTERS, BUCKETS, COARSE = 10, 1022, 64, 8
#: How many restaurants of a level share a parent, from the first level of context up.
FAN = (BUCKETS, BUCKETS, BUCKETS, COARSE)
END, OTHER, CODE_POINTS = 0, 1, 0x110000
FLUSH = 400_000
#: Up to so many customers of a dish are seated by an exact draw, in chunks of so many dishes.
EXACT, CHUNK = 32, 1 << 16


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; cut at ASCII white space only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _read(words: list[bytes]) -> pd.Series:
    """Words as strings, read at one go: none of them holds a line break."""
    return pd.Series(b"\n".join(words).decode("utf-8", "replace").split("\n") if words else [], dtype=object)


def word_counts(docs: DataFrame, contexts: int) -> DataFrame:
    """docs: train, z, text -> (word, c0, c1, ...): every word of all texts with its counts in the training texts
    of each context; the end token is ''."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: list[Counter] = [Counter() for _ in range(contexts)]
        other: set[bytes] = set()

        def flushed() -> pd.DataFrame:
            rest = other.difference(*known)
            listed = [w for counts in known for w in counts] + list(rest)
            z = np.repeat(np.arange(contexts + 1, dtype=np.int32) % contexts, [*map(len, known), len(rest)])
            c = np.array([n for counts in known for n in counts.values()] + [0] * len(rest), dtype=np.int64)
            for x in (*known, other):
                x.clear()
            return pd.DataFrame({"word": _read(listed), "z": z, "c": c})

        for batch in batches:
            for train, z, text in zip(batch["train"], batch["z"], batch["text"], strict=True):
                found = tokens(text)
                found.append(b"")
                (known[z] if train else other).update(found)
                if len(other) + sum(map(len, known)) > FLUSH:
                    yield flushed()
        yield flushed()

    small_batches(docs.sparkSession)
    rows = spread(docs.select("train", "z", "text")).mapInPandas(count, "word string, z int, c long")
    each = [F.sum(F.when(F.col("z") == z, F.col("c")).otherwise(F.lit(0))).alias(f"c{z}") for z in range(contexts)]
    return rows.groupBy("word").agg(*each)


class Spelling:
    """Words as (context, dish) keys over an alphabet of code points, most frequent first."""

    def __init__(self, alphabet: list[int]):
        order = np.argsort(np.array(alphabet, dtype=np.int64))
        self.points = np.array(alphabet, dtype=np.int64)[order]
        self.symbols = order + 2

    def keys(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For every letter and every word's end: the key of its longest context and dish, the word's place."""
        raw = np.frombuffer(("\n".join(words) + "\n").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        ends = raw == 10
        at = np.searchsorted(self.points, raw)
        inside = at < len(self.points)
        symbol = np.full(len(raw), OTHER)
        hit = inside.copy()
        hit[inside] = self.points[at[inside]] == raw[inside]
        symbol[hit] = self.symbols[at[hit]]
        symbol[ends] = END
        word = np.concatenate([[0], np.cumsum(ends)[:-1]])
        starts = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
        offset = np.arange(len(raw)) - starts[word]
        context = np.zeros(len(raw), dtype=np.int64)
        for k, fan in enumerate(FAN, 1):
            before = np.zeros(len(raw), dtype=np.int64)
            before[k:] = symbol[:-k]
            before[offset < k] = END
            context = context * fan + (np.minimum(before, BUCKETS - 1) if fan == BUCKETS else before % fan)
        return (context << DISH_BITS) | symbol, word


@lru_cache(maxsize=64)
def stirling(d: float) -> np.ndarray:
    """Logs of generalized Stirling numbers [customers, tables]: the seatings of so many customers at so many
    tables, each weighted by what its tables' sizes contribute under discount ``d``."""
    out = np.zeros((EXACT + 1, EXACT + 1))
    out[1, 1] = 1.0
    for n in range(1, EXACT):
        out[n + 1, 1:] = out[n, :-1] + (n - d * np.arange(1, EXACT + 1)) * out[n, 1:]
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(out, 0.0))


def seat(c: np.ndarray, a: np.ndarray, d: float, uniform, step: np.ndarray | float = 0.0) -> np.ndarray:
    """Tables of ``c`` customers of a dish who all left and sit down again.

    ``a``: the weight of a second table once there is a first, growing by ``step`` with each table.
    The first 32 customers' tables are drawn exactly; the others come one by one, then in
    growing parties which open their expected number of tables, randomly rounded.
    ``uniform(active, step)`` gives random numbers.
    """
    t, first = np.minimum(c, 1).astype(np.float64), np.minimum(c, EXACT)
    step = np.broadcast_to(np.asarray(step, dtype=np.float64), np.shape(c))
    width = 2
    while width <= EXACT:
        rows = np.flatnonzero((first > width // 2) & (first <= width))
        for at in np.array_split(rows, len(rows) // CHUNK + 1):
            if len(at):
                logs = stirling(d)[first[at].astype(np.int64), 1 : width + 1]
                weight = np.maximum(a[at, None] + step[at, None] * np.arange(width - 1), 1e-300)
                logs[:, 1:] += np.cumsum(np.log(weight), axis=1)
                p = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
                t[at] = 1.0 + (p < (uniform(at, 0) * p[:, -1])[:, None]).sum(axis=1)
        width *= 2
    done, turn = first.astype(np.float64), 0
    active = np.flatnonzero(c > EXACT)
    while len(active):
        turn += 1
        party = np.minimum(np.maximum(1.0, np.floor(done[active] / 16)), c[active] - done[active])
        weight = a[active] + step[active] * (t[active] - 1)
        opened = np.floor(party * (weight / (weight + done[active] - d * t[active])) + uniform(active, turn))
        t[active] += np.minimum(party, opened)
        done[active] += party
        active = active[done[active] < c[active]]
    return t


def discount(c: np.ndarray) -> float:
    n1, n2 = float((c == 1).sum()), float((c == 2).sum())
    return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


class Letters:
    """Sampled restaurants of letter contexts, as arrays; ``log10`` isn't taken here."""

    def __init__(self, size: int, samples: int):
        self.size, self.samples = size, samples
        self.cells: list[np.ndarray] = []
        self.direct: list[np.ndarray] = []
        self.rooms: list[np.ndarray] = []
        self.back: list[np.ndarray] = []

    def state(self) -> tuple:
        """Plain values, which a broadcast can carry."""
        return self.size, self.samples, self.cells, self.direct, self.rooms, self.back

    @staticmethod
    def of(state: tuple) -> "Letters":
        out = Letters(*state[:2])
        out.cells, out.direct, out.rooms, out.back = state[2:]
        return out

    @staticmethod
    def joined(chains: list["Letters"]) -> "Letters":
        """The samples of chains over the same cells side by side."""
        out = Letters(chains[0].size, sum(x.samples for x in chains))
        out.cells, out.rooms = chains[0].cells, chains[0].rooms
        out.direct = [np.concatenate(x, axis=1) for x in zip(*(x.direct for x in chains), strict=True)]
        out.back = [np.concatenate(x, axis=1) for x in zip(*(x.back for x in chains), strict=True)]
        return out

    def grams(self, keys: np.ndarray) -> np.ndarray:
        """Predictive probabilities [key, sample] of dishes in their contexts."""
        dish, context = keys & ((1 << DISH_BITS) - 1), keys >> DISH_BITS
        contexts = [context]
        for fan in reversed(FAN):
            contexts.append(contexts[-1] // fan)
        p = np.full((len(keys), self.samples), 1.0 / self.size)
        for room, cells, direct, rooms, back in zip(reversed(contexts), self.cells, self.direct, self.rooms, self.back, strict=True):
            if not len(rooms):
                continue
            at = np.minimum(np.searchsorted(rooms, room), len(rooms) - 1)
            open_ = rooms[at] == room
            key = (room << DISH_BITS) | dish
            cell = np.minimum(np.searchsorted(cells, key), len(cells) - 1)
            share = np.where((cells[cell] == key)[:, None], direct[cell], 0.0)
            p = np.where(open_[:, None], share + back[at] * p, p)
        return np.where((dish == OTHER)[:, None], p / CODE_POINTS, p)

    def words(self, spelling: Spelling, words: list[str]) -> np.ndarray:
        """Probabilities [word, sample] of whole words with their ends."""
        if not words:
            return np.zeros((0, self.samples))
        keys, word = spelling.keys(words)
        seen, at = np.unique(keys, return_inverse=True)
        logs = np.log(self.grams(seen))[at]
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        return np.exp(np.maximum(np.add.reduceat(logs, firsts, axis=0), -700.0))


def sample_letters(keys: np.ndarray, counts: np.ndarray, size: int, sweeps: int = 12, samples: int = 4, seed: int = 11, strength: float = 1.0) -> Letters:
    """Gibbs over the restaurants that the longest contexts' ``counts`` (by sorted ``keys``) imply."""
    rng, depth = np.random.default_rng(seed), len(FAN)
    cells, up, rooms, of = [None] * (depth + 1), [None] * (depth + 1), [None] * (depth + 1), [None] * (depth + 1)
    cells[depth] = keys
    for k in range(depth, 0, -1):
        above = (((cells[k] >> DISH_BITS) // FAN[k - 1]) << DISH_BITS) | (cells[k] & ((1 << DISH_BITS) - 1))
        cells[k - 1], up[k] = np.unique(above, return_inverse=True)
    for k in range(depth + 1):
        rooms[k], of[k] = np.unique(cells[k] >> DISH_BITS, return_inverse=True)
    c, t = [None] * (depth + 1), [None] * (depth + 1)
    c[depth] = counts.astype(np.float64)
    for k in range(depth, -1, -1):
        t[k] = np.minimum(c[k], 1.0)
        if k:
            c[k - 1] = np.bincount(up[k], t[k], minlength=len(cells[k - 1]))
    d = [discount(x) for x in c]
    out = Letters(size, samples)

    def parts(k: int) -> tuple[np.ndarray, np.ndarray]:
        total = np.bincount(of[k], c[k], minlength=len(rooms[k])) + strength
        tables = np.bincount(of[k], t[k], minlength=len(rooms[k]))
        return np.maximum(c[k] - d[k] * t[k], 0.0) / total[of[k]], (strength + d[k] * tables) / total

    kept = []
    for sweep in range(sweeps if len(keys) else 0):
        for k in range(depth, -1, -1):
            p = np.full(len(cells[0]), 1.0 / size)
            for j in range(k):
                direct, back = parts(j)
                p = direct + back[of[j]] * (p if j == 0 else p[up[j]])
            base = p if k == 0 else p[up[k]]
            tables = np.bincount(of[k], t[k], minlength=len(rooms[k]))[of[k]] - t[k]
            t[k] = seat(c[k], (strength + d[k] * (tables + 1)) * base, d[k], lambda active, _: rng.random(len(active)), d[k] * base)
            if k:
                c[k - 1] = np.bincount(up[k], t[k], minlength=len(cells[k - 1]))
        if sweep >= sweeps - samples:
            kept.append([parts(k) for k in range(depth + 1)])
    for k in range(depth + 1):
        out.cells.append(cells[k])
        out.rooms.append(rooms[k])
        out.direct.append(np.stack([s[k][0] for s in kept], axis=1).astype(np.float32) if kept else np.zeros((0, samples), np.float32))
        out.back.append(np.stack([s[k][1] for s in kept], axis=1).astype(np.float32) if kept else np.zeros((0, samples), np.float32))
    return out


def fit_alphabet(words: DataFrame, counts: list[str]) -> list[int]:
    """The most frequent letters of the words of training texts, as code points."""

    def points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            found, n = np.unique(np.frombuffer("".join(batch["word"]).encode("utf-32-le", "surrogatepass"), dtype="<u4"), return_counts=True)
            total.update(dict(zip(found.tolist(), n.tolist(), strict=True)))
        yield pd.DataFrame(list(total.items()), columns=["point", "n"], dtype="int64")

    words.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    found = _trained(words, counts).select("word").mapInPandas(points, "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))
    return [r["point"] for r in found.orderBy(F.desc("n"), "point").limit(LETTERS).collect()]


def fit_letters(words: DataFrame, counts: list[str], alphabet: list[int], samples: int, seated: bool) -> Letters:
    """Letters, which words' tables in their parent ask for: a chain for each sample of up<sample>, or, before
    words are ``seated`` and all have one table, a single chain that gives all samples."""
    customers = [f"up{s}" for s in range(samples)] if seated else ["up0"]
    words = words if seated else words.withColumn("up0", F.lit(1))

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spelling, total = Spelling(alphabet), None
        for batch in batches:
            if len(batch):
                keys, word = spelling.keys(batch["word"].tolist())
                part = pd.DataFrame(batch[customers].to_numpy(dtype=np.int64)[word], index=keys).groupby(level=0).sum()
                total = part if total is None else total.add(part, fill_value=0)
        if total is not None:
            out = pd.DataFrame(total.to_numpy(dtype=np.int64), columns=customers)
            out.insert(0, "key", total.index.to_numpy(dtype=np.int64))
            yield out

    rows = _trained(words, counts).select("word", *customers).mapInPandas(grams, "key long, " + ", ".join(f"{x} long" for x in customers))
    got = rows.groupBy("key").agg(*[F.sum(x).alias(x) for x in customers]).orderBy("key").toPandas()
    keys = got["key"].to_numpy(dtype=np.int64)
    each = 1 if seated else samples
    return Letters.joined([sample_letters(keys, got[x].to_numpy(dtype=np.int64), len(alphabet) + 2, samples=each, seed=11 + s) for s, x in enumerate(customers)])


def _trained(words: DataFrame, counts: list[str]) -> DataFrame:
    return words.filter(F.greatest(*[F.col(c) for c in counts], F.lit(0)) > 0)


class Sizes:
    """Totals of the word restaurants: by context (and sample), then of their parent."""

    def __init__(self, tokens_: list[int], tables, parent_customers, parent_tables, d: tuple[float, float], strength: float):
        self.tokens, self.tables = np.array(tokens_, dtype=float)[:, None], np.array(tables, dtype=float)
        self.customers, self.parents = np.array(parent_customers, dtype=float), np.array(parent_tables, dtype=float)
        self.d, self.strength = d, strength

    def others(self, s: int, t: np.ndarray, up: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What sample ``s`` holds of all other words: tables by context, the parent's customers and tables."""
        return self.tables[:, s] - t, self.customers[s] - t.sum(axis=1), self.parents[s] - up

    def parent(self, customers: np.ndarray, tables: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Predictive probabilities in the parent, [word, sample]."""
        d, total = self.d[0], self.customers + self.strength
        return np.maximum(customers - d * tables, 0.0) / total + (self.strength + d * self.parents) / total * spelled

    def context(self, c: np.ndarray, t: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Predictive probabilities in every context, [word, context, sample]."""
        d, total = self.d[1], self.tokens + self.strength
        return np.maximum(c[:, :, None] - d * t, 0.0) / total + (self.strength + d * self.tables) / total * above[:, None, :]


def seat_columns(contexts: int, samples: int) -> list[str]:
    return [*(f"t{z}_{s}" for z in range(contexts) for s in range(samples)), *(f"up{s}" for s in range(samples))]


def swept_words(words: DataFrame, alphabet: list[int], model: Letters, sizes: tuple, contexts: int, samples: int, sweeps: int, seed: int, last: bool) -> DataFrame:
    """``words`` with its tables t<context>_<sample> and up<sample> after ``sweeps`` more sweeps, and, the ``last``
    time, spelling probabilities p<sample>. Without tables in ``words`` each word begins with one in each of its
    contexts and in the parent. ``sizes``: Sizes' values of all seats as they are in ``words``."""
    shared = words.sparkSession.sparkContext.broadcast((alphabet, model.state()))
    counts, tables = [f"c{z}" for z in range(contexts)], seat_columns(contexts, samples)
    begun = tables[0] in words.columns

    def sit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        alphabet, model = shared.value[0], Letters.of(shared.value[1])
        spelling, size = Spelling(alphabet), Sizes(*sizes)
        for batch in batches:
            if not len(batch):
                continue
            listed, c = batch["word"].tolist(), batch[counts].to_numpy(dtype=np.float64)
            if begun:
                seats = batch[tables].to_numpy(dtype=np.float64)
                t, up = seats[:, : contexts * samples].reshape(*c.shape, samples), seats[:, contexts * samples :]
            else:
                t = np.repeat(np.minimum(c, 1.0)[:, :, None], samples, axis=2)
                up = t.max(axis=1)
            # A single customer has no choice, so words that have but one stay as they are.
            busy = np.flatnonzero(c.sum(axis=1) > 1)
            p = model.words(spelling, listed if last else [listed[i] for i in busy])
            # Random numbers come from the word, so a task that runs again seats alike.
            roots = np.fromiter((xxhash.xxh64_intdigest(listed[i].encode("utf-8", "surrogatepass"), seed) for i in busy), dtype=np.uint64, count=len(busy))
            known = p[busy] if last else p
            for s in range(samples):
                numbers = lambda at, s=s: lambda active, step: _uniform(roots[active] + np.uint64(((step * sweeps + sweep) * samples + s) * 64 + at))  # noqa: B023, E731
                now, above = t[busy, :, s], up[busy, s]
                others = size.others(s, now, above)
                for sweep in range(sweeps):
                    now, above = sweep_once(c[busy], now, above, known[:, s], others, size, numbers)
                t[busy, :, s], up[busy, s] = now, above
            seated = pd.DataFrame(np.hstack([t.reshape(len(c), -1), up]).astype(np.int64), columns=tables)
            parts = [batch[["word", *counts]].reset_index(drop=True), seated]
            yield pd.concat([*parts, pd.DataFrame(p, columns=spelled)] if last else parts, axis=1)

    spelled = [f"p{s}" for s in range(samples)]
    fields = ["word string", *(f"{x} long" for x in (*counts, *tables)), *(f"{x} double" for x in spelled if last)]
    return words.mapInPandas(sit, ", ".join(fields))


def sweep_once(c: np.ndarray, t: np.ndarray, up: np.ndarray, p: np.ndarray, others: tuple, size: Sizes, numbers) -> tuple[np.ndarray, np.ndarray]:
    """One Gibbs sweep over words (rows): in each context the word's customers leave and sit down again given all
    other seats, whose tables take their customers along from the parent; then those in the parent."""
    t, (rooms, customers, parents), d, strength = t.copy(), others, size.d, size.strength
    for z in range(c.shape[1]):
        rest = t.sum(axis=1) - t[:, z]
        served = np.where(rest > 0, np.minimum(up, rest), 1.0)
        new = (strength + d[1] * (rooms[:, z] + 1)) / (customers + rest + 1 + strength)
        spelled = (strength + d[0] * (parents + served)) * p
        t[:, z] = seat(c[:, z], new * (np.maximum(rest + 1 - d[0] * served, 0.0) + spelled), d[1], numbers(z), new)
    return t, seat(t.sum(axis=1), (strength + d[0] * (parents + 1)) * p, d[0], numbers(63), d[0] * p)


def priced_words(seated: DataFrame, sizes: tuple, contexts: int, samples: int) -> DataFrame:
    """(word, c, f<context>): the count in training texts and the mean predictive probability over
    the samples."""
    counts, tables = [f"c{z}" for z in range(contexts)], seat_columns(contexts, samples)

    def price(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = Sizes(*sizes)
        for batch in batches:
            if not len(batch):
                continue
            c, seats = batch[counts].to_numpy(dtype=np.float64), batch[tables].to_numpy(dtype=np.float64)
            t, up = seats[:, : contexts * samples].reshape(*c.shape, samples), seats[:, contexts * samples :]
            p = batch[[f"p{s}" for s in range(samples)]].to_numpy(dtype=np.float64)
            full = np.maximum(size.context(c, t, size.parent(t.sum(axis=1), up, p)).mean(axis=2), 1e-300)
            out = pd.DataFrame(full, columns=[f"f{z}" for z in range(contexts)])
            out.insert(0, "word", batch["word"].to_numpy())
            out.insert(1, "c", c.sum(axis=1).astype(np.int64))
            yield out

    return seated.mapInPandas(price, "word string, c long, " + ", ".join(f"f{z} double" for z in range(contexts)))


def most_frequent(priced: DataFrame, most: int) -> pd.DataFrame:
    """At most ``most`` rows: those whose counts reach a level that a histogram of fixed size finds."""
    level = F.floor(F.log2("c") * 64).cast("int")
    found, at = 0, None
    for r in sorted(priced.filter("c > 0").groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["level"]):
        found += r["n"]
        if found > most:
            break
        at = r["level"]
    return priced.filter((F.col("c") > 0) & (level >= at) if at is not None else F.lit(False)).toPandas()


def _uniform(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def rising(a: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 of a (a + 1) ... (a + n - 1): the n customers of a dish with weight a in a restaurant
    without discount. Short products as they are, the rest by Stirling's series."""
    a, n = np.broadcast_arrays(np.asarray(a, dtype=np.float64), np.asarray(n, dtype=np.float64))
    out = np.log10(a)
    more = n > 1
    if more.any():
        x, y = a[more], a[more] + n[more]
        out[more] = (_log_gamma(y) - _log_gamma(x)) / math.log(10)
    return out


def _log_gamma(x: np.ndarray) -> np.ndarray:
    low = np.zeros_like(x)
    for i in range(8):
        low += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - low


def _discount(ones: int | None, twos: int | None) -> float:
    return min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones or twos else 0.5


def score(docs: DataFrame, held_out: Column, context: str | None = None, most_contexts: int = 15, head: int = 60_000, samples: int = 3, rounds: int = 2, sweeps: int = 4, strength: float = 1.0, own: float = 3000.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    ``context``: a column whose ``most_contexts`` most frequent values in training texts get restaurants of
    their own; other values, and nulls, share one. ``own``: the strength of a text's restaurant.
    Each of ``samples`` chains makes ``rounds`` times ``sweeps`` sweeps and gives its last state.
    """
    spark = docs.sparkSession
    value = F.col(context).cast("string") if context else F.lit(None).cast("string")
    docs = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), (~held_out).alias("train"), value.alias("value"), "text")
    sizes_of = {r["value"]: r["n"] for r in docs.filter("train").groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(most_contexts + 1).collect()}
    named = [v for v in sizes_of if v is not None][:most_contexts]
    contexts = len(named) + 1
    place = F.lit(contexts - 1)
    for z, v in enumerate(named):
        place = F.when(F.col("value") == v, F.lit(z)).otherwise(place)
    docs = docs.withColumn("z", F.coalesce(place, F.lit(contexts - 1)))
    texts = {r["z"]: r["n"] for r in docs.filter("train").groupBy("z").agg(F.count("*").alias("n")).collect()}
    weights = np.array([texts.get(z, 0) + 0.5 for z in range(contexts)])
    weights = np.log10(weights / weights.sum())

    words = written(word_counts(docs, contexts), "words")
    c = [F.col(f"c{z}") for z in range(contexts)]
    number = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    is_ = lambda x, n: (x == n).cast("int")
    total, rooms = sum(c[1:], c[0]), sum((is_(x > 0, True) for x in c[1:]), is_(c[0] > 0, True))
    got = words.agg(*[number(x) for x in c], *[number(is_(x > 0, True)) for x in c], number(rooms), number(is_(total > 0, True)), number(is_(rooms, 1)), number(is_(rooms, 2)), number(sum((is_(x, 1) for x in c[1:]), is_(c[0], 1))), number(sum((is_(x, 2) for x in c[1:]), is_(c[0], 2)))).first()
    tokens_, tables, (customers, types, p1, p2, k1, k2) = list(got[:contexts]), list(got[contexts : 2 * contexts]), got[2 * contexts :]
    n, d = sum(tokens_), (_discount(p1, p2), _discount(k1, k2))
    columns = [f"c{z}" for z in range(contexts)]
    alphabet, seated = fit_alphabet(words, columns), words
    sizes = (tokens_, [[x] * samples for x in tables], [customers] * samples, [types] * samples, d, strength)
    for turn in range(rounds):
        model = fit_letters(seated, columns, alphabet, samples, turn > 0)
        seated = written(swept_words(seated, alphabet, model, sizes, contexts, samples, sweeps, 7 + turn, turn == rounds - 1), "seated")
        sat = seated.agg(*[number(F.col(x)) for x in seat_columns(contexts, samples)]).first()
        t = np.array(sat[: contexts * samples], dtype=float).reshape(contexts, samples)
        sizes = (tokens_, t.tolist(), t.sum(axis=0).tolist(), list(sat[contexts * samples :]), d, strength)
    priced = written(priced_words(seated, sizes, contexts, samples), "priced")

    base = lambda count: F.log10((count + 0.5) / (n + 0.5 * (types + 1)))
    top = most_frequent(priced, head)
    places = {w.encode("utf-8", "surrogatepass"): i for i, w in enumerate(top["word"])}
    seen = top["c"].to_numpy(dtype=float)
    table = np.column_stack([seen > 0, np.log10((seen + 0.5) / (n + 0.5 * (types + 1))), own * top[[f"f{z}" for z in range(contexts)]].to_numpy(dtype=float)])
    shared = spark.sparkContext.broadcast((places, table))
    sums = ["known", "base", *(f"f{z}" for z in range(contexts))]

    def priced_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row per document for its head words, and a row per document and other word."""
        places, table = shared.value
        for batch in batches:
            heads, ids, many, names, sizes = [], [], [], [], []
            for key, doc, held, text in zip(batch["key"], batch["doc_id"], batch["held_out"], batch["text"], strict=True):
                found = tokens(text)
                found.append(b"")
                counts = Counter(found)
                ids.extend(map(places.get, counts, repeat(-1)))
                many.extend(counts.values())
                names.extend(counts)
                sizes.append(len(counts))
                # No word holds a line break, so this row meets no word and has a place of its own.
                heads.append((key, f"\n{key}", 1, [None if pd.isna(doc) else int(doc), int(held), len(found)]))
            out = pd.DataFrame(heads, columns=["key", "word", "n", "facts"])
            ids, many, owner = np.array(ids, dtype=np.int64), np.array(many, dtype=np.int64), np.repeat(np.arange(len(heads)), sizes)
            head = ids >= 0
            m, rows_ = many[head].astype(float)[:, None], table[ids[head]]
            each = np.bincount(owner[head], minlength=len(heads))
            parts = np.vstack([np.hstack([m * rows_[:, :2], rising(rows_[:, 2:], m)]), np.zeros((1, len(sums)))])
            by_doc = np.add.reduceat(parts, np.cumsum(each) - each, axis=0) if len(heads) else parts[:0]
            by_doc[each == 0] = 0.0
            by_doc[:, 2:] -= rising(np.full(len(heads), own), np.array([f[2] for f in out["facts"]], dtype=float))[:, None]
            yield out.assign(sums=list(by_doc))
            if not head.all():
                rest = list(compress(names, (~head).tolist()))
                yield pd.DataFrame({"key": out["key"].to_numpy()[owner[~head]], "word": _read(rest), "n": many[~head], "facts": None, "sums": None})

    small_batches(spark)
    fields = "key long, word string, n long, facts array<long>, sums array<double>"
    rows = spread(docs.select("doc_id", "held_out", "text")).withColumn("key", F.monotonically_increasing_id()).mapInPandas(priced_tokens, fields)
    rows = rows.join(priced, "word", "left")
    risen = lambda a: F.when(F.col("n") == 1, F.log10(a)).otherwise(F.aggregate(F.sequence(F.lit(0), F.col("n") - 1), F.lit(0.0), lambda x, j: x + F.log10(a + j)))
    price = {"known": F.col("n") * (F.col("c") > 0).cast("double"), "base": F.col("n") * base(F.col("c")), **{f"f{z}": risen(own * F.col(f"f{z}")) for z in range(contexts)}}
    rows = rows.select("key", *[F.col("facts")[i].alias(x) for i, x in enumerate(("doc_id", "held_out", "n_tokens"))], *[F.coalesce(F.col("sums")[i], price[x], F.lit(0.0)).alias(x) for i, x in enumerate(sums)])
    out = rows.groupBy("key").agg(*[F.max(x).alias(x) for x in ("doc_id", "held_out", "n_tokens")], *[F.sum(x).alias(x) for x in sums])
    out = out.withColumn("held_out", F.col("held_out") == 1)
    mixed = [F.col(f"f{z}") + float(weights[z]) for z in range(contexts)]
    most = F.greatest(*mixed) if contexts > 1 else mixed[0]
    full = most + F.log10(sum((F.pow(F.lit(10.0), x - most) for x in mixed[1:]), F.pow(F.lit(10.0), mixed[0] - most)))
    return out.select("doc_id", "held_out", "n_tokens", F.col("known").cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), full.alias("score"))


def perplexity(scored: DataFrame) -> DataFrame:
    """One row: perplexity by token of the held-out texts, of the base and of the model."""
    by = lambda c: F.exp(-F.sum(c) / F.sum("n_tokens") * math.log(10))
    return scored.filter("held_out").agg(by("base_score").alias("base"), by("score").alias("model"))
