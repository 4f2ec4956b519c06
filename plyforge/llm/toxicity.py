"""Toxicity scores behind a noisy-channel deobfuscation.

A writer may hide a word by leetspeak, by separators or spaces between letters, or by repeating
letters. For a suspicious token, however long, the decoder builds a character lattice (each character: itself,
the letters it may stand for, or nothing where it separates or repeats) and finds the likeliest
letters by Viterbi search under a character trigram model and a channel cost for each change. In a stretch of
short tokens (four characters at most) a space is a character too: the search ends a word there or drops it, so
spaced-out words come apart from their neighbours. The
score is a logistic regression over words and word beginnings of the restored text; the
features are those whose presence differs between the classes by more than chance and that carry weight. When
scoring, one search of the whole text finds the places where a feature may begin, and only these are decoded; nothing
that decoding would find is passed over.

Language model, features and weights are fitted on the whole texts of all labelled training rows; copies of
a text count once (the intercept undoes that the classes differ in copies). Scoring reads whole texts.

Null text counts as empty; a text without features gets the intercept's probability. Without any
labelled training row of both classes the score is the rate of the one, or 0. Repeated rows are scored
alike. Labels that are null are not used; of contradicting labels of one document the higher
counts. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.llm.common import few, small_batches, spread, written

# The letters that a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = ".-_*~'`^,:;/\\"
SPACED = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")
STRETCH = re.compile(r"(?<!\S)(?:\S{1,4}[ \t]+)+\S{1,4}(?!\S)")
#: Whether three tokens of one character follow each other, as each of ``SPACED`` has them.
def _spaced(tokens: list[str]) -> bool:
    return "111" in "".join(["1" if len(t) == 1 else "0" for t in tokens])


EDGE = ".,;:!?\"'()[]{}<>…»«„“”*_-~"
PLAIN_EDGE = "".join(c for c in EDGE if c not in LEET)
CHANGED, DROPPED = math.log(0.05), math.log(0.1)
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"


ONLY = frozenset(LETTERS)


class CharModel:
    """Trigram model over lower-case letters, interpolated with shorter contexts; ``^`` and ``$`` are a word's ends."""

    def __init__(self, counts: dict[str, int]):
        self.counts = Counter(counts)
        for gram, n in counts.items():
            for k in (1, 2):
                self.counts["c" + gram[:k] if k == 2 else "u"] += n
                self.counts["l" + gram[k:]] += n
            self.counts["b" + gram[1]] += n
        self.cache: dict[str, float] = {}

    def log(self, context: str, c: str) -> float:
        """log P(c | two characters before it)."""
        key = context + c
        if key not in self.cache:
            n = self.counts
            p = (n["l" + c] + 0.1) / (n["u"] + 0.1 * (len(LETTERS) + 2))
            p = (n["l" + context[1] + c] + 5 * p) / (n["b" + context[1]] + 5)
            self.cache[key] = math.log((n[context + c] + 5 * p) / (n["c" + context] + 5))
        return self.cache[key]


def trigrams(word: str) -> list[str]:
    """The word's letters with two starts and an end, in threes; none if it has other characters."""
    if not word or not ONLY.issuperset(word):
        return []
    s = "^^" + word + "$"
    return [s[i : i + 3] for i in range(len(s) - 2)]


REPEATED = re.compile(r"(.)\1\1")
HIDING = re.compile("[" + re.escape("".join(LEET) + SEPARATORS) + "]")


def suspicious(token: str) -> bool:
    if token.isalpha():
        return REPEATED.search(token) is not None
    if not any(map(str.isalpha, token)):
        return False
    return HIDING.search(token) is not None or REPEATED.search(token) is not None


#: Characters that may stand for each other become one letter; what stands for nothing goes.
ALIKE = {ord(c): {"l": "i", "g": "b"}.get(x[0], x[0]) for c, x in LEET.items()} | {ord("l"): "i", ord("g"): "b"}
UNREAD, DOUBLED = re.compile(f"[^{LETTERS} ]+"), re.compile(r"(.)\1+")
#: What keeps a token from being read as it is: other characters, or a letter twice.
UNPLAIN = re.compile(rf"[^{LETTERS}]|(.)\1")


def outlines(text: str) -> list[str]:
    """Of every token what stays the same however its letters are hidden, but for repetitions."""
    return UNREAD.sub("", text.lower().replace("\t", " ").translate(ALIKE)).split(" ")


def outline_tree(features: Iterable[str]) -> dict:
    """Outlines of all features that decoding may give, letter by letter; "" marks a beginning's end, "$" a word's."""
    tree: dict = {}
    for k in features:
        word = k[1:] if k[0] == "^" else k
        if word and all(c in LETTERS for c in word):
            at = tree
            for c in DOUBLED.sub(r"\1", word.translate(ALIKE)):
                at = at.setdefault(c, {})
            at["" if k[0] == "^" else "$"] = {}
    return tree


def finder(features: Iterable[str]) -> re.Pattern | None:
    """Finds, in a lower-cased text after a space, the tokens (group 1) at which a word with one of ``features`` may begin, plain or
    hidden, in that token alone or with those after it; none for no features. The outlines' letters, each as any character that may
    stand for it, with repetitions and unread characters between them. A feature that holds other
    characters isn't ever decoded and stands as it is."""
    known = sorted(set(LETTERS) | set(LEET))
    alike: dict[str, list[str]] = {}
    for c in known:
        alike.setdefault(c.translate(ALIKE), []).append(c)
    words = {k[1:] if k[0] == "^" else k for k in features} - {""}
    plain = sorted(w for w in words if any(c not in LETTERS for c in w))
    tree = outline_tree(features)

    def branches(at: dict) -> str:
        found = []
        for c, after in sorted(at.items()):
            if c in ("", "$"):
                continue
            letter = "[" + re.escape("".join(alike[c])) + "]"
            others = [x for x in known if x not in alike[c]]
            # Between letters goes what isn't read or repeats the first of them; after a word's last letter also what edges may have.
            between = "[^" + re.escape("".join(others)) + "]*+"
            end = "[^" + re.escape("".join(x for x in others if x not in EDGE)) + r"\s]*+(?!\S)"
            if "" in after:
                found.append(letter)
            elif "$" not in after:
                found.append(letter + between + branches(after))
            else:
                found.append(letter + (end if len(after) == 1 else f"(?:{end}|{between}{branches(after)})"))
        return "(?:" + "|".join(found) + ")"

    if not tree and not plain:
        return None
    edge = "[^" + re.escape("".join(c for c in known if c not in EDGE)) + r"\s]*"
    return re.compile(r"\s(?=" + edge + "(?:" + "|".join([*map(re.escape, plain), *([branches(tree)] if tree else [])]) + r"))(\S+)")


def decode(token: str, model: CharModel) -> str:
    """The likeliest letters behind a lower-cased token; words, where it holds single spaces."""
    return decoded(token, model)[1]


def decoded(token: str, model: CharModel) -> tuple[float, str]:
    """``decode`` with its score. Linear in the token's length: a path is a chain of letters that paths share."""
    beam: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    last, log, known = "", model.log, model.cache
    for c in token:
        fresh: dict[str, tuple[float, tuple | None]] = {}
        options = [(x, CHANGED) for x in LEET.get(c, "")]
        if c in LETTERS:
            options.append((c, 0.0))
        skip = DROPPED if c in SEPARATORS or c in " \t" or c == last else (2 * DROPPED if not options else None)
        last = c
        for context, (score, out) in beam.items():
            if c == " ":
                ended, path = (score + log(context, "$"), (" ", out)) if context != "^^" else (score, out)
                if "^^" not in fresh or ended > fresh["^^"][0]:
                    fresh["^^"] = ended, path
            for x, cost in options:
                price = known.get(context + x)
                new, key = score + cost + (log(context, x) if price is None else price), context[1] + x
                if key not in fresh or new > fresh[key][0]:
                    fresh[key] = new, (x, out)
            if skip is not None and (c != " " or context != "^^"):
                new = score + skip
                if context not in fresh or new > fresh[context][0]:
                    fresh[context] = new, out
        beam = fresh
        if not beam:
            return -math.inf, ""
    best, context = max((score + log(context, "$"), context) for context, (score, _) in beam.items())
    path, letters = beam[context][1], []
    while path is not None:
        letters.append(path[0])
        path = path[1]
    return best, "".join(reversed(letters))


def features_of(word: str) -> list[str]:
    """The whole word and its beginnings."""
    return [word, *("^" + word[:k] for k in (4, 5, 6) if len(word) >= k)]


class Reader:
    """Texts to sets of features, by way of restored words; a bounded memory of words.

    With ``wanted`` features only what may hold one is decoded: its outline, which no way of hiding
    changes, must hold the outline of a feature's beginning. So nothing that decoding would find is lost."""

    def __init__(self, model: CharModel | None, wanted: dict[str, int] | None, keep: int = 150_000, most_sought: int = 3000):
        self.model, self.wanted, self.keep = model, wanted, keep
        self.seen: dict[str, tuple] = {}
        self.read: dict[str, str] = {}
        self.stretches: dict[str, tuple] = {}
        self.starts = {k[1:]: i for k, i in (wanted or {}).items() if k[0] == "^"}
        #: First four letters of all features.
        self.heads = {(k[1:] if k[0] == "^" else k)[:4] for k in wanted or {}}
        self.outlines = {DOUBLED.sub(r"\1", "".join(outlines(k)))[:4] for k in wanted or {}}
        self.lengths = sorted({len(o) for o in self.outlines})
        #: Many features begin at most tokens; then these are read one by one.
        self.broad = len(wanted or {}) > most_sought
        self.finder = None if self.broad else finder(wanted or {})
        self.tree = outline_tree(wanted or {})

    def _known(self, word: str) -> tuple:
        """Places of a word's features among the wanted ones."""
        if word[:4] not in self.heads:
            return ()
        starts = self.starts
        found = [self.wanted[word]] if word in self.wanted else []
        for k in (4, 5, 6):
            if word[:k] in starts and len(word) >= k:
                found.append(starts[word[:k]])
        return tuple(found)

    def hides(self, text: str) -> bool:
        """Whether a word with a wanted feature may begin at one of the text's tokens."""
        tokens, wanted = outlines(text), self.outlines
        for i in range(len(tokens)):
            o = "".join(tokens[i : i + 8])
            if len(o) > 3 or i + 8 >= len(tokens):
                o = DOUBLED.sub(r"\1", o)
            if len(o) < 4 and i + 8 < len(tokens):
                o = DOUBLED.sub(r"\1", "".join(tokens[i:]))
            for n in self.lengths:
                if o[:n] in wanted:
                    return True
        return False

    def joins(self, stretch: str) -> bool:
        """Whether a wanted feature may go over several tokens of a stretch, or hide in one of them. Where it lies in a token of plain letters,
        decoding gives the letters as they are, and the token has it by itself."""
        tokens, root, raw = outlines(stretch), self.tree, []

        def unplain(i: int) -> bool:
            if not raw:
                raw.extend(stretch.lower().replace("\t", " ").split(" "))
            return UNPLAIN.search(raw[i].strip(PLAIN_EDGE)) is not None

        for i, first in enumerate(tokens):
            if not first or first[0] not in root:
                continue
            at, last = root, ""
            for j in range(i, len(tokens)):
                for c in tokens[j]:
                    if c != last:
                        at, last = at.get(c), c
                        if at is None:
                            break
                    if "" in at and (j > i or unplain(i)):
                        return True
                if at is None:
                    break
                if "$" in at and (j > i or unplain(i)):
                    return True
        return False

    def restored(self, token: str) -> str:
        """The word behind a token: the likeliest reading, with what its edges may stand for or without."""
        low = token.lower()
        core = low.strip(EDGE)
        if self.model is None or not suspicious(low):
            return core
        forms = dict.fromkeys((core, low.strip(PLAIN_EDGE), low.lstrip(PLAIN_EDGE).rstrip(EDGE)))
        return max(decoded(x, self.model) for x in forms)[1]

    def word(self, token: str) -> str:
        """The restored word; empty if it holds none of the wanted features."""
        plain = token.strip(EDGE).lower()
        if plain.isalpha() and (len(plain) == len(token) or token[0] not in LEET and token[-1] not in LEET) and REPEATED.search(plain) is None:
            return plain  # nothing hides in it
        if self.wanted is not None and not self.hides(token) and not self.hides(token.strip(EDGE)):
            return ""
        return self.restored(token)

    def words(self, text: str) -> set[str]:
        """All restored words of a text, remembered."""
        read, out = self.read, set()
        for token in self.tokens(text):
            word = read.get(token)
            if word is None:
                word = self.word(token)
                if len(read) > self.keep:
                    read.clear()
                if len(token) <= 64:
                    read[token] = word
            out.add(word)
        out.discard("")
        return out

    def of_word(self, token: str) -> tuple:
        """Wanted features of the restored word, remembered."""
        found = self.seen.get(token)
        if found is None:
            found = self._known(self.word(token))
            if len(self.seen) > self.keep:
                self.seen.clear()
            if len(token) <= 64:
                self.seen[token] = found
        return found

    def apart(self, stretch: str) -> list[str]:
        return decode(re.sub(r"[ \t]+", " ", stretch.lower()), self.model).split()

    def within(self, stretch: str) -> tuple:
        """The words that hide in a stretch, remembered."""
        found = self.stretches.get(stretch)
        if found is None:
            hides = self.joins(stretch) if self.wanted is not None else SPACED.search(stretch)
            found = tuple(self.apart(stretch)) if hides else ()
            if len(self.stretches) > self.keep:
                self.stretches.clear()
            if len(stretch) <= 64:
                self.stretches[stretch] = found
        return found

    @staticmethod
    def stretch_around(text: str, at: int) -> tuple[int, int]:
        """Where the match of ``STRETCH`` with the short token at ``at`` begins and ends; empty if the token stands alone."""
        while True:
            blank = at
            while blank and text[blank - 1] in " \t":
                blank -= 1
            before = blank
            while before and blank - before < 5 and not text[before - 1].isspace():
                before -= 1
            if blank == at or not 0 < blank - before < 5:
                break
            at = before
        found = STRETCH.match(text, at)
        return found.span() if found else (at, at)

    def near(self, text: str) -> set[str]:
        """Of ``tokens`` those that may hold wanted features."""
        low = "" if self.broad else text.lower()
        if self.broad or len(low) != len(text):  # in the second case places differ
            return self.tokens(text)
        out: set = set()
        end = 0
        for m in self.finder.finditer(" " + low) if self.finder else ():
            a, b = m.start(1) - 1, m.end(1) - 1
            out.add(text[a:b])
            if b - a <= 4 and a >= end and self.model is not None:
                start, end = self.stretch_around(text, a)
                if start < end:
                    out.update(self.within(text[start:end]))
        return out

    def tokens(self, text: str) -> set[str]:
        """The text's tokens, and the words that hide in its stretches of short ones."""
        found = text.split()
        out = set(found)
        # Without wanted features only spaced-out words are sought.
        if self.model is not None and (self.wanted is not None or _spaced(found)):
            for m in STRETCH.findall(text):
                out.update(self.within(m))
        return out

    def __call__(self, text: str | None) -> set:
        if self.wanted is None:
            return {f for word in self.words(text or "") for f in features_of(word)}
        out: set = set()
        for token in self.near(text or ""):
            found = self.seen.get(token)
            if found is None:
                found = self.of_word(token)
            if found:
                out.update(found)
        return out


def restored_text(text: str, model: CharModel) -> str:
    """The text with suspicious tokens and spaced-out words replaced by what they hide."""
    reader = Reader(model, None)
    text = SPACED.sub(lambda m: re.sub(r"[ \t]", "", m[0]), text)
    return re.sub(r"\S+", lambda m: reader.restored(m[0]) if suspicious(m[0].strip(EDGE).lower()) else m[0], text)


def _regress(on: list[np.ndarray], size: int, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05, steps: int = 400) -> np.ndarray:
    """Weighted logistic regression with an intercept (first) on sets of features, by accelerated gradient steps
    that are scaled by each feature's own bound on its bend; memory is in proportion to the sets."""
    owner = np.repeat(np.arange(len(on)), [len(x) + 1 for x in on])
    flat = np.concatenate([np.concatenate([[0], x + 1]) for x in on]).astype(np.int64) if on else np.empty(0, np.int64)
    members = np.bincount(owner, minlength=len(on)).astype(float)
    pull = np.full(size + 1, ridge)
    pull[0] = 1e-6
    bend = 0.25 * np.bincount(flat, (weight * members)[owner], minlength=size + 1) + pull
    w = ahead = np.zeros(size + 1)
    pace = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, ahead[flat], minlength=len(on)), -30, 30)))
        slope = np.bincount(flat, (weight * (p - y))[owner], minlength=size + 1) + pull * ahead
        new = ahead - slope / bend
        if float(slope @ (new - w)) > 0:  # the momentum leads uphill: start it again
            pace = 1.0
        after = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead, w, pace = new + (pace - 1) / after * (new - w), new, after
    return w


class Model:
    """What scoring needs: a language model, the features' places and the weights."""

    def __init__(self, chars: dict[str, int], places: dict[str, int], weights: np.ndarray):
        self.chars, self.places, self.weights = chars, places, weights


def _within(ids: DataFrame, bits: int = 23) -> Column:
    """Whether a doc_id may be among ``ids``: a bitmap of fixed size, which spares the other texts the shuffle; a join must follow."""
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits)
    got = ids.select(F.shiftright(place, 6).alias("word"), F.expr("1L").alias("one"), (place % 64).cast("int").alias("bit"))
    got = got.groupBy("word").agg(F.bit_or(F.call_function("shiftleft", "one", "bit")).alias("set")).toPandas()
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[got["word"].to_numpy(dtype=int)] = got["set"].to_numpy(dtype=np.int64).astype(np.uint64)
    shared = ids.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def among(places: pd.Series) -> pd.Series:
        x = places.to_numpy(dtype=np.int64).astype(np.uint64)
        return pd.Series(((shared.value[(x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63))) & np.uint64(1)).astype(bool))

    return among(place)


def _labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """text, y of every distinct text of the documents in ``known`` (doc_id, y); the higher y of copies. Texts move once:
    copies are told by their hashes."""
    text = F.coalesce("text", F.lit(""))
    hashed = docs.select("doc_id", F.xxhash64(text).alias("t"), F.sha2(text, 256).alias("h"))
    chosen = hashed.join(known, "doc_id").groupBy("t", "h").agg(F.min("doc_id").alias("doc_id"), F.max("y").alias("y"))
    total = known.count()
    chosen = written(few(chosen, total), "chosen")
    rows = docs.select("doc_id", text.alias("text")).filter(_within(chosen)).join(chosen, "doc_id").filter(F.sha2("text", 256) == F.col("h"))
    # One id may come with one text several times.
    return written(few(rows.dropDuplicates(["doc_id", "t", "h"]).select("text", "y"), total), "labelled")


def _regress_far(pairs: DataFrame, moved: np.ndarray, size: int, weight: Column, total: float, ridge: float = 0.05) -> np.ndarray:
    """``_regress`` where the patterns stay in the cluster. pairs: y, on, n; moved: a feature's place, or -1."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors, VectorUDT

    places = [int(x) for x in moved]

    def sparse(on: list[int]):
        # Sorted, as the places keep the features' order.
        at = [places[i] for i in on if places[i] >= 0]
        return Vectors.sparse(max(1, size), at, [1.0] * len(at))

    vector = F.udf(sparse, VectorUDT())
    # Written, as the library reads the rows twice.
    rows = written(pairs.select(F.col("y").cast("double").alias("label"), vector("on").alias("features"), weight.alias("weight")), "vectors")
    # The library divides the loss by the weights' sum.
    model = LogisticRegression(maxIter=100, tol=1e-7, regParam=ridge / total, standardization=False, weightCol="weight").fit(rows)
    return np.concatenate([[model.intercept], model.coefficients.toArray()[:size]])


def fit(docs: DataFrame, labels: DataFrame, training: Column, least_z: float = 5.0, least_weight: float = 0.25, most_patterns: int = 20_000) -> Model:
    """``labels``: doc_id, toxic. ``training`` is a condition on doc_id. Copies count once.

    All features beyond ``least_z`` are fitted; those with a weight under ``least_weight`` go and the rest is
    fitted again. The driver gets the features; with up to ``most_patterns`` patterns of features also a small row for
    each, else the regression is left to the cluster."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.filter(training & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return Model({}, {}, np.array([30.0 if n1 else -30.0]))
    # Written once and read for each step of the fit.
    rows = spread(_labelled(docs, known))
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}

    def chars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()

        def grams_of() -> pd.DataFrame:
            counts: Counter = Counter()
            for word, n in words.items():
                for gram in trigrams(word.strip(EDGE).lower()):
                    counts[gram] += n
            words.clear()
            return pd.DataFrame({"gram": pd.Series(list(counts), dtype=object), "n": pd.Series(list(counts.values()), dtype="int64")})

        for batch in batches:
            for text in batch["text"]:
                # Letters of spaced-out words aren't words.
                found = text.split()
                words.update(SPACED.sub(" ", text).split() if _spaced(found) else found)
                if len(words) > 200_000:
                    yield grams_of()
        yield grams_of()

    grams = {r["gram"]: r["n"] for r in rows.select("text").mapInPandas(chars, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()}

    def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = Reader(CharModel(grams), None)
        # Whole words, and beginnings of 4, 5 and 6 letters.
        clean, toxic = [Counter() for _ in range(4)], [Counter() for _ in range(4)]

        def counted() -> pd.DataFrame:
            names, c, t = [], [], []
            for kind, (a, b) in enumerate(zip(clean, toxic, strict=True)):
                keys = list(a.keys() | b.keys())
                names += ["^" + x for x in keys] if kind else keys
                c += [a[x] for x in keys]
                t += [b[x] for x in keys]
                a.clear()
                b.clear()
            return pd.DataFrame({"name": pd.Series(names, dtype=object), "clean": pd.Series(c, dtype="int64"), "toxic": pd.Series(t, dtype="int64")})

        for batch in batches:
            for text, y in zip(batch["text"], batch["y"], strict=True):
                words, counts = read.words(text), toxic if y else clean
                counts[0].update(words)
                for kind in (1, 2, 3):
                    k = kind + 3
                    counts[kind].update({w[:k] for w in words if len(w) >= k})
                if sum(map(len, clean + toxic)) > 200_000:
                    yield counted()
        yield counted()

    found = rows.mapInPandas(presence, "name string, clean long, toxic long").groupBy("name").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    m1, m0 = float(max(1, sizes.get(1, 0))), float(max(1, sizes.get(0, 0)))
    pooled = (F.col("c") + F.col("t") + 1) / (m1 + m0 + 2)
    z = (F.col("t") / m1 - F.col("c") / m0) / F.sqrt(pooled * (1 - F.least(pooled, F.lit(0.999))) * (1 / m1 + 1 / m0))
    strong = found.withColumn("z", z).filter(F.col("z") > least_z).select("name").collect()
    places = {name: i for i, name in enumerate(sorted(r["name"] for r in strong))}

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = Reader(CharModel(grams), places)
        for batch in batches:
            yield pd.DataFrame({"y": batch["y"].astype(int), "on": [sorted(read(t)) for t in batch["text"]]})

    pairs = rows.mapInPandas(marked, "y int, on array<int>").groupBy("y", "on").agg(F.count("*").alias("n"))
    pairs = written(few(pairs, n0 + n1), "patterns")
    # The classes' rates are those of all labelled rows.
    rate = {1: n1 / m1, 0: n0 / m0}
    rate = {y: r * (m1 + m0) / (n1 + n0) for y, r in rate.items()}
    if pairs.count() > most_patterns:
        weights = F.col("n") * F.when(F.col("y") == 1, rate[1]).otherwise(rate[0])
        regress = lambda moved, size: _regress_far(pairs, moved, size, weights, m1 + m0)
    else:
        got = pairs.collect()
        y = np.array([r["y"] for r in got], dtype=float)
        weight = np.array([r["n"] * rate[1 if r["y"] else 0] for r in got])
        on = [np.array(r["on"], dtype=np.int64) for r in got]
        regress = lambda moved, size: _regress([moved[x][moved[x] >= 0] for x in on], size, y, weight)
    w = regress(np.arange(len(places)), len(places))
    kept = [name for name, i in places.items() if w[1 + i] >= least_weight]
    moved = np.full(len(places) + 1, -1)
    moved[[places[name] for name in kept]] = np.arange(len(kept))
    return Model(grams, {name: i for i, name in enumerate(kept)}, regress(moved, len(kept)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (all its columns) with toxicity (0 to 1)."""
    chars, places, weights = model.chars, model.places, model.weights

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = Reader(CharModel(chars), places)
        for texts in batches:
            logits = [weights[0] + sum(weights[1 + i] for i in sorted(read(t))) for t in texts]
            yield pd.Series([round(1 / (1 + math.exp(-min(30.0, max(-30.0, v)))), 9) for v in logits], dtype=float)

    small_batches(docs.sparkSession)
    return spread(docs).withColumn("toxicity", toxic(F.col("text")))
