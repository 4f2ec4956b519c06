"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram's vector binds
(multiplies) its letters' vectors, the first rotated by two places and the second by one. A document
bundles (adds) the vectors of its trigrams over lower-cased letters, other characters being
one space; a language's prototype bundles the unit vectors of its training documents. The nearest
prototype by cosine, after taking the prototypes' common direction away from both sides, names the
language; the score is that cosine, cut to 0..1.

Prototypes and the languages' least scores come from the whole texts of all training documents of the
``most_languages`` most frequent languages.

Null text, and text without a letter, is ``und`` with score 0, and so is every text where nothing could be
learned. Repeated rows are predicted alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.llm.common import small_batches, spread

SCALE = 10_000
PREDICTED = "lang_pred string, score double"


class Encoder:
    """Texts to bundled vectors; keeps the vectors of a bounded number of trigrams."""

    def __init__(self, dim: int, seed: int, keep: int = 20_000):
        self.dim, self.seed, self.keep = dim, seed, keep
        self.letters: dict[int, np.ndarray] = {}
        self.codes: dict[int, int] = {}
        self.grams, self.places = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.table = np.empty((1024, dim), dtype=np.int8)

    def folded(self, text: str) -> np.ndarray:
        """Lower-cased letters as code points; runs of anything else, and both ends, one space."""
        raw = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
        seen, at = np.unique(raw, return_inverse=True)
        for c in seen.tolist():
            if c not in self.codes:
                ch = chr(c)
                self.codes[c] = ord(ch.lower()[0]) if ch.isalpha() else 32
        out = np.concatenate([[32], np.array([self.codes[c] for c in seen.tolist()], dtype=np.int64)[at] if len(raw) else [], [32]]).astype(np.int64)
        keep = np.ones(len(out), dtype=bool)
        keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
        return out[keep]

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            self.letters[c] = (np.random.default_rng([self.seed, c]).integers(0, 2, self.dim, dtype=np.int8) * 2 - 1).astype(np.int8)
        return self.letters[c]

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """Places in the table of sorted distinct trigrams; new ones are bound and kept."""
        if len(self.grams) > self.keep:
            self.grams, self.places = self.grams[:0], self.places[:0]
        at = np.searchsorted(self.grams, grams)
        new = np.ones(len(grams), dtype=bool)
        inside = at < len(self.grams)
        new[inside] = self.grams[at[inside]] != grams[inside]
        if new.any():
            first, count = len(self.grams), int(new.sum())
            while first + count > len(self.table):
                self.table = np.concatenate([self.table, np.empty_like(self.table)])
            for i, gram in enumerate(grams[new].tolist()):
                a, b, c = gram >> 42, (gram >> 21) & 0x1FFFFF, gram & 0x1FFFFF
                self.table[first + i] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
            self.grams = np.insert(self.grams, at[new], grams[new])
            self.places = np.insert(self.places, at[new], np.arange(first, first + count))
            at = np.searchsorted(self.grams, grams)
        return self.places[at]

    def vector(self, text: str | None) -> np.ndarray | None:
        """The bundle as a unit vector; None without letters."""
        s = self.folded(text or "")
        if len(s) < 3:
            return None
        grams, counts = np.unique((s[:-2] << 42) | (s[1:-1] << 21) | s[2:], return_counts=True)
        total = np.zeros(self.dim, dtype=np.float32)
        for lo in range(0, len(grams), 4096):
            rows = self.rows(grams[lo : lo + 4096])
            total += counts[lo : lo + 4096].astype(np.float32) @ self.table[rows].astype(np.float32)
        size = float(np.linalg.norm(total))
        return total / size if size else total


def _training(docs: DataFrame, training: Column, most_languages: int) -> DataFrame:
    """The documents that prototypes are fitted on: text, lang."""
    rows = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # At most ``most_languages`` rows, so they are broadcast and no text is shuffled.
    most = F.broadcast(rows.groupBy("lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "lang").limit(most_languages).select("lang"))
    return spread(rows.select("text", "lang")).join(most, "lang")


def fit(docs: DataFrame, training: Column, most_languages: int = 256, dim: int = 1024, seed: int = 5) -> tuple[list[str], np.ndarray]:
    """(languages, prototypes) of the ``most_languages`` most frequent languages, from the rows that
    ``training`` marks and whose lang isn't null."""

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, sums = Encoder(dim, seed), {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                v = encode.vector(text)
                if v is not None:
                    sums[lang] = sums.get(lang, 0) + np.rint(v * SCALE).astype(np.int64)
        rows = [(lang, i, int(x)) for lang, v in sums.items() for i, x in enumerate(v)]
        yield pd.DataFrame(rows, columns=["lang", "at", "x"])

    small_batches(docs.sparkSession)
    rows = _training(docs, training, most_languages)
    sums = rows.select("text", "lang").mapInPandas(bundle, "lang string, at int, x long").groupBy("lang", "at").agg(F.sum("x").alias("x")).toPandas()
    langs = sorted(sums["lang"].unique())
    out = np.zeros((len(langs), dim))
    out[[langs.index(x) for x in sums["lang"]], sums["at"].to_numpy(dtype=int)] = sums["x"].to_numpy(dtype=float)
    return langs, out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def least_scores(named: DataFrame, langs: list[str], quantile: float = 0.005) -> dict[str, float]:
    """Of every language, the score that all but ``quantile`` of its own documents reach (those that are
    named rightly; the lowest of the others' where there are none). named: lang, lang_pred and score of training documents."""
    least = F.expr(f"percentile_disc({quantile}) WITHIN GROUP (ORDER BY score)")
    rows = named.filter((F.col("lang_pred") == F.col("lang")) & (F.col("lang_pred") != "und"))
    # Scores have six digits, so their counts are few, however many documents there are.
    found = {r["lang"]: r["least"] for r in rows.groupBy("lang").agg(least.alias("least")).collect()}
    return {lang: found.get(lang, min(found.values(), default=0.0)) for lang in langs}


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, seed: int = 5) -> DataFrame:
    """``docs`` (all its columns) with lang_pred and score; the text only moves to the workers."""
    dim = prototypes.shape[1]
    common = prototypes.mean(axis=0) if len(langs) > 1 else np.zeros(dim)
    apart = prototypes - common
    apart = (apart / np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    @F.pandas_udf(PREDICTED)
    def name(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = Encoder(dim, seed)
        for texts in batches:
            rows = []
            for text in texts:
                v = encode.vector(text) if len(langs) else None
                if v is None:
                    rows.append(("und", 0.0))
                    continue
                v = v - common.astype(np.float32)
                cosine = apart @ v / max(float(np.linalg.norm(v)), 1e-12)
                at = int(np.argmax(cosine))
                rows.append((langs[at], round(min(1.0, max(0.0, float(cosine[at]))), 6)))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    small_batches(docs.sparkSession)
    out = spread(docs).withColumn("_named", name(F.col("text")))
    return out.withColumns({"lang_pred": F.col("_named.lang_pred"), "score": F.col("_named.score")}).drop("_named")
