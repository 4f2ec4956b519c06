"""Near-duplicate classes by an inverted join over MinHash signature coordinates.

1. Every whole text becomes its set of hashed word shingles and a signature of ``coordinates`` minima.
   Documents with equal sets collapse to the smallest id (grouped with map-side partial minima).
2. Two sets that reach the similarity agree in at least ``least`` coordinates (but for a chance of a few in
   a million at the threshold, less above it), so they share ``meet`` of their first ``coordinates - least + meet`` coordinate-value pairs in any order
   that all documents use. The order puts pairs that few documents post first, by a sketch of fixed
   size, so pairs that a common passage brings aren't posted at all: the prefix filter.
3. Postings meet under their coordinate-value pair. A list of up to ``cold`` documents gives its
   pairs, whose collisions are counted; those with ``meet`` and then ``least`` matches are confirmed on full sets. A longer list isn't expanded: its documents
   are dealt in blocks, and each pair of blocks meets in one task with full sets, which finds the sets near the list's
   consensus first and then scans postings of shingles only for documents that aren't yet in that class (skip
   merging). Links inside a class that is already joined change nothing and aren't sought;
   no link between classes is skipped.
4. Confirmed links go to connected components.

Null text, empty text and text without words: no shingles, linked with nothing, its own class. Fewer
words than a shingle: the whole sequence is one shingle. Repeated rows and ids: each row is returned;
rows with one id and different texts are different sets that share the id, and so its class. Rows with a null
id are returned with a null class unless their set belongs to a class. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyforge.llm.common import few, small_batches, spread, written
from plyforge.llm.skew import components, left_join

SKETCH_BITS, FILTER_BITS = 17, 23
SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, signature binary"


class Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


class Shingler:
    def __init__(self, words: int):
        self.words, self.hashes = words, Hashes()
        self.factors = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1) ** 5) & (2**64 - 1) | 1) for i in range(words)]

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles of a whole text."""
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return np.empty(0, dtype=np.uint64)
        h = self.hashes
        w = np.fromiter((h[x] for x in found), dtype=np.uint64, count=len(found))
        k = min(self.words, len(w))
        out = np.full(len(w) - k + 1, np.uint64(k), dtype=np.uint64)
        for i in range(k):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + w[i : len(w) - k + 1 + i] * self.factors[i]
        return np.unique(_mixed(out))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """uint32 minima of ``coordinates`` multiply-and-shift functions of the mixed hashes."""
    at = np.arange(1, 2 * coordinates + 1, dtype=np.uint64)
    draw = _mixed(at * np.uint64(0x9E3779B97F4A7C15))
    by, plus = draw[:coordinates] | np.uint64(1), draw[coordinates:]
    out = np.full(coordinates, 2**32 - 1, dtype=np.uint64)
    for lo in range(0, len(shingles), 4096):
        out = np.minimum(out, ((shingles[lo : lo + 4096] * by[:, None] + plus[:, None]) >> np.uint64(32)).min(axis=1))
    return out.astype(np.uint32)


def signed(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(words)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                s = shingle(text)
                raw = s.tobytes()
                # Empty sets are no class: each row keeps a key of its own, so they don't meet in one task.
                ds = [xxhash.xxh64_intdigest(raw, seed=i) - 2**63 for i in (1, 2)] if len(s) else [xxhash.xxh64_intdigest(str(doc)) - 2**63, 0]
                rows.append((doc, len(s), *ds, signature(s, coordinates).tobytes() if len(s) else None))
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "d1", "d2", "signature"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    small_batches(docs.sparkSession)
    return spread(docs.select(F.col("doc_id").cast("long"), "text")).mapInPandas(sign, SIGNED)


def _cells(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each coordinate-value pair of a matrix of signatures."""
    return _mixed((np.arange(signatures.shape[1], dtype=np.uint64) << np.uint64(32)) + signatures.astype(np.uint64))


def _matrix(column: pd.Series, coordinates: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint32).reshape(-1, coordinates)


def sketch_of(reps: DataFrame, coordinates: int) -> np.ndarray:
    """How many documents post into each of 2**SKETCH_BITS cells; a fixed size."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            if len(batch):
                total += np.bincount((_cells(_matrix(batch["signature"], coordinates)) >> np.uint64(64 - SKETCH_BITS)).ravel().astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"cell": at, "n": total[at]})

    got = reps.select("signature").mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    out[got["cell"].to_numpy(dtype=int)] = got["n"].to_numpy(dtype=np.int64)
    return out


def least_matches(similarity: float, coordinates: int) -> int:
    """Coordinates in which two sets of ``similarity`` agree at least, five deviations below the mean."""
    return max(1, math.floor(coordinates * similarity - 5 * math.sqrt(coordinates * similarity * (1 - similarity))))


def postings(reps: DataFrame, coordinates: int, prefix: int, sketch: np.ndarray) -> DataFrame:
    """(cell, doc_id, place): each document under the ``prefix`` rarest of its coordinate-value pairs."""
    shared = reps.sparkSession.sparkContext.broadcast(sketch)

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            cells = _cells(_matrix(batch["signature"], coordinates))
            df = shared.value[(cells >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            # The order: fewer documents first, then the cell itself; the same for all documents.
            first = np.lexsort((cells, df), axis=1)[:, :prefix]
            kept = np.take_along_axis(cells, first, axis=1)
            yield pd.DataFrame({"cell": kept.ravel().astype(np.int64), "doc_id": np.repeat(batch["doc_id"].to_numpy(dtype=np.int64), kept.shape[1]), "place": np.tile(np.arange(kept.shape[1], dtype=np.int32), len(kept))})

    return reps.select("doc_id", "signature").mapInPandas(post, "cell long, doc_id long, place int")


def collisions(posted: DataFrame, cold: int, first: int) -> DataFrame:
    """(cell, a, b): the pairs of lists of up to ``cold`` documents, with cell null; of longer
    lists their members as a, with b null, that post there among their ``first`` pairs. Lists stream
    past; only ``cold`` documents are held."""

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held, places, long = None, [], [], False

        def pairs(out: list) -> None:
            if not long and len(held) > 1:
                out.extend((None, held[i], held[j]) for j in range(1, len(held)) for i in range(j))

        for batch in batches:
            out: list = []
            for c, doc, place in zip(batch["cell"].tolist(), batch["doc_id"].tolist(), batch["place"].tolist(), strict=True):
                if c != cell:
                    pairs(out)
                    cell, held, places, long = c, [], [], False
                if long:
                    if place < first:
                        out.append((c, doc, None))
                else:
                    held.append(doc)
                    places.append(place)
                    if len(held) > cold:
                        out.extend((c, d, None) for d, p in zip(held, places, strict=True) if p < first)
                        held, long = [], True
            yield pd.DataFrame(out, columns=["cell", "a", "b"]).astype("Int64")
        out = []
        pairs(out)
        yield pd.DataFrame(out, columns=["cell", "a", "b"]).astype("Int64")

    return posted.repartition("cell").sortWithinPartitions("cell", "doc_id").mapInPandas(meet, "cell long, a long, b long")


def matching(pairs: DataFrame, reps: DataFrame, coordinates: int, least: int) -> DataFrame:
    """The pairs whose whole signatures agree in ``least`` coordinates or more."""

    def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                same = (_matrix(batch["sa"], coordinates) == _matrix(batch["sb"], coordinates)).sum(axis=1)
                yield batch.loc[same >= least, ["a", "b"]]

    left = reps.select(F.col("doc_id").alias("a"), F.col("signature").alias("sa"))
    right = reps.select(F.col("doc_id").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInPandas(agree, "a long, b long")


def sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids``. A bitmap of fixed size spares the others the
    shuffle; the join after it is exact."""

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _mixed(batch["doc_id"].to_numpy(dtype=np.int64).astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)
            yield pd.DataFrame({"word": (x >> np.uint64(6)).astype(np.int64), "bit": (np.uint64(1) << (x & np.uint64(63))).astype(np.int64)}).groupby("word", as_index=False).agg({"bit": np.bitwise_or.reduce})

    got = ids.mapInPandas(bits, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()
    table = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    table[got["word"].to_numpy(dtype=int)] = got["bit"].to_numpy(dtype=np.int64).astype(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(words)
        for batch in batches:
            x = _mixed(batch["doc_id"].to_numpy(dtype=np.int64).astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)
            batch = batch[((shared.value[(x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63))) & np.uint64(1)).astype(bool)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "shingles": [shingle(t).tobytes() for t in batch["text"]]})

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInPandas(build, "doc_id long, shingles binary")
    return rows.join(ids, "doc_id", "left_semi")


def _near(common: np.ndarray, a, b, percent: int) -> np.ndarray:
    """Whether intersections reach ``percent`` hundredths of the unions."""
    return 100 * common >= percent * (a + b - common)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["sa"], batch["sb"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort()
                keep.append(bool(_near(np.int64((both[1:] == both[:-1]).sum()), len(x), len(y), percent)))
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInPandas(check, "a long, b long")


class Classes:
    """Union-find over places."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def links_within(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A forest of links with the same classes as all links between sides 0 and 1 (side 2: both).

    The member that shares most with all others is compared with each; then only members outside
    its class scan the postings.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    _, term, count = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.argsort(term, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(count)])
    lists = owner[order]
    terms = np.split(term, np.cumsum(sizes)[:-1]) if len(sets) else []
    classes, out = Classes(len(sets)), []

    def scan(i: int) -> None:
        common = np.zeros(len(sets), dtype=np.int64)
        for t in terms[i]:
            common[lists[bounds[t] : bounds[t + 1]]] += 1
        near = _near(common, sizes[i], sizes, percent) & (common > 0)
        near[i] = False
        for j in np.flatnonzero(near).tolist():
            if (side[i] == 2 or side[j] == 2 or side[i] != side[j]) and classes.join(i, j):
                out.append((int(ids[i]), int(ids[j])))

    weight = np.array([count[t].sum() / max(1, len(t)) for t in terms])
    pivots = [int(max(np.flatnonzero(side == s), key=lambda i: (weight[i], -i))) for s in np.unique(side)]
    for p in pivots:
        scan(p)
    roots = [classes.root(p) for p in pivots]
    largest = max(roots, key=lambda r: sum(classes.root(i) == r for i in range(len(sets)))) if roots else -1
    for i in range(len(sets)):
        if classes.root(i) != classes.root(largest):
            scan(i)
    return out


def hot_links(members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): links of long lists; members: (cell, doc_id). Each pair of blocks is one task's group."""
    sizes = members.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    rows = members.join(sizes, "cell").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("doc_id", "cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own").join(sets, "doc_id")

    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        lo, hi = group["lo"].iloc[0], group["hi"].iloc[0]
        side = np.full(len(group), 2) if lo == hi else (group["own"] == hi).to_numpy().astype(int)
        found = links_within(group["doc_id"].to_numpy(), [np.frombuffer(s, np.uint64) for s in group["shingles"]], side, percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("cell", "lo", "hi").applyInPandas(link, "a long, b long")


def classify(docs: DataFrame, words: int = 5, percent: int = 80, coordinates: int = 32, cold: int = 24, block: int = 512, meet: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id: a row per row of ``docs``."""
    signs = written(signed(docs, words, coordinates), "signatures")
    total = signs.count()
    known = signs.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = known.groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("signature").alias("signature"))
    reps = written(few(reps, total), "representatives")
    least = least_matches(percent / 100, coordinates)
    # Pairs that agree in ``least`` coordinates share ``meet`` of their first coordinates - least + meet.
    # Long lists record all that post there: any of those ``meet`` may be in one.
    prefix = min(coordinates, coordinates - least + meet)
    posted = postings(reps, coordinates, prefix, sketch_of(reps, coordinates))
    met = written(few(collisions(posted, cold, prefix), total), "collisions")
    pairs = met.filter("b IS NOT NULL").groupBy("a", "b").agg(F.count("*").alias("shared")).filter(F.col("shared") >= min(meet, least)).select("a", "b")
    pairs = written(few(matching(pairs, reps, coordinates, least).distinct(), total), "pairs")
    members = written(met.filter("b IS NULL").select("cell", F.col("a").alias("doc_id")), "members")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).union(members.select("doc_id")).distinct()
    ids = written(few(ids, total), "ids")
    sets = written(sets_of(docs, ids, words), "sets")
    # One id may come with several texts: each of its sets stands for the id.
    same = known.groupBy("doc_id").agg(F.min(F.struct("d1", "d2")).alias("x"), F.max(F.struct("d1", "d2")).alias("y")).filter("x <> y").select("doc_id")
    twice = known.join(same, "doc_id", "left_semi").select("doc_id", "d1", "d2").distinct()
    own = twice.join(reps.select("d1", "d2", F.col("doc_id").alias("rep")), ["d1", "d2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    small_batches(docs.sparkSession, 64)  # rows with full sets are long
    # distinct() deals the links anew, so the parts of a split join stay apart until then.
    links = confirm(pairs, sets, percent).union(hot_links(members, sets, percent, block)).union(own).distinct()
    links = written(few(links, total), "links")
    small_batches(docs.sparkSession)
    roots = components(links)
    named = reps.select("d1", "d2", "copies", F.col("doc_id").alias("rep")).join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("d1", "d2", "copies", F.coalesce("component", "rep").alias("found"))
    rows = left_join(signs.select("doc_id", "n_shingles", "d1", "d2"), named, ["d1", "d2"], "copies", total, F.col("doc_id"))
    return few(rows, total).select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("found")).otherwise(F.col("doc_id")).alias("component_id"))
