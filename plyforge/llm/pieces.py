"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is escaped as SentencePiece does (a space becomes ``▁``, one is put before the text) and cut
into the vocabulary's pieces with the largest sum of scores. ``Vocabulary.stream`` is that search over a
stream: its window ends where the longest piece's reach does, and whenever the paths that survive converge on one
boundary, everything before it is committed and forgotten, so memory doesn't grow with the text.

Where no piece goes past a boundary (a word's beginning, or two neighbours that are in no piece), all paths
converge there before anything is searched. Such stretches, if they fit in two windows, are searched side by
side (``Lanes``: the same recursion, position by position over many stretches at once, each committed at its
end) and remembered up to a bound; longer ones stream. Scores are rounded so that sums are exact: both give the same ids.

Characters that no piece has, and a ``▁`` of the text itself, become byte pieces, so decoding gives the text
back exactly, without normalization. With a unigram model the ids are the SentencePiece library's. A BPE model's scores
are only ranks of merges; a piece of rank r scores as Zipf's law would have it, -ln(r + 1 + ``shift``). Its ids
are other ones than the library's merges give (about 4 % more of them), and the library decodes them to the same text.

Ties go to the longer last piece. Null text counts as empty; empty text has no ids. Repeated rows are
encoded alike. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyforge.llm.common import small_batches, spread

SPACE = "▁"
#: Stands for a ``▁`` of the text: a code point that no valid text holds.
LITERAL = "\udbff"
#: Scores are multiples of 1/EXACT, so sums are exact and ties don't depend on where a window began.
EXACT = 1 << 20
#: Characters of a window whose pieces are looked up at once.
HEAD = 4
ENCODED = "doc_id long, n_chars long, n_ids long, ids array<int>, decoded_sha256 string"


class Vocabulary:
    """Pieces with scores, from (piece, score, kind) rows; kind: normal, byte or other."""

    def __init__(self, rows: Iterable[tuple[str, float, str]]):
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.text: list[str | None] = []
        self.bytes: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        for i, (piece, score, kind) in enumerate(rows):
            self.scores.append(round(score * EXACT) / EXACT)
            self.text.append(piece if kind == "normal" else None)
            if kind == "normal" and piece:
                self.ids.setdefault(piece, i)
            elif kind == "byte":
                self.bytes[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
        self.longest = max(map(len, self.ids), default=1)
        #: All beginnings of pieces, with the place and score of those that are pieces: one lookup tells
        #: whether a stretch is a piece and whether longer ones are worth a look.
        self.starts: dict[str, tuple[int, float]] = {p[:k]: (-1, 0.0) for p in self.ids for k in range(1, len(p))}
        self.starts |= {p: (i, self.scores[i]) for p, i in self.ids.items()}
        #: Two characters side by side in some piece; every other pair has a boundary between them on all paths.
        self.pairs = {(p[k], p[k + 1]) for p in self.ids for k in range(len(p) - 1)}
        #: Matches by window, as they are met.
        self.heads: dict[str, tuple[tuple[tuple[int, float], ...], bool]] = {}
        #: Decoded pieces, for ids without bytes.
        self.plain = ["" if t is None else t.replace(SPACE, " ") for t in self.text]
        #: Whether a piece goes on past a word's beginning, such as several spaces in one piece.
        self.spaced = any(SPACE in p[1:].lstrip(SPACE) or (p[0] != SPACE and SPACE in p) for p in self.ids)
        self.worst = min(self.scores, default=0.0) - 10.0
        self.lanes = Lanes(self)

    @staticmethod
    def load(path: str, shift: float = 10.0) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_file=path)
        n = p.get_piece_size()
        kind = lambda i: "byte" if p.is_byte(i) else "other" if p.is_control(i) or p.is_unknown(i) or p.is_unused(i) else "normal"
        scores = [p.get_score(i) for i in range(n)]
        normal = [scores[i] for i in range(n) if kind(i) == "normal"]
        if normal and all(s == int(s) for s in normal):  # ranks of merges
            scores = [-math.log(max(0.0, -s) + 1 + shift) for s in scores]
        return Vocabulary((p.id_to_piece(i), scores[i], kind(i)) for i in range(n))

    def fallback(self, c: str) -> tuple[tuple[int, ...], float]:
        """Byte pieces of one character and their score."""
        raw = (SPACE if c in (LITERAL, SPACE) else c).encode("utf-8")
        if any(b not in self.bytes for b in raw):
            raise ValueError(f"no piece and no bytes for {c!r}")
        return tuple(self.bytes[b] for b in raw), self.worst

    def matches(self, window: str) -> tuple[tuple[tuple[int, float], ...], bool]:
        """(length, score) of the pieces that begin ``window``, and whether longer ones may go on behind it.

        A first character that is no piece has its byte fallback as a match."""
        out, more = [], False
        for k in range(1, len(window) + 1):
            found = self.starts.get(window[:k])
            if found is None:
                break
            if found[0] >= 0:
                out.append((k, found[1]))
            more = k == HEAD
        if not out or out[0][0] != 1:
            out.insert(0, (1, self.fallback(window[0])[1]))
        if len(self.heads) > 400_000:
            self.heads.clear()
        self.heads[window] = tuple(out), more
        return self.heads[window]

    def _advance(self, text: str, at: int, stop: int, n: int, total: list[float], back: list[int]) -> None:
        """Carries all paths that end at ``at`` and the places up to ``stop`` one piece on, not past ``n``."""
        heads, look = self.heads, self.starts.get
        for a in range(at, stop):
            score, window = total[a], text[a : a + HEAD]
            found = heads.get(window)
            if found is None:
                found = self.matches(window)
            for k, own in found[0]:
                own += score
                k += a
                if own > total[k]:
                    total[k] = own
                    back[k] = a
            if found[1]:
                k = a + HEAD + 1
                while k <= n:
                    own = look(text[a:k])
                    if own is None:
                        break
                    if own[0] >= 0 and score + own[1] > total[k]:
                        total[k] = score + own[1]
                        back[k] = a
                    k += 1

    def _path(self, text: str, k: int, back: list[int]) -> list[int]:
        """Ids of the path that ends at place ``k``."""
        out, ids = [], self.ids
        while k:
            a = back[k]
            i = ids.get(text[a:k])
            if i is None:
                out.extend(reversed(self.fallback(text[a])[0]))
            else:
                out.append(i)
            k = a
        out.reverse()
        return out

    def stream(self, chars: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of escaped text, given in any parts, committed as soon as they are certain.

        Scores are kept as far back as the longest piece reaches, backpointers to the last committed boundary. After every
        ``longest`` characters the surviving paths are followed back to where they converge, which is
        committed; where they don't (a long run of one letter), they are followed again when twice as much has
        passed, so time stays linear. Text that ends within two strides is one window."""
        stride, nothing = self.longest, -math.inf
        text, total, back, at, wait = "", [0.0], [0], 0, stride
        parts, ended = (part[k : k + 4096] for part in chars for k in range(0, len(part), 4096)), False
        while not ended or at < len(text):
            while not ended and len(text) < at + 2 * stride:
                part = next(parts, None)
                ended = part is None
                text += part or ""
            whole = ended and len(text) <= at + 2 * stride
            stop = len(text) if whole else at + stride
            reach = min(len(text), stop + stride)
            grown = reach + 1 - len(total)
            total += [nothing] * grown
            back += [0] * grown
            self._advance(text, at, stop, reach, total, back)
            at = stop
            if at < wait and not whole:
                continue
            # Surviving paths end here or behind; the farthest steps back until all meet.
            live = {at} if whole else {at, *(k for k in range(at + 1, len(total)) if total[k] > nothing)}
            while len(live) > 1:
                far = max(live)
                live.discard(far)
                live.add(back[far])
            meet = live.pop()
            if meet:
                yield from self._path(text, meet, back)
                # What is committed leaves the window; no difference of scores changes.
                text, total, back, at = text[meet:], [x - total[meet] for x in total[meet:]], [x - meet for x in back[meet:]], at - meet
            wait = max(stride, 2 * at)

    def decode(self, ids: Iterable[int]) -> str:
        """The text; bytes join to characters, the space put before the text goes."""
        ids = list(ids)
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.plain[i] for i in ids])[1:]
        parts, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            parts.append(self.plain[i])
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        return "".join(parts)[1:]


class Lanes:
    """The search over many short stretches at once, position by position: what ``Vocabulary.stream`` gives for each.

    Its window is the longest piece's reach; a stretch is committed at its end, where all of its paths converge."""

    def __init__(self, v: Vocabulary, chunk: int = 1024):
        self.v, self.chunk = v, chunk
        letters = sorted({c for p in v.ids for c in p})
        self.letter = np.full(0x110000, len(letters), dtype=np.int64)
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters))
        self.width = len(letters) + 1
        # A state for each beginning of a piece, the empty one first; transitions in a table with open addressing.
        states = {"": 0} | {p: i for i, p in enumerate(v.starts, 1)}
        of = np.array([states[p[:-1]] * self.width + self.letter[ord(p[-1])] for p in v.starts], dtype=np.int64)
        self.bits = max(4, int(len(of) * 8).bit_length())
        self.keys, self.next = np.full(1 << self.bits, -1, dtype=np.int64), np.zeros(1 << self.bits, dtype=np.int32)
        left, slot = np.arange(len(of)), self._slot(of)
        while len(left):  # the first that claims a free slot has it, the others go on to the next slot
            free = np.flatnonzero(self.keys[slot[left]] == -1)
            claim, at = np.unique(slot[left[free]], return_index=True)
            took = left[free[at]]
            self.keys[claim], self.next[claim] = of[took], took + 1
            left = left[self.keys[slot[left]] != of[left]]
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
        self.id = np.array([-1, *(i for i, _ in v.starts.values())], dtype=np.int32)
        self.score = np.array([0.0, *(x for _, x in v.starts.values())])

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _step(self, key: np.ndarray) -> np.ndarray:
        """States that transitions lead to, 0 where there is none."""
        slot = self._slot(key)
        met = self.keys[slot]
        out = np.where(met == key, self.next[slot], 0)
        left = np.flatnonzero((met != key) & (met != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            met = self.keys[slot[left]]
            hit = met == key[left]
            out[left[hit]] = self.next[slot[left[hit]]]
            left = left[~hit & (met != -1)]
        return out

    def __call__(self, stretches: list[str]) -> list[bytes]:
        """The stretches' ids as little-endian 32-bit numbers."""
        out = np.empty(len(stretches), dtype=object)
        order = np.argsort(-np.fromiter(map(len, stretches), dtype=np.int64, count=len(stretches)), kind="stable")
        for lo in range(0, len(order), self.chunk):
            places = order[lo : lo + self.chunk]
            out[places] = self._chunk([stretches[i] for i in places.tolist()])
        return out.tolist()

    def _chunk(self, texts: list[str]) -> list[bytes]:
        """``texts``: the longest first."""
        n, most, reach = len(texts), len(texts[0]), min(self.v.longest, len(texts[0]))
        sizes = np.array([len(t) for t in texts])
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        lane = np.repeat(np.arange(n), sizes)
        place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        letter = self.letter[points]
        room = sizes[lane] - place
        # By lane, end and reach - length of a piece.
        score = np.full((n, most + 1, reach), -np.inf)
        ids = np.full((n, most + 1, reach), -1, dtype=np.int32)
        state, at = np.zeros(len(points), dtype=np.int64), np.arange(len(points))
        # Letters that are no piece become byte pieces.
        score[lane, place + 1, reach - 1] = self.v.worst
        unknown = np.empty(0, dtype=np.int64)
        for k in range(1, reach + 1):
            state = self._step(state * self.width + letter[at + k - 1])
            piece = self.id[state]
            found = np.flatnonzero(piece >= 0)
            if k == 1:
                unknown = np.flatnonzero(piece < 0)
            where = at[found]
            score[lane[where], place[where] + k, reach - k] = self.score[state[found]]
            ids[lane[where], place[where] + k, reach - k] = piece[found]
            on = (state > 0) & (room[at] > k)
            at, state = at[on], state[on]
        total = np.full((n, reach + most + 1), -np.inf)
        total[:, reach] = 0.0
        length = np.zeros((n, most + 1), dtype=np.int64)
        for end in range(1, most + 1):
            m = int(np.searchsorted(-sizes, -end, side="right"))
            paths = total[:m, end : end + reach] + score[:m, end]
            best = paths.argmax(axis=1)  # of equal ones the first: the longest last piece
            total[:m, reach + end] = paths[np.arange(m), best]
            length[:m, end] = reach - best
        back, rows, ends = [], np.arange(n), sizes.copy()
        while len(rows):
            k = length[rows, ends]
            back.append((rows, ids[rows, ends, reach - k], ends - k))
            ends = ends - k
            rows, ends = rows[ends > 0], ends[ends > 0]
        rows, found, first = (np.concatenate([x[i] for x in reversed(back)]) for i in range(3))
        turn = np.argsort(rows, kind="stable")
        found, first = found[turn], first[turn]
        cuts = [0, *np.cumsum(np.bincount(rows, minlength=n)).tolist()]
        raw = found.astype("<i4").tobytes()
        out = [raw[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]
        for i in np.unique(lane[unknown]).tolist():
            a, b = cuts[i], cuts[i + 1]
            ids = [y for x, c in zip(found[a:b].tolist(), first[a:b].tolist(), strict=True) for y in ((x,) if x >= 0 else self.v.fallback(texts[i][c])[0])]
            out[i] = np.array(ids, dtype="<i4").tobytes()
        return out


class Encoder:
    """Whole texts to ids. Stretches are remembered in two generations of at most about ``keep``, so frequent ones stay."""

    def __init__(self, vocabulary: Vocabulary, keep: int = 200_000):
        self.v, self.keep, self.short = vocabulary, keep, 2 * vocabulary.longest
        self.seen: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        # A stretch ends before a space that follows something else: no piece spans that boundary, so all paths converge there.
        self.cuts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def split(self, text: str) -> list[str]:
        """The escaped text cut at boundaries that no piece spans."""
        if not text:
            return []
        escaped = SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)
        if self.v.spaced:
            return [escaped]
        found = self.cuts.findall(escaped)
        if len(max(found, key=len)) <= self.short:
            return found
        return [part for x in found for part in ([x] if len(x) <= self.short else self.parts(x))]

    def parts(self, stretch: str) -> list[str]:
        """A longer stretch, cut between neighbours that are in no piece."""
        pairs = self.v.pairs
        cuts = [k for k, x in enumerate(zip(stretch, stretch[1:], strict=False), 1) if x not in pairs]
        return [stretch[a:b] for a, b in zip([0, *cuts], [*cuts, len(stretch)], strict=True)]

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text. Short stretches not met before are searched side by side, longer ones stream by."""
        cut = [self.split(t) for t in texts]
        if len(self.seen) > self.keep:
            self.before, self.seen = self.seen, {}
        seen, before, fresh = self.seen, self.before, []
        ids_of = [list(map(seen.get, found)) for found in cut]
        for x in {x for found, ids in zip(cut, ids_of, strict=True) for x, known in zip(found, ids, strict=True) if known is None}:
            ids = before.get(x)
            if ids is not None:
                seen[x] = ids
            elif len(x) <= self.short:
                fresh.append(x)
        seen.update(zip(fresh, self.v.lanes(fresh), strict=True))
        for found, ids in zip(cut, ids_of, strict=True):
            for i, known in enumerate(ids):
                if known is None:
                    ids[i] = seen.get(found[i]) or np.fromiter(self.v.stream((found[i],)), dtype="<i4").tobytes()
        return [np.frombuffer(b"".join(ids), dtype="<i4") for ids in ids_of]

    def __call__(self, text: str) -> list[int]:
        return self.batch([text])[0].tolist()


def encode_documents(docs: DataFrame, model_path: str, shift: float = 10.0) -> DataFrame:
    """doc_id, n_chars, n_ids, ids and decoded_sha256: the digest of what decoding gives, which is the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(Vocabulary.load(model_path, shift))
        for batch in batches:
            rows = []
            for lo in range(0, len(batch), 64):
                part = batch.iloc[lo : lo + 64]
                for doc, text, ids in zip(part["doc_id"], part["text"], encode.batch(part["text"].tolist()), strict=True):
                    rows.append((doc, len(text), len(ids), ids, hashlib.sha256(encode.v.decode(ids.tolist()).encode("utf-8")).hexdigest()))
            out = pd.DataFrame(rows, columns=["doc_id", "n_chars", "n_ids", "ids", "decoded_sha256"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    small_batches(docs.sparkSession)
    return spread(docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))).mapInPandas(run, ENCODED)
