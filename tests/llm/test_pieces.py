import hashlib
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plyforge.llm import pieces
from tests.llm.helpers import ODD, docs

BYTES = [(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)]
NORMAL = [("a", -3.0), ("b", -3.1), ("c", -3.3), ("ab", -4.0), ("bc", -4.2), ("abc", -5.9), ("aab", -5.5), ("▁", -2.0), ("▁a", -3.5), ("▁ab", -4.4), ("cab", -6.0), ("bcabc", -8.1)]


def toy(extra=()):
    return pieces.Vocabulary([("<unk>", 0.0, "other"), *BYTES, *[(p, s, "normal") for p, s in [*NORMAL, *extra]]])


def brute(v, text):
    """Best total score over all ways to cut a short text."""
    if not text:
        return 0.0
    best = -1e18
    for k in range(1, len(text) + 1):
        if text[:k] in v.ids:
            best = max(best, v.scores[v.ids[text[:k]]] + brute(v, text[k:]))
    if text[0] not in v.ids:
        best = max(best, v.fallback(text[0])[1] + brute(v, text[1:]))
    return best


def score(v, text, ids):
    """Sum of the pieces' scores; a character of byte pieces counts once."""
    raw = bytes(v.byte_of[i] for i in ids if i in v.byte_of).decode()
    return sum(v.scores[i] for i in ids if i not in v.byte_of) + v.worst * len(raw)


def lanes(v, *texts):
    return [np.frombuffer(raw, "<i4").tolist() for raw in v.lanes(list(texts))]


@settings(max_examples=150, deadline=None)
@given(st.text("abc▁é", max_size=11))
def test_best_score_equals_brute_force(text):
    v = toy()
    for ids in (list(v.stream([text])), *(lanes(v, text) if text else [])):
        assert score(v, text, ids) == pytest.approx(brute(v, text))


@settings(max_examples=100, deadline=None)
@given(st.text("abc ▁é\n", max_size=300))
def test_all_ways_of_streaming_give_the_same_ids_and_round_trip(text):
    for v in (toy(), toy([("a▁b", -4.0)])):
        escaped = pieces.SPACE + text.replace(pieces.SPACE, pieces.LITERAL).replace(" ", pieces.SPACE)
        ids = list(v.stream(escaped)) if text else []  # character by character
        for keep in (3, 1000):
            assert pieces.Encoder(v, keep=keep)(text) == ids
        assert v.decode(ids) == text and (not text or lanes(v, "a", escaped, "b▁c")[1] == ids)


def test_window_stays_bounded_and_ids_come_early():
    v, sizes, read, seen = toy(), [], 0, 0
    advance = v._advance
    v._advance = lambda *args: (sizes.append(len(args[4])), advance(*args))[1]

    def chars():
        nonlocal read
        for c in "abcab" * 4000:
            read += 1
            yield c

    late = 0
    for i in v.stream(chars()):
        seen += len(v.text[i])
        late = max(late, read - seen)
    assert seen == 20_000 and max(sizes) <= 4 * v.longest and late <= 5 * v.longest


def test_long_stretches_take_linear_time(model):
    encode = pieces.Encoder(pieces.Vocabulary.load(model))
    for text in ("".join(chr(0x4E00 + i * 7919 % 5000) for i in range(200_000)), "abcdefgh" * 25_000, "x" * 200_000, " " * 200_000):
        start = time.monotonic()
        assert encode.v.decode(encode(text)) == text
        assert time.monotonic() - start < 20


def test_ids_of_a_unigram_model_are_the_librarys(tmp_path):
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    kinds = {"other": 2, "byte": 6, "normal": 1}
    for piece, value, kind in [("<unk>", 0.0, "other"), *BYTES, *[(p, s - 0.0137 * i, "normal") for i, (p, s) in enumerate(NORMAL)]]:  # without ties
        proto.pieces.add(piece=piece, score=value, type=kinds[kind])
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback = 1, True
    proto.normalizer_spec.name, proto.normalizer_spec.remove_extra_whitespaces = "identity", False
    (tmp_path / "toy.model").write_bytes(proto.SerializeToString())
    library = SentencePieceProcessor(model_file=str(tmp_path / "toy.model"))
    encode, draw = pieces.Encoder(pieces.Vocabulary.load(str(tmp_path / "toy.model"))), random.Random(5)
    for _ in range(500):
        text = "".join(draw.choice("abc cabé") for _ in range(draw.randrange(60)))
        assert encode(text) == library.encode(text), text


@pytest.fixture(scope="module")
def model():
    import public_tokenizers as files

    return files.path("piece_bpe_32k.model")


def test_documents_round_trip(spark, sf_dir, model):
    from sentencepiece import SentencePieceProcessor

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()] + [(None if i is None else i + 800_000, t) for i, t in ODD] + [(900_091, "a▁b  c   "), (900_092, " lead"), (900_093, "x" * 70 + "日本語🎉" * 30)]
    got = pieces.encode_documents(docs(spark, rows), model).collect()
    want = sorted((str(i), len(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_chars, r.decoded_sha256) for r in got) == want
    library = SentencePieceProcessor(model_file=model)
    texts = {i: t or "" for i, t in rows}
    for r in got[:60]:
        assert r.n_ids == len(r.ids) and (r.doc_id in (900_091, 900_092) or r.doc_id is None or library.decode(list(r.ids)) == texts[r.doc_id])
    ordinary = [r for r in got if r.doc_id in texts and len(texts[r.doc_id]) > 200][:50]
    assert sum(r.n_ids for r in ordinary) <= 1.1 * sum(len(library.encode(texts[r.doc_id])) for r in ordinary)
    assert pieces.encode_documents(docs(spark, []), model).collect() == []
