"""Identity and deterministic sampling: everything derives from SHA-256 of canonical text."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

U64 = "decimal(20,0)"


def canonical_json(value: Any) -> str:
    """Sorted keys, no spaces, ASCII only."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def identity_of(value: Any) -> str:
    """SHA-256 of the canonical JSON of ``value``."""
    return sha256_hex(canonical_json(value))


def u64(text: Column) -> Column:
    """The first eight bytes of SHA-256 as an unsigned number (a decimal, never sign-wrapped)."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast(U64)


def hash_score(namespace: str, seed: str, token: Column) -> Column:
    """u64 of ``namespace|seed|token``."""
    return u64(F.concat_ws("|", F.lit(namespace), F.lit(seed), token.cast("string")))


def sampled(namespace: str, seed: str, token: Column, threshold: int, modulus: int) -> Column:
    """Whether the token's score modulo ``modulus`` is below ``threshold``."""
    if not 0 <= threshold <= modulus or modulus <= 0:
        raise ValueError("threshold must lie in 0..modulus")
    return hash_score(namespace, seed, token) % F.lit(modulus) < threshold


def sampling_rate(threshold: int, modulus: int) -> float:
    """Per cent, rounded to six places."""
    return round(threshold / modulus * 100, 6)


def game_id(archive_sha: Column, index: Column) -> Column:
    return F.sha2(F.concat_ws("|", archive_sha, index.cast("string")), 256)


def position_id(fen4: Column) -> Column:
    return F.sha2(F.concat(F.lit("fen4_legal_ep_v1|"), fen4), 256)


def hmac_sha256(key: bytes, message: Column) -> Column:
    """HMAC-SHA256 in hexadecimal from two SHA-256 calls over padded bytes."""
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)
    digest = F.unhex(F.sha2(F.concat(F.lit(bytearray(inner)), message.cast("binary")), 256))
    return F.sha2(F.concat(F.lit(bytearray(outer)), digest), 256)


def player_hash(name: Column, key: bytes | None = None) -> Column:
    """``player_`` and 24 hexadecimal digits of the trimmed lower-cased name; null for blank names."""
    token = F.lower(F.trim(name))
    digest = hmac_sha256(key, token) if key else F.sha2(F.concat(F.lit("fixture-placeholder|"), token), 256)
    return F.when(token != "", F.concat(F.lit("player_"), F.substring(digest, 1, 24)))
