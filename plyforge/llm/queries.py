"""One query per training-data operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.llm import language, near_dup, packing, pieces, pitman_yor, secrets, topk, toxicity, url_filter, winnow
from plyforge.llm.common import remainder
from plyforge.llm.oracles import SQL

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> dict[str, str]:
    """Places of the public vocabulary files on this machine; every machine has them there."""
    import public_tokenizers as files

    return {"vocabulary": files.path("byte_bpe_50k.json"), "ranks": files.path("byte_bpe_50k.tiktoken"), "pattern": files.PATTERN}


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edit_report(_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), **tokenizer_files())


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = remainder(F.col("doc_id")) == 0
    langs, prototypes = language.fit(docs, ~held)
    return language.predict(docs.select("doc_id", held.alias("held_out"), "text"), langs, prototypes).select("doc_id", "held_out", "lang_pred", "score")


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(_table(spark, sf_dir, "documents"), remainder(F.col("doc_id")) == 1, context="lang")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as files

    return pieces.encode_documents(_table(spark, sf_dir, "documents"), files.path("piece_bpe_32k.model"))


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_dup.classify(_table(spark, sf_dir, "documents"), words=3, percent=85)
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held = remainder(F.col("doc_id")) == 0
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held)
    rows = toxicity.score(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return rows.select("doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5, scale=256)


def fingerprint_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op1 that SQL can express."""
    return winnow.edit_report(_table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256")


def secret_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op2 that SQL can express."""
    return secrets.report(_table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def language_model_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5 that SQL can express."""
    scored = pitman_yor.score(_table(spark, sf_dir, "documents"), remainder(F.col("doc_id")) == 1, context="lang")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_winnowing, op2_secret_scan, op3_packing, op4_language_id, op5_pitman_yor, op6_sentencepiece, op7_url_reputation, op8_minhash_near_dup, op9_toxicity, op10_exact_topk,
        fingerprint_edits, secret_base, language_model_base,
    )
}

__all__ = ["QUERIES", "RULES", "SQL", "tokenizer_files"]
