"""The training-data pipeline: each stage works on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the folder that
the cluster shares and reads again as the next stage's documents. All stages but the last return
the columns of ``documents``.

Defined cases: null and empty texts are not toxic and pass the first stage; they have no language and go in
the second. Repeated rows are copies; the third stage keeps one. Empty tables stay empty. Extra columns
are carried through the stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.llm import language, near_dup, packing, secrets, toxicity
from plyforge.llm.common import few, remainder, written
from plyforge.llm.queries import tokenizer_files

#: A document goes if its toxicity is at least this.
MOST_TOXIC = 0.5
#: A document goes if it has no letters at all, or if its cosine is below what all but this share of its language's training documents reach.
LOWEST_SHARE = 0.005


def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _wrapped(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row apart, so that no column of a stage meets one of the documents'."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops toxic documents. The model is fitted on the labelled rows of the stage's documents."""
    model = toxicity.fit(docs, _source(spark, sf_dir, "labels").select("doc_id", "toxic"), F.lit(True))
    return toxicity.score(_wrapped(docs), model).filter(F.col("toxicity") < MOST_TOXIC).select("_doc.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: texts of no learned language score below its own.
    All training documents give the prototypes and the least scores; every text is scored once."""
    training = remainder(F.col("doc_id")) != 0
    langs, prototypes = language.fit(docs, training)
    if not langs:
        return docs
    named = written(language.predict(_wrapped(docs).drop("doc_id"), langs, prototypes).drop("text"), "named")
    known = named.filter(remainder(F.col("_doc.doc_id")) != 0).select("_doc.lang", "lang_pred", "score")
    floors = F.create_map(*[F.lit(x) for pair in language.least_scores(known, langs, LOWEST_SHARE).items() for x in pair])
    return named.filter((F.col("lang_pred") != "und") & (F.col("score") >= floors[F.col("lang_pred")])).select("_doc.*")


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates (five words, similarity 0.8): the one
    with the smallest id. Rows that repeat it entirely, and rows without an id, are told apart by their places."""
    rows = written(_wrapped(docs).drop("text").withColumn("_row", F.monotonically_increasing_id()), "rows")
    # Places stand for ids, so rows with one id, or none, are still documents of their own.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    classes = written(near_dup.classify(rows.select(F.col("_row").alias("doc_id"), F.col("_doc.text").alias("text")), words=5, percent=80).select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_class")), "classes")
    keys = rows.select("_row", "doc_id").join(classes, "_row")
    kept = keys.groupBy("_class").agg(F.min(order).alias("o")).select(F.col("o._row").alias("_row"))
    return few(rows.join(kept, "_row", "left_semi"), rows.count()).select("_doc.*")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mask; n_chars follows. Documents without secrets stay as they are."""
    return secrets.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all that is left into sequences of at most 2048 tokens; a row per piece."""
    return few(packing.pack_documents(docs, **tokenizer_files()), docs.count())


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_dup", near_dup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Learned models, near-duplicate classes and token ids have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the packed pieces."""
    docs = _source(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
