import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from plyforge.llm.common import shared_dir
from tests.llm.helpers import ODD
from tests.llm.test_near_dup import brute

SMALL = "/root/testdata/sf0.001"


def write_tables(spark, folder, rows, labels):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int"
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 3) for i, t in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").filter("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
        rows = [r.asDict() for r in out.collect()]
        have = [r["doc_id"] for r in docs.select("doc_id").collect()]
        if name == "toxicity":
            gone = set(have) - {r["doc_id"] for r in rows}
            assert len(gone & toxic) >= 0.5 * len(toxic) and len(gone - toxic) <= 0.05 * len(have)
        if name == "language":
            assert len(rows) >= 0.97 * len(have)
        if name == "near_dup":
            want = {a for a, _, c in brute([(r.doc_id, r.text) for r in docs.collect()], 5, 80) if a == c}
            assert {str(r["doc_id"]) for r in rows} == want
        if name == "secrets":
            assert len(rows) == len(have) and all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] != first[r["doc_id"]])
            named = [r for r in rows if "password=" in first[r["doc_id"]] or "AKIA" in first[r["doc_id"]]]
            assert all("[SECRET]" in r["text"] and "AKIA" not in r["text"] for r in named)
        if name == "packing":
            check_packed(rows, {r.doc_id: r.text for r in docs.collect()})
        docs = spark.createDataFrame(out.toPandas(), out.schema) if name != "packing" else out


def check_packed(rows, texts):
    from tokenizers import Tokenizer

    from plyforge.llm.queries import tokenizer_files

    slow = Tokenizer.from_file(tokenizer_files()["vocabulary"])
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        ids = np.array([*slow.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0], dtype="<u4")
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())


def test_language_stage_drops_texts_of_no_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    noise = ["9fQ2xLk8Rz7VbN3mTt6YcW1aHs5Dg0Pj4Ue" * 30, "0123456789abcdef" * 50, "asdf jkl qwz xkcd lkj hgf " * 20, "Привет мир, как дела сегодня " * 10, "これは日本語の文章です。" * 20]
    more = docs.limit(1).select(*[c for c in docs.columns if c not in ("doc_id", "text")]).withColumn("lang", F.lit(None).cast("string"))
    more = more.crossJoin(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(noise)], "doc_id long, text string")).select(docs.columns)
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs.unionByName(more), "").select("doc_id").collect()}
    assert not {i for i in kept if i < 0} and len(kept) >= 0.98 * docs.count()


def test_odd_rows_and_run(spark, tmp_path):
    rows = ODD + [(100 + i, f"nice words number {i} all fine") for i in range(30)] + [(200 + i, f"you idiot number {i} all fine") for i in range(30)] + [(None, None), (7, "1234 5678")]
    write_tables(spark, str(tmp_path), rows, [(100 + i, 1, 0) for i in range(30)] + [(200 + i, 1, 1) for i in range(30)])
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r.doc_id for r in out if r.piece == 0]
    assert 10 in ids and ids.count(10) == 1 and 12 in ids and None in ids
    assert not {5, 4, 3, 7} & set(ids) and not any(i is not None and 200 <= i < 230 for i in ids)


def test_clashing_columns_are_carried(spark, tmp_path):
    rows = [(i, f"some nice words here number {i} and {i * 7} more of them") for i in range(12)]
    write_tables(spark, str(tmp_path), rows, [(0, 1, 0), (1, 1, 1)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name in ("toxicity", "_row", "_doc", "spans", "lang_pred", "tie"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert {(r.score, r.toxicity, r._row, r._doc, r.spans, r.lang_pred, r.tie) for r in out.collect()} <= {(3, "own toxicity", "own _row", "own _doc", "own spans", "own lang_pred", "own tie")}


def test_empty_tables(spark, tmp_path):
    write_tables(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_tables_have_few_files_however_many_shuffle_partitions(spark, tmp_path):
    """Every file on a local disk starts processes; a task of a small table is none."""
    rows = [(i, f"some nice words here number {i // 2} and {i // 2 * 7} more of them to be read by everyone") for i in range(200)] + [(300 + i, f"you idiot number {i} all fine") for i in range(30)]
    write_tables(spark, str(tmp_path), rows, [(i, 1, 0) for i in range(0, 60, 2)] + [(300 + i, 1, 1) for i in range(30)])
    docs, names = spark.read.parquet(f"{tmp_path}/documents.parquet"), ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before, most = {k: spark.conf.get(k) for k in names}, 2 * spark.sparkContext.defaultParallelism
    shared = Path(shared_dir(spark).removeprefix("file://"))
    old = set(shared.iterdir())
    try:
        for k, v in zip(names, ("64", "false"), strict=True):
            spark.conf.set(k, v)
        kept = corpus_pipeline.near_dup_stage(spark, docs, str(tmp_path))
        kept.write.parquet(f"{tmp_path}/out/kept")
        packed = corpus_pipeline.packing_stage(spark, docs, str(tmp_path))
        packed.write.parquet(f"{tmp_path}/out/packed")
        corpus_pipeline.toxicity_stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out/clean")
        assert {r.doc_id for r in kept.collect()} == set(range(0, 200, 2)) | set(range(300, 330))
        places = packed.collect()
        assert {r.doc_id for r in places} == {i for i, _ in rows} and len({(r.sequence_id, r.offset) for r in places}) == len(places)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {p.name: len(list(p.glob("part-*"))) for p in [*set(shared.iterdir()) - old, *(tmp_path / "out").iterdir()]}
    assert len(files) > 12 and max(files.values()) <= most, files
