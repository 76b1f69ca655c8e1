"""The pipeline's contract: stages on whole inputs, columns kept, decisions in effect."""

import random

import numpy as np
from corpus_fixture import SCHEMA, make_corpus, prose

import __spark_entry__ as contract
import corpus_pipeline
from tissueframe.llm import queries, simhash


def write(spark, folder):
    rng = random.Random(12)
    rows = make_corpus(80)
    item = " ".join(f"item{i}" for i in range(25))
    rows += [(500, f"{prose(rng, 30)} {item} {prose(rng, 30)}", "en", "s1", None), (501, prose(rng, 80), "en", "s2", 1)]
    rows += [(600 + i, " ".join(prose(rng, 1).upper() + "!!" for _ in range(60)), "en", "s3", 2) for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, 0) for i in range(80)] + [(600 + i, 0, 0) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stages(spark, tmp_path):
    rows = write(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "copies", "leaks", "packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == SCHEMA.replace(",", "").split()[::2]
        path = f"{tmp_path}/out-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
    ids = {name: {r.doc_id for r in found} for name, found in seen.items()}
    assert not any(i and i >= 600 for i in ids["quality"]) and {500, 501} <= ids["quality"]
    assert len(seen["quality"]) >= len(rows) - 45
    values = np.array([simhash.fingerprint((r.text or "").encode()) for r in seen["copies"]], np.uint64)
    gaps = np.bitwise_count(values[:, None] ^ values[None])
    assert (gaps[~np.eye(len(values), dtype=bool)] > corpus_pipeline.COPY_BITS).all()
    assert 500 not in ids["leaks"] and ids["copies"] - ids["leaks"] == {500}
    assert {r.doc_id for r in seen["packing"]} == ids["leaks"]
    expected = spark.read.parquet(f"{tmp_path}/out-packing").groupBy("doc_id").sum("length").collect()
    whole = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").sum("length").collect()
    assert sorted(map(repr, expected)) == sorted(map(repr, whole))


def test_texts_go_to_python_in_small_batches(spark, tmp_path):
    write(spark, tmp_path)
    docs, name = spark.read.parquet(f"{tmp_path}/documents.parquet"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, kept in (("10000", corpus_pipeline.BATCH_ROWS), ("0", corpus_pipeline.BATCH_ROWS), ("50", 50)):
            spark.conf.set(name, given)
            corpus_pipeline.pack_tokens(spark, docs, str(tmp_path))
            assert int(spark.conf.get(name)) == kept
    finally:
        spark.conf.set(name, before)


def test_registered():
    named = contract.queries()
    assert set(queries.QUERIES) <= set(named) and named["pipeline"] is corpus_pipeline.run
    assert [sum(n.startswith(f"op{i}_") for n in named) for i in range(1, 11)] == [1] * 10
    assert "pipeline" not in contract.oracle_sql()
