"""The pipeline, the registered queries, and tables with nothing in them."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from storelens.llm.circulant_minhash import near_duplicates
from storelens.llm.queries import QUERIES
from storelens.llm.spaced_seeds import contaminated

SMALL = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = entry.queries()
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")  and n[2].isdigit()}
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), *docs.columns[1:])
    docs = docs.union(docs.limit(3)).union(extra)
    columns, left = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SMALL)
        path = str(tmp_path / name)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        left[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == columns and docs.count() <= before.count()
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in left.items()}
    good = left["quality_classifier"]
    found = near_duplicates(good, words=5).where("doc_id is not null").collect()
    assert ids["minhash_near_dedup"] - {None} == {r["doc_id"] for r in found if r["kept"]}
    assert left["minhash_near_dedup"].where("doc_id is not null").groupBy("doc_id").count().where("count > 1").count() == 0
    leaks = {r["doc_id"] for r in contaminated(left["minhash_near_dedup"], spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert ids["benchmark_decontamination"] == ids["minhash_near_dedup"] - leaks
    assert ids["secret_scans"] == ids["benchmark_decontamination"] == ids["best_fit_packing"]
    assert left["secret_scans"].where(F.length("text") != F.col("n_chars")).count() == 0


def test_whole_pipeline(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("nothing")
    for table in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(os.path.join(folder, f"{table}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_empty_tables(spark, nothing, name):
    full, empty = entry.queries()[name](spark, SMALL), entry.queries()[name](spark, nothing)
    assert empty.schema == full.schema and empty.collect() == []
