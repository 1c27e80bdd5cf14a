"""The training-data pipeline: five stages, each written before the next reads it.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``docs`` is what
the stage before kept. All but the last return the columns of ``documents``.
Rows without an id pass the stages that decide by id, as nothing can name them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import attention_quality, secret_cnn
from storelens.llm.circulant_minhash import near_duplicates
from storelens.llm.frames import read, stage
from storelens.llm.grouped_packing import pack
from storelens.llm.spaced_seeds import contaminated


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose id is not among those to go."""
    return docs.join(gone.select(F.col("doc_id").alias("gone")), F.col("doc_id") == F.col("gone"), "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = attention_quality.train(docs, read(spark, sf_dir, "labels"))
    return attention_quality.keep_good(docs, model)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest
    id: shingles of five words, similarity 0.8 or more."""
    found = near_duplicates(docs, words=5, percent=80)
    kept = _without(docs, found.where("doc_id is not null and not kept"))
    # copies of a row, with the same id, are one document as well
    return kept.dropDuplicates(["doc_id", "text"])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark text of five words or more go; a shorter
    one, such as a single common word, says nothing about where a text is from."""
    return _without(docs, contaminated(docs, read(spark, sf_dir, "benchmark")))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    cleaned = secret_cnn.redact(docs, secret_cnn.train(docs))
    return cleaned.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as places in training sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models and the packing can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
