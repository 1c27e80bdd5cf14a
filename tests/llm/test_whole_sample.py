"""A repeated document counts once in the training sample."""

import numpy as np
from pyspark.sql import functions as F

from storelens.llm import attention_quality

FOLDER = "/root/testdata/sf0.01"


def test_repeated_id_counts_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id is not null").dropDuplicates(["doc_id"])
    docs = docs.localCheckpoint()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    known = docs.join(labels, "doc_id").where(~attention_quality.held_out() & F.col("text").isNotNull())
    one = known.agg(F.min("doc_id")).first()[0]
    again = docs.where(F.col("doc_id") == one).crossJoin(spark.range(300)).drop("id")
    few = attention_quality.train(docs, labels)
    many = attention_quality.train(docs.union(again), labels)
    assert all(np.allclose(few.weights[k], many.weights[k]) for k in few.weights)
