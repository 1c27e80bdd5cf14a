"""Small helpers the operators share: reading, staging, batch size, components."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.session import stage, tune

__all__ = ["components", "prepared", "read", "rows_as", "stage"]

_ROOT = str(Path(__file__).resolve().parents[2])

#: Rows of one Arrow batch, so that batches of long texts stay small.
BATCH_ROWS = 500


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and small Arrow batches.

    Python workers import this package: on a cluster it is shipped to them
    (``--py-files`` or an image); on one machine they get its folder.
    """
    tune(spark)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{table}.parquet")


def rows_as(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names an operator uses for them; what
    else the table has, clashing names included, does not come along."""
    return docs.select(*[F.col(f"`{theirs}`").alias(ours) for ours, theirs in columns.items()])


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of the nodes of an undirected edge table (a, b).

    Alternates large-star and small-star steps: every node hands its larger, then
    its smaller neighbours to its smallest one, until the edges are stars. Each
    step is a grouping that combines before the shuffle and a join that adaptive
    execution can split; each result is a written table, so no lineage grows.
    """
    edges = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges = stage(edges.where("hi > lo").distinct(), f"{name}-edges")
    state = None
    while True:
        both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.where("hi > lo").distinct()
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        handed = large.join(small, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        own = small.select("hi", F.col("m").alias("lo"))
        edges = stage(handed.union(own).distinct(), f"{name}-stars")
        found = edges.agg(
            F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.count_distinct("hi")
        ).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    leaves = edges.groupBy("hi").agg(F.min("lo").alias("component")).withColumnRenamed("hi", "node")
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return leaves.union(roots)
