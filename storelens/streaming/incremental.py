"""Incremental extract of landed files.

The batch extract is bounded by a date somebody picks. As a stream the bound
is kept by the checkpoint: a run takes the files that have landed since the
last one, cleans them and appends them to the table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelens.operators.cleaning import process_table


def extract_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append everything that is new in ``source`` to ``target``, then stop."""
    landed = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    return (
        process_table(landed, table)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
