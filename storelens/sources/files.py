"""CSV and Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators.cleaning import process_table
from storelens.sources.records import (
    LATIN_1,
    UTF_8,
    chosen_encoding,
    decodable,
    file_name,
    read_wide,
)

# Fixed value: how the product master file is encoded.
MASTER_ENCODING = "ISO-8859-1"


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """The product master, cleaned."""
    return process_table(read_wide(spark, path, MASTER_ENCODING), "master_sku")


def csv_encodings(spark: SparkSession, path: str) -> DataFrame:
    """First of utf-8, windows-1252 and latin-1 that can decode a file, per file.

    Lines are looked at as bytes, so a large file is checked in parts by many
    tasks and never held in memory as a whole.
    """
    utf_8, windows = decodable(F.col("value"))
    checked = spark.read.option("lineSep", "\n").text(path).select(
        file_name(),
        F.col("_metadata.file_path").alias("file_path"),
        utf_8.alias("utf_8"),
        windows.alias("windows"),
    )
    encoding = chosen_encoding(F.bool_and("utf_8"), F.bool_and("windows"))
    return checked.groupBy("file", "file_path").agg(encoding.alias("encoding"))


def read_text_csvs(spark: SparkSession, path: str, own_headers: bool = False) -> DataFrame:
    """All CSV files of a folder, each in the encoding and with the headers it has.

    Every cell is text. All files go through one plan, whatever their headers, and
    are put together by column name: a column that a file lacks is empty there, as
    an empty cell is. A byte-order mark is dropped. Adds ``file`` and ``row_no``,
    the line in the file a row begins on. ``own_headers`` also adds ``header``, the
    columns of the file in its order, stripped. The driver learns the names of the
    columns, never a line or a file. Names are told apart as in ``read_cells``,
    which has the same rows without the wide columns.
    """
    return read_wide(spark, path, own_headers=own_headers)


def write_csv(df: DataFrame, path: str) -> None:
    """A report as CSV with headers. Reports are small and ordered; keep the order."""
    df.write.mode("overwrite").csv(path, header=True)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """A table as Parquet, replaced as a whole."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register(spark: SparkSession, name: str, path: str) -> None:
    """Make a stored table known to SQL under a name, if it is not known yet."""
    if not spark.catalog.tableExists(name):
        spark.read.parquet(path).createOrReplaceTempView(name)
