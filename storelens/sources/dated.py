"""Tables stored by day, and by key within a day.

A run of an extract replaces the days it covers and leaves earlier ones alone, so
a table grows by a window at a time while every report reads only the days it
asks for. With a key the rows of a day are also dealt to a fixed number of
buckets, so that two tables with the same number meet on the key without a
shuffle.

Spark keeps buckets in its catalog only. A stored table therefore has a one-row
description beside its data (``_layout``, which scans leave out), from which any
session declares it again; that also gives an extract without rows its columns.
"""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import asdict, dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.dates import ts

LAYOUT = "_layout"

#: Rows without a key would all be in one bucket's file; they are spread over this
#: many files of it, which scans that ask for a key skip by their statistics.
KEYLESS_FILES = 16


@dataclass(frozen=True)
class Layout:
    """How a table is stored: its columns as JSON, the day column, key and buckets."""

    columns: str
    day: str
    key: str | None = None
    buckets: int = 0


def day_column(column: str) -> str:
    """The name of the column that holds the day of a moment."""
    return f"{column}_day"


def with_day(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(day_column(column), F.col(column).cast("date"))


def since_day(df: DataFrame, column: str, bound: datetime) -> DataFrame:
    """Rows at or after a moment, of a table that has the moment, its day, or both.
    The day reaches the scan as a filter of folders."""
    day = day_column(column)
    tests: list[Column] = []
    if day in df.columns:
        tests.append(F.col(day) >= F.lit(bound.date()))
    if column in df.columns:
        tests.append(F.col(column) >= ts(bound))
    elif bound.time() != datetime.min.time():
        raise ValueError(f"{bound} is within a day, the table has {day} only")
    if not tests:
        raise ValueError(f"the table has neither {column} nor {day}")
    for test in tests:
        df = df.filter(test)
    return df


def latest_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows of the latest moment of a table. Of a table by day only the folder
    names and the last day are read."""
    day = day_column(column)
    if day in df.columns:
        df = df.filter(F.col(day) == df.agg(F.max(day)).scalar())
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def _name(path: str) -> str:
    """The catalog's name for a path, the same in every session."""
    return f"days_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:24]}"


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def read_layout(spark: SparkSession, path: str) -> Layout | None:
    """The description of a table by day; None for any other table."""
    where = os.path.join(path, LAYOUT)
    if not _exists(spark, where):
        return None
    return Layout(**json.loads(spark.read.text(where).first()["value"]))


def _declare(spark: SparkSession, path: str, layout: Layout) -> str:
    """Make a stored table known with its buckets and the days it has by now."""
    name = _name(path)
    spark.sql(f"drop table if exists {name}")  # an external table: its files stay
    columns = T.StructType.fromJson(json.loads(layout.columns))
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    clustered = f"clustered by (`{layout.key}`) into {layout.buckets} buckets" if layout.key else ""
    spark.sql(
        f"create table {name} ({declared}) using parquet partitioned by (`{layout.day}`) {clustered} "
        f"location '{path}'"
    )
    spark.sql(f"alter table {name} recover partitions")
    return name


def open_days(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``write_days`` stored."""
    layout = read_layout(spark, path)
    if layout is None:
        raise FileNotFoundError(f"no table by day at {path}")
    return spark.table(_declare(spark, path, layout))


def _dealt(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows of a bucket of a day in one task each, so that every bucket is a file."""
    if not layout.key:
        # a day may hold most rows: a few tasks, hence files, a day
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(KEYLESS_FILES))
        return df.repartition(layout.day, spread)
    key = F.col(f"`{layout.key}`")
    bucket = F.pmod(F.hash(key), F.lit(layout.buckets))
    rest = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(KEYLESS_FILES))
    return df.repartition(layout.day, bucket, F.when(key.isNull(), rest))


def _first_files(df: DataFrame, day: str) -> dict[date, str]:
    """One file of each day, as many entries as days. A rewritten day has other files."""
    files = df.groupBy(day).agg(F.min("_metadata.file_path").alias("file"))
    return {row[0]: row["file"] for row in files.collect()}


def write_days(
    df: DataFrame,
    path: str,
    column: str,
    first: date | None = None,
    key: str | None = None,
    buckets: int = 0,
) -> int:
    """Store rows by the day of ``column``, replacing every day from ``first`` on,
    or all days.

    ``df`` has the moment or its day (``day_column``). Rows before ``first`` or
    without a moment are not of the days covered and are left out. Covered days
    that had rows before and have none now become empty. Key and buckets of a
    stored table can't change. Returns the rows written.
    """
    spark = df.sparkSession
    day = day_column(column)
    if day not in df.columns:
        df = with_day(df, column)
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c != day], day)
    # all columns may be null, as they are when read back
    fields = [T.StructField(f.name, f.dataType) for f in df.schema]
    layout = Layout(T.StructType(fields).json(), day, key, buckets)
    stored = read_layout(spark, path)
    if stored is None:
        text = spark.createDataFrame([(json.dumps(asdict(layout)),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(os.path.join(path, LAYOUT))
    elif stored != layout:
        raise ValueError(f"{path} is stored as {stored}, not as {layout}")
    name = _declare(spark, path, layout)
    covered = F.col(day).isNotNull() if first is None else F.col(day) >= F.lit(first)
    before = _first_files(spark.table(name).filter(covered), day)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        _dealt(df.filter(covered), layout).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    after = _first_files(spark.table(name).filter(covered), day)
    nothing = ", ".join(f"cast(null as {f.dataType.simpleString()})" for f in fields[:-1])
    for gone in sorted(d for d in before if before[d] == after.get(d)):
        spark.sql(f"insert overwrite table {name} partition (`{day}` = date'{gone}') select {nothing} where false")
    # the covered days hold what was written; counted by the files' own row counts
    return spark.table(name).filter(covered).count()
