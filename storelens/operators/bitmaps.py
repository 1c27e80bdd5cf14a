"""Exact sets of ids as bitmaps, for distinct counts over overlapping groups.

Counting distinct ids of many groups by (group, id) pairs moves every pair. Here
each id has a number, ids that go together have neighbouring ones, and a group's
ids become bits of a few bitmaps before anything is moved: 32,768 numbers a bitmap
of four kilobytes, which compress to what is set in them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.session import stage


def number_ids(ids: DataFrame, id_column: str, near: Column, name: str) -> DataFrame:
    """(id, n): a number for every row, close for rows with equal ``near``.

    ``ids`` has one row per id. Numbers depend on how rows are dealt, so they are
    written once and read from there, also by tasks that run again.
    """
    dealt = ids.withColumn("__near", near).repartition("__near")
    # numbers begin at 1, where a bucket begins
    return stage(dealt.select(id_column, (F.monotonically_increasing_id() + 1).alias("n")), name)


def bitmap_sets(rows: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """(keys, bucket, bits) of the numbers of every group. Tasks set their bits
    first; only bitmaps are moved."""
    placed = rows.select(
        *keys, F.bitmap_bucket_number(n).alias("bucket"), F.bitmap_bit_position(n).alias("bit")
    )
    return placed.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def set_sizes(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many numbers the union of each group's bitmaps has."""
    united = sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
