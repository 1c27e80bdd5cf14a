"""Named extracts written one after the other, with their row counts."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storelens.sources.dated import write_days
from storelens.sources.files import write_table

Extract = Callable[[], DataFrame]


@dataclass(frozen=True)
class ByDay:
    """Store an extract by the day of a column, replacing the days from ``first``
    on, or all; with a key, in buckets of it."""

    column: str
    first: date | None = None
    key: str | None = None
    buckets: int = 0


def run_extracts(
    spark: SparkSession,
    extracts: Mapping[str, Extract],
    folder: str,
    partition_by: Mapping[str, str] | None = None,
    by_day: Mapping[str, ByDay] | None = None,
) -> DataFrame:
    """Write every extract below ``folder``; returns name and rows written.

    Extracts are replaced as a whole, those in ``by_day`` from a day on.
    Rows are counted while they are written, not in a second pass. Many
    collections belong in one extract with a ``collection`` column to
    partition by, not in one extract each.
    """
    partition_by, by_day = partition_by or {}, by_day or {}
    counts = []
    for name, extract in extracts.items():
        if name in by_day:
            d = by_day[name]
            rows = write_days(extract(), os.path.join(folder, name), d.column, d.first, d.key, d.buckets)
            counts.append((name, rows))
            continue
        seen = Observation()
        counted = extract().observe(seen, F.count(F.lit(1)).alias("row_count"))
        write_table(counted, os.path.join(folder, name), partition_by.get(name))
        counts.append((name, int(seen.get["row_count"])))
    return spark.createDataFrame(counts, "table_name string, row_count bigint")
