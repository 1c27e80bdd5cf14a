"""Order-dependent operators without one task per hot group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.session import stage

# Row numbers covered by one chunk of a carried-forward scan.
CHUNK_ROWS = 65_536


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``.

    An aggregate, not a window: copies of a key collapse before the shuffle.
    Order expressions must be ascending sort keys; nulls come first.
    """
    names = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*names), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias(
            "row"
        )
    )
    return best.select(*[F.col(c) if c in keys else F.col(f"row.`{c}`") for c in df.columns])


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank_no"
) -> DataFrame:
    """First ``n`` rows of each group by ``order``.

    The rank filter lets Spark cut every group to ``n`` rows on the map side.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def carry_forward(
    df: DataFrame,
    group: Sequence[str],
    row_no: str,
    starts: Column,
    name: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Give every row the number of the last starting row at or before it.

    A group may be one huge file, so the scan has two levels: the last start
    of each chunk of row numbers is carried across the chunks of a group
    (one number per chunk), then rows look back inside their own chunk.
    Row numbers grow, so the last start is the largest one. Rows whose group or
    number is null are left out.

    Rows are stored with what their own chunk says, so that ``df`` is read once
    and the chunks are a look at one column; a chunk with nothing to carry, such
    as the first of every group, has no row to join.
    """
    started = F.when(starts, F.col(row_no))
    chunked = df.withColumn("__chunk", F.shiftright(F.col(row_no).cast("bigint"), chunk_rows.bit_length() - 1))
    # numbers first: the names of a group begin alike and are slow to sort
    chunk_keys = ["__chunk", *group]
    before = Window.partitionBy(*group).orderBy("__chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    inside = Window.partitionBy(*chunk_keys).orderBy(row_no).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    keyed = chunked.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in chunk_keys]))
    scanned = stage(keyed.withColumn("__near", F.max(started).over(inside)), "carried-rows")
    carried = (
        scanned.groupBy(*chunk_keys)
        .agg(F.max("__near").alias("__last"))
        .withColumn("__carry", F.max("__last").over(before))
        .filter(F.col("__carry").isNotNull())
        .drop("__last")
    )
    return (
        scanned.join(stage(carried, "carried-chunks"), chunk_keys, "left")
        .withColumn(name, F.coalesce("__near", "__carry"))
        .drop("__chunk", "__near", "__carry")
    )


def running_position(
    df: DataFrame, group: Sequence[str], page: str, size: Column, pos: Column, name: str
) -> DataFrame:
    """1-based position across pages: page offset plus place on the page.

    ``df`` has one row per page, so the window runs over page sizes only.
    """
    before = Window.partitionBy(*group).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(size).over(before), F.lit(0))
    return df.withColumn(name, (offset + pos).cast("bigint"))


def row_numbers(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], name: str
) -> DataFrame:
    """Number the rows of a group by bucket, then by ``order``, in two levels.

    Rows are numbered inside their (group, bucket) and moved by the size of
    the buckets before it, so a group of any size is numbered by many tasks.
    """
    keys = [*group, bucket]
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__size"))
        .select(*keys, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df.withColumn("__inside", inside)
        .join(offsets, keys)
        .withColumn(name, F.col("__before") + F.col("__inside"))
        .drop("__before", "__inside")
    )


def average_rank(
    value: Column, group: Sequence[str | Column], of: Column | None = None
) -> Column:
    """Percentile rank with averaged ties; nulls rank last and count.

    ``of`` splits off rows that are ranked among themselves. Meant for groups
    of known small size (the first rows of a ranking).
    """
    part = [*group] + ([of] if of is not None else [])
    ordered = Window.partitionBy(*part).orderBy(value.asc_nulls_last())
    ties = Window.partitionBy(*part, value)
    whole = Window.partitionBy(*part)
    n = F.count(F.lit(1))
    return (F.rank().over(ordered) + (n.over(ties) - 1) / F.lit(2.0)) / n.over(whole)


def range_rank(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Percentile rank with averaged ties, nulls last and counted, as ``average_rank``
    has it, for groups of any size."""
    return join_ranks(df, value_ranks(df, group, value, name), [*group, value])


def value_ranks(
    df: DataFrame, group: Sequence[str], value: str, name: str, weight: str | None = None
) -> DataFrame:
    """What ``range_rank`` gives the rows of a group, one row per group and value.

    Rows are counted per value first; one with a ``weight`` counts as that many. The
    values are dealt to ranges, so that a group is ranked by as many tasks as it has
    ranges: inside a range by adding up counts, across ranges by the size of those
    before, one row a range and group.
    """
    keys = [*group, value]
    counts = df.groupBy(*keys).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__n"))
    dealt = counts.repartitionByRange(*group, F.col(value).asc_nulls_last())
    # which range a value is in must not change any more
    placed = stage(dealt.withColumn("__part", F.spark_partition_id()), "ranked-values")
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(*group, "__part").agg(F.sum("__n").alias("__size"))
    parts = parts.withColumns(
        {
            "__before": F.coalesce(F.sum("__size").over(earlier), F.lit(0)),
            "__total": F.sum("__size").over(Window.partitionBy(*group)),
        }
    ).drop("__size")
    part_keys = [*group, "__part"]
    inside = (
        Window.partitionBy(*part_keys)
        .orderBy(F.col(value).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    smaller = F.coalesce(F.sum("__n").over(inside), F.lit(0))
    ranked = join_ranks(placed.withColumn("__smaller", smaller), parts, part_keys)
    rank = (F.col("__before") + F.col("__smaller") + 1 + (F.col("__n") - 1) / F.lit(2.0)) / F.col("__total")
    return ranked.select(*keys, rank.alias(name))


def join_ranks(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on keys of which the right side has each once; null is a key like others."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = [left[k].eqNullSafe(right[f"__r_{k}"]) for k in keys]
    return left.join(right, reduce(Column.__and__, same)).drop(*[f"__r_{k}" for k in keys])


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of the whole table."""
    return df.orderBy(*order).limit(n)
