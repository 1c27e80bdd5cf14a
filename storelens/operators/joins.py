"""Joins that state what null keys do, key checks and match statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Null keys on the left are spread over this many tasks; the (few) null-key
# rows on the right are repeated as often.
NULL_SALTS = 16
SALT = "__salt"

# Tasks the rows of one key are spread over in a join with few rows per key.
SPREAD_SALTS = 64

Keys = str | Sequence[str]


def _names(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def salt_nulls(left: DataFrame, on: Keys, null_salts: int = NULL_SALTS) -> DataFrame:
    """Add the salt column of rows with a null key.

    Done once before several joins on the same key, the rows keep their
    partitioning from one join to the next; the caller drops ``__salt``.
    """
    any_null = reduce(Column.__or__, [F.col(name).isNull() for name in _names(on)])
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    salt = F.when(any_null, F.pmod(row_hash, F.lit(null_salts)).cast("int")).otherwise(0)
    return left.withColumn(SALT, salt)


def join_tables(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    how: str = "left",
    right_on: Keys | None = None,
    null_keys: str = "sql",
    null_salts: int = NULL_SALTS,
    prune_right_nulls: bool = False,
) -> DataFrame:
    """Equi join that keeps the left key columns and drops the right ones.

    A null key meets nothing (``null_keys="sql"``), so the join is a plain
    equality that later steps can reuse the partitioning of.
    ``null_keys="match"`` lets a null key on one side meet a null key on the
    other, which makes as many pairs as both sides have such rows: count them
    first (``null_pairs``). Both are hash joins. Because all null keys
    share one hash value they are salted: a left row with a null key goes to
    the task its content picks, and right rows with a null key exist once per
    salt, so every pair still meets exactly once. The salt is computed from
    the row, hence the same after a task is run again.

    ``prune_right_nulls`` first looks whether the left table has a null key at
    all and otherwise leaves the right null rows out. Worth it when most right
    keys are null and the left side is a stored table, where the look is a
    pushed-down scan of one column.
    """
    left_on = _names(on)
    right_on = _names(right_on) if right_on is not None else left_on
    right_names = {name: f"__r_{name}" for name in right_on}
    right = right.withColumnsRenamed(right_names)
    pairs = list(zip(left_on, right_names.values()))
    drop = list(right_names.values())

    if null_keys == "sql":
        condition = [left[a] == right[b] for a, b in pairs]
        return left.join(right, reduce(Column.__and__, condition), how).drop(*drop)
    if null_keys != "match":
        raise ValueError(f"null_keys must be 'match' or 'sql', not {null_keys!r}")

    if SALT not in left.columns:
        left = salt_nulls(left, left_on, null_salts)
        drop.append(SALT)
    any_null = reduce(Column.__or__, [F.col(b).isNull() for _, b in pairs])
    if prune_right_nulls:
        left_null = reduce(Column.__or__, [F.col(a).isNull() for a, _ in pairs])
        needed = left.filter(left_null).limit(1).select(F.lit(True)).scalar()
        right = right.filter(~any_null | F.coalesce(needed, F.lit(False)))
    every_salt = F.sequence(F.lit(0), F.lit(null_salts - 1))
    copies = F.when(any_null, every_salt).otherwise(F.array(F.lit(0)))
    right = right.withColumn("__r_salt", F.explode(copies))
    condition = [left[a].eqNullSafe(right[b]) for a, b in pairs]
    condition.append(left[SALT] == right["__r_salt"])
    return left.join(right, reduce(Column.__and__, condition), how).drop("__r_salt", *drop)


def collapse(df: DataFrame, columns: Sequence[str], weight: str = "weight") -> DataFrame:
    """Equal rows of the named columns as one row with their number."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(weight))


def weighted_join(
    left: DataFrame, right: DataFrame, on: str, null_keys: str = "sql", weight: str = "weight"
) -> DataFrame:
    """Left join of collapsed tables; a row stands for as many pairs as its weight,
    the product of both weights, by which sums and counts are multiplied.

    With ``null_keys="match"`` null keys meet null keys. The plain join would make
    a pair of every row with a null key on one side and every such row on the other;
    here each side has one row for all of them that are equal, one in all where the
    key is the only column besides sums.
    """
    if null_keys not in ("match", "sql"):
        raise ValueError(f"null_keys must be 'match' or 'sql', not {null_keys!r}")
    right = right.withColumnsRenamed({on: "__key", weight: "__times"})
    key, other = F.col(on), F.col("__key")
    condition = key.eqNullSafe(other) if null_keys == "match" else key == other
    joined = left.join(right, condition, "left").drop("__key")
    return joined.withColumn(weight, F.col(weight) * F.coalesce("__times", F.lit(1))).drop("__times")


def null_pairs(left: DataFrame, right: DataFrame, on: Keys, right_on: Keys | None = None) -> int:
    """How many pairs of null keys a join with ``null_keys="match"`` would make
    for keys of one column."""
    (a,), (b,) = _names(on), _names(right_on if right_on is not None else on)
    return left.filter(F.col(a).isNull()).count() * right.filter(F.col(b).isNull()).count()


def spread_join(
    left: DataFrame, right: DataFrame, on: Keys, salts: int = SPREAD_SALTS
) -> DataFrame:
    """Inner join on a key of which one value may hold most left rows.

    Left rows of a key go to the task their content picks; the right side, at
    most a few rows per key, exists once per salt. What follows therefore
    starts from evenly filled tasks, whether or not Spark broadcasts.
    """
    keys = _names(on)
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    salted = left.withColumn(SALT, F.pmod(row_hash, F.lit(salts)).cast("int"))
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = right.withColumn(SALT, F.explode(every_salt))
    return salted.join(copies, [*keys, SALT]).drop(SALT)


def duplicate_keys(df: DataFrame, keys: Keys) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    names = _names(keys)
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def duplicate_rows(df: DataFrame, keys: Keys) -> DataFrame:
    """All rows of keys that occur more than once, ordered by key."""
    names = _names(keys)
    renamed = {n: f"__r_{n}" for n in names}
    repeated = duplicate_keys(df, names).drop("row_count").withColumnsRenamed(renamed)
    condition = [df[n].eqNullSafe(repeated[r]) for n, r in renamed.items()]
    return df.join(repeated, reduce(Column.__and__, condition), "left_semi").orderBy(*names)


def assert_unique(df: DataFrame, keys: Keys, what: str = "table") -> DataFrame:
    """Fail when a key repeats; returns the frame so that it can be chained."""
    found = duplicate_keys(df, keys).limit(5).collect()
    if found:
        raise ValueError(f"{what}: duplicate keys {_names(keys)}, for example {found}")
    return df


def match_stats(df: DataFrame, matched: Column, name: str, by: Sequence[str] = ()) -> DataFrame:
    """One row (per group) with the matched and total row counts and the rate."""
    counts = df.groupBy(*by).agg(
        F.count_if(matched).alias("matched"), F.count(F.lit(1)).alias("total")
    )
    return counts.select(
        F.lit(name).alias("check_name"),
        *by,
        "matched",
        "total",
        F.coalesce(F.try_divide(F.col("matched") * 100.0, F.col("total")), F.lit(0.0)).alias(
            "match_pct"
        ),
    )


def keys_in_both(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both tables."""
    return left.select(key).intersect(right.select(key))


def keys_only_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the left table that the right one lacks."""
    return left.select(key).subtract(right.select(key))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, null included."""
    return df.groupBy(F.col(column)).agg(F.count(F.lit(1)).alias("row_count"))
