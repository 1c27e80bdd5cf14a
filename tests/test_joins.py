"""Null keys, hot keys and key checks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from storelens.operators import joins


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, l int")
    right = spark.createDataFrame([("a", 10), (None, 20), (None, 21)], "k string, r int")
    return left, right


def test_null_keys_match_or_not(sides):
    left, right = sides
    matched = joins.join_tables(left, right, "k", null_keys="match")
    assert sorted(matched.select("l", "r").collect()) == [(1, 10), (2, 20), (2, 21)]
    assert matched.columns == ["k", "l", "r"]
    plain = joins.join_tables(left, right, "k").select("l", "r").collect()
    assert joins.null_pairs(left, right, "k") == 2
    assert Counter(plain) == Counter([(1, 10), (2, None)])
    with pytest.raises(ValueError):
        joins.join_tables(left, right, "k", null_keys="maybe")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("prune", [False, True])
def test_many_null_keys(spark, how, prune):
    """A third of the rows share the null key, another third one hot key."""
    n = 300
    left_rows = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{i}", i) for i in range(n)]
    right_rows = [(None, 1), (None, 2), ("hot", 3), ("k2", 4), ("k2", 5), ("unused", 6)]
    left = spark.createDataFrame(left_rows, "k string, l int").repartition(7)
    right = spark.createDataFrame(right_rows, "k string, r int")
    joined = joins.join_tables(left, right, "k", how=how, null_keys="match", prune_right_nulls=prune)
    expected = [
        (k, l, r) for k, l in left_rows for rk, r in right_rows if rk == k
    ]
    if how == "left":
        keys = {k for k, _ in right_rows}
        expected += [(k, l, None) for k, l in left_rows if k not in keys]
    assert Counter(tuple(r) for r in joined.collect()) == Counter(expected)


def test_right_nulls_are_left_out_when_left_has_none(spark):
    left = spark.createDataFrame([("a", 1)], "k string, l int")
    right = spark.createDataFrame([(None, 1), ("a", 2)], "k string, r int")
    assert joins.join_tables(left, right, "k", null_keys="match", prune_right_nulls=True).collect() == [("a", 1, 2)]


def test_null_rows_spread_over_salts(spark):
    df = spark.range(2000).select(F.lit(None).cast("string").alias("k"), "id")
    per_salt = joins.salt_nulls(df, "k").groupBy(joins.SALT).count().collect()
    assert len(per_salt) == joins.NULL_SALTS
    assert max(r["count"] for r in per_salt) < 2000 / joins.NULL_SALTS * 2


def test_two_column_keys(spark):
    left = spark.createDataFrame([("a", None, 1), ("a", "x", 2)], "p string, s string, l int")
    right = spark.createDataFrame([("a", None, 9), ("a", "x", 8)], "p string, s string, r int")
    rows = joins.join_tables(left, right, ["p", "s"], null_keys="match").select("l", "r").collect()
    assert sorted(rows) == [(1, 9), (2, 8)]


def test_unique_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    with pytest.raises(ValueError, match="duplicate"):
        joins.assert_unique(df, "k")
    assert joins.assert_unique(df, ["k", "v"]) is df
    assert sorted(r["v"] for r in joins.duplicate_rows(df, "k").collect()) == [1, 2, 4, 5]


def test_match_stats(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    row = joins.match_stats(df, F.col("v").isNotNull(), "x").collect()[0]
    assert row.asDict() == {"check_name": "x", "matched": 1, "total": 2, "match_pct": 50.0}
    empty = joins.match_stats(df.filter("v > 5"), F.col("v").isNotNull(), "x").collect()[0]
    assert empty["match_pct"] == 0.0


def test_value_counts_include_null(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "v string")
    assert Counter(tuple(r) for r in joins.value_counts(df, "v").collect()) == Counter(
        [("a", 1), (None, 2)]
    )


def test_spread_join(spark):
    left_rows = [("hot" if i % 3 else f"k{i}", i) for i in range(500)]
    right_rows = [("hot", 1), ("k3", 2), ("k3", 3), ("none", 4)]
    left = spark.createDataFrame(left_rows, "k string, l int")
    right = spark.createDataFrame(right_rows, "k string, r int")
    found = joins.spread_join(left, right, "k")
    assert found.columns == ["k", "l", "r"]
    assert Counter(tuple(r) for r in found.collect()) == Counter(
        (k, l, r) for k, l in left_rows for rk, r in right_rows if rk == k
    )
