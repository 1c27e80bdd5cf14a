"""Purchase statistics against nested loops, bitmaps against sets, what is moved."""

import random
import re

import pytest
from pyspark.sql import functions as F

from storelens.operators.bitmaps import bitmap_sets, number_ids, set_sizes
from storelens.operators.joins import collapse, weighted_join
from storelens.plans import segments as s
from tests.test_plans import plan_of


def by_hand(members, owners, orders, match):
    meets = lambda a, b: a == b and (match or a is not None)
    out = {}
    for profile, segment in members:
        if segment is None:
            continue
        people, sold, total = out.setdefault(segment, (set(), set(), []))
        if profile is not None:
            people.add(profile)
        for customer in [c for p, c in owners if meets(p, profile)] or [None]:
            for order, buyer, price in orders:
                if meets(buyer, customer):
                    total.append(price or 0.0)
                    if order is not None:
                        sold.add(order)
    return {k: (len(p), len(o), round(sum(t), 6)) for k, (p, o, t) in out.items()}


def drawn(seed):
    rng = random.Random(seed)
    some = lambda prefix, n, nulls: rng.choice([*[f"{prefix}{i}" for i in range(n)], *[None] * nulls])
    members = [(some("p", 12, 2), some("s", 4, 1)) for _ in range(40)]
    owners = [(some("p", 12, 4), some("c", 10, 2)) for _ in range(14)]
    orders = [(some("o", 25, 2), some("c", 10, 3), float(rng.randrange(50))) for _ in range(60)]
    return members, owners, orders


@pytest.mark.parametrize("rule", ["sql", "match"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_nested_loops(spark, rule, seed):
    members, owners, orders = drawn(seed)
    frames = (
        spark.createDataFrame(members, "profile_id string, segment_id string"),
        spark.createDataFrame(owners, "profile_id string, customer_id string"),
        spark.createDataFrame(orders, "order_id string, customer_id string, current_total_price double"),
    )
    rows = s.segment_purchase_stats(*frames, null_keys=rule).collect()
    found = {r["segment_id"]: (r["total_customers"], r["total_orders"], r["total_order_revenue"]) for r in rows}
    assert found == by_hand(members, owners, orders, rule == "match")


def test_empty_tables(spark):
    frames = (
        spark.createDataFrame([("p", "s")], "profile_id string, segment_id string"),
        spark.createDataFrame([], "profile_id string, customer_id string"),
        spark.createDataFrame([], "order_id string, customer_id string, current_total_price double"),
    )
    for rule in ("sql", "match"):
        assert s.segment_purchase_stats(*frames, null_keys=rule).collect() == [("s", 1, 0, 0.0, 0.0)]
        assert s.segment_purchase_stats(frames[0].limit(0), *frames[1:], null_keys=rule).collect() == []


def test_sets_across_many_bitmaps(spark):
    ids = spark.range(100_000).select(F.col("id").cast("string").alias("id"))
    numbers = number_ids(ids, "id", F.col("id").cast("long") % 97, "numbers-test")
    assert numbers.select("n").distinct().count() == 100_000
    groups = {"thirds": 3, "all": 1, "few": 20_011}
    rows = [numbers.filter(F.col("id").cast("long") % m == 0).withColumn("g", F.lit(g)) for g, m in groups.items()]
    rows = rows[0].union(rows[1]).union(rows[2]).union(rows[0])
    sizes = set_sizes(bitmap_sets(rows, ["g"]), ["g"], "size").collect()
    assert {r["g"]: r["size"] for r in sizes} == {g: -(-100_000 // m) for g, m in groups.items()}


def test_no_row_of_a_segment_and_an_order_is_moved(spark, tables):
    customers = s.customer_profiles(tables.shopify_customers, tables.profiles)
    plan = plan_of(s.segment_purchase_stats(tables.segment_membership, customers, tables.s_orders))
    moved = re.findall(r"hashpartitioning\(([^\[]*?), \d+\)", plan)
    assert moved and not any("segment_id" in m and "order_id" in m for m in moved)
    # bits are set before the exchange, by segment and bucket
    assert re.search(r"partial_bitmap_construct_agg", plan)
    for m in moved:
        if "bucket" in m:
            assert re.fullmatch(r"segment_id#\d+, bucket#\d+L", m)


def test_weighted_join_counts_what_pairs_would(spark):
    left = [(None, "a")] * 30 + [("x", "a"), ("x", "b"), ("y", "b")]
    right = [(None,)] * 50 + [("x",)] * 3
    one = spark.createDataFrame(left, "k string, g string")
    two = spark.createDataFrame(right, "k string")
    for rule, expected in (("sql", {"a": 33, "b": 4}), ("match", {"a": 1503, "b": 4})):
        joined = weighted_join(collapse(one, ["k", "g"]), collapse(two, ["k"]), "k", rule)
        assert joined.count() == 4
        sums = joined.groupBy("g").agg(F.sum("weight").alias("n")).collect()
        assert {r["g"]: r["n"] for r in sums} == expected
    with pytest.raises(ValueError, match="null_keys"):
        weighted_join(one, two, "k", "other")
