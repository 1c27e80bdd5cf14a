"""Rules of the merchandising, marketing and maintenance chains."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from storelens.functions.ratios import NEVER_SELLS_OUT
from storelens.plans import dashboard as d
from storelens.plans import maintenance as w
from storelens.plans import merchandising as m
from storelens.plans import segments as s

NOW = datetime(2025, 3, 1, 12)


def test_window_sales_with_hot_and_repeated_keys(spark):
    """A third of all lines in one order, lines without order, an order listed twice."""
    rng = random.Random(5)
    orders = [(f"o{i}", NOW - timedelta(days=rng.uniform(0, 45))) for i in range(60)]
    orders += [(None, NOW - timedelta(days=1)), ("o3", NOW - timedelta(days=2)), ("o9", None)]
    lines = []
    for i in range(900):
        order = "o3" if i % 3 == 0 else rng.choice(orders)[0]
        quantity = None if rng.random() < 0.05 else rng.randint(-1, 5)
        lines.append((order, f"v{rng.randint(0, 9)}", quantity, rng.randint(100, 900) / 4))
    found = m.variant_window_sales(
        spark.createDataFrame(lines, "order_id string, variant_id string, quantity int, variant_price double"),
        spark.createDataFrame(orders, "order_id string, created_at timestamp_ntz"),
        NOW,
    ).collect()
    joined = pd.DataFrame(lines, columns=["order_id", "variant_id", "q", "p"]).merge(
        pd.DataFrame(orders, columns=["order_id", "created_at"]), on="order_id", how="left"
    )
    for row in found:
        for days in m.WINDOWS:
            part = joined[
                (joined["created_at"] >= NOW - timedelta(days=days))
                & (joined["variant_id"] == row["variant_id"])
            ]
            assert row[f"units_sold_{days}d"] == part["q"].sum()
            assert row[f"revenue_{days}d"] == pytest.approx((part["p"] * part["q"]).sum())
            assert row[f"order_count_{days}d"] == part["order_id"].nunique()
    assert len(found) == 10


def test_listing_first_category_skips_null_and_low_stock_goes(spark):
    base = {f"{k}_{d}d": 0 for d in m.WINDOWS for k in ("units_sold", "order_count", "days_in_stock")}
    base |= {f"revenue_{d}d": 0.0 for d in m.WINDOWS}
    rows = [
        {"variant_id": "1", "product_id": "p", "sku": None, "category_group": None, "current_qty": 3.0},
        {"variant_id": "2", "product_id": "p", "sku": "b", "category_group": "B", "current_qty": 2.0},
        {"variant_id": "3", "product_id": "p", "sku": "c", "category_group": "C", "current_qty": 0.0},
        {"variant_id": "4", "product_id": "q", "sku": "d", "category_group": "D", "current_qty": 4.9},
        {"variant_id": "5", "product_id": None, "sku": "e", "category_group": "E", "current_qty": 9.0},
    ]
    prices = {k: 10.0 for k in ("price", "compare_at_price", "markdown_pct", "unit_cost", "margin_pct")}
    variants = spark.createDataFrame(pd.DataFrame([{**r, **prices, **base} for r in rows]))
    listings = spark.createDataFrame(
        [("p", "t", "x", NOW)], "product_id string, title string, product_type string, published_at timestamp_ntz"
    )
    found = m.listing_sales(variants, listings).collect()
    assert [(r["product_id"], r["category_group"], r["variant_count"], r["weeks_of_sale"]) for r in found] == [
        ("p", "B", 2, NEVER_SELLS_OUT)
    ]
    assert found[0].asDict()["title"] == "t"


def collection(spark, sizes):
    rng = random.Random(2)
    rows = [
        (name, pos, f"{name}{pos}", rng.choice([None, 1.0, 2.0, 5.0]), rng.choice([None, f"{pos}"]))
        for name, n in sizes.items()
        for pos in range(1, n + 1)
    ]
    df = spark.createDataFrame(
        rows, "collection string, position bigint, name string, revenue_30d double, product_id string"
    )
    return df, rows


def test_rest_is_what_is_not_shown(spark):
    df, rows = collection(spark, {"small": 3, "equal": 5, "large": 23})
    rest = m.collection_rest(df, 5).collect()
    assert sorted((r["collection"], r["position"]) for r in rest) == [
        ("large", p) for p in range(6, 24)
    ]


def test_rest_with_positions_shared_by_several_products(spark):
    rows = [("c", 1, "a", 1.0, p) for p in ("x", None, "y")] + [("c", 2, "b", 1.0, "z"), ("c", None, "b", 1.0, "w")]
    df = spark.createDataFrame(
        rows, "collection string, position bigint, name string, revenue_30d double, product_id string"
    )
    for n in range(1, 5):
        top = [(r["position"], r["product_id"]) for r in m.collection_top(df, n).collect()]
        rest = [(r["position"], r["product_id"]) for r in m.collection_rest(df, n).collect()]
        assert len(top) == n and sorted(map(str, top + rest)) == sorted(str((r[1], r[4])) for r in rows)


def test_three_pass_fill(spark):
    customers = spark.createDataFrame(
        [("A", "NY", None), ("B", "NY", None), ("C", "Texas", "p")],
        "customer_id string, default_address_province string, profile_id string",
    )
    saturday = datetime(2025, 3, 1, 8)
    orders = spark.createDataFrame(
        [("A", saturday), (None, saturday), ("B", None)], "customer_id string, created_at timestamp_ntz"
    )
    rows = s.customer_features(customers, s.order_features(orders)).collect()
    assert {r["customer_id"]: (r["tz_cohort"], r["holiday_send_hour"], r["workday_send_hour"]) for r in rows} == {
        "A": ("eastern", 8, 8), "B": ("eastern", 8, 8), "C": (None, 8, 8),
    }


def test_purchase_stats_both_ways_and_guest_orders(spark, tables):
    customers = s.customer_profiles(tables.shopify_customers, tables.profiles)
    args = (tables.segment_membership, customers, tables.s_orders)
    one = s.segment_purchase_stats(*args).orderBy("segment_id").collect()
    two = s.segment_purchase_stats(*args, order_has_one_customer=False).orderBy("segment_id").collect()
    assert [r["total_orders"] for r in one] == [r["total_orders"] for r in two]

    members = spark.createDataFrame([("p1", "s"), ("p2", "s"), ("p3", "s")], "profile_id string, segment_id string")
    people = spark.createDataFrame([("p1", "c1"), (None, "c9")], "profile_id string, customer_id string")
    orders = spark.createDataFrame(
        [("o1", "c1", 10.0), ("g1", None, 5.0), ("g2", None, 7.0)],
        "order_id string, customer_id string, current_total_price double",
    )
    found = lambda rule: s.segment_purchase_stats(members, people, orders, null_keys=rule).collect()[0]
    # a missing customer meets nothing, or both members without one meet both guest orders
    for rule, expected in (("sql", (3, 1, 10.0)), ("match", (3, 3, 34.0))):
        row = found(rule)
        assert (row["total_customers"], row["total_orders"], row["total_order_revenue"]) == expected


def test_event_segment(spark):
    start, end = datetime(2024, 11, 24), datetime(2024, 12, 2)
    orders = spark.createDataFrame(
        [("in", datetime(2024, 11, 25)), ("in", end), ("late", datetime(2024, 12, 2, 10)),
         ("mixed", datetime(2024, 11, 25)), ("mixed", datetime(2024, 1, 1)), ("anon", start), (None, start)],
        "customer_id string, created_at timestamp_ntz",
    )
    customers = spark.createDataFrame(
        [(c, None if c == "anon" else "p") for c in ("in", "late", "mixed", "anon")],
        "customer_id string, profile_id string",
    )
    rows = s.event_only_segment(orders, customers, start, end).collect()
    assert [tuple(r) for r in rows] == [("in", datetime(2024, 11, 25))]


def test_dashboard_parameters(spark, tables):
    with pytest.raises(ValueError, match="sort"):
        d.campaign_list(tables.campaigns, sort_by="1; drop table x")
    one = d.campaign_list(tables.campaigns, list_name="click", limit=3).collect()
    assert len(one) == 3 and {r["list"] for r in one} == {"click"}
    up = d.campaign_list(tables.campaigns, sort_by="spam_complaints_rate", descending=False, limit=1000)
    rates = [r["spam_complaints_rate"] for r in up.collect()]
    known = [r for r in rates if r is not None]
    assert rates == sorted(known) + [None] * (len(rates) - len(known))


def test_stale_badges(spark):
    columns = "product_id string, status string, badge string, published_at timestamp_ntz"
    rows = [
        ("old", "ACTIVE", "New", NOW - timedelta(days=61, hours=20)), ("edge", "ACTIVE", "New", NOW - timedelta(days=60)),
        ("draft", "DRAFT", "New", NOW - timedelta(days=90)), ("none", "ACTIVE", "New", None),
        ("other", "ACTIVE", "Sale", NOW - timedelta(days=90)),
    ]
    found = w.stale_new_badges(spark.createDataFrame(rows, columns), NOW)
    assert [(r["product_id"], r["days_since_published"]) for r in found.collect()] == [("old", 61)]
    plan = w.badge_clear_plan(found)
    assert plan.collect()[0].asDict(recursive=True) == {
        "product_gid": "gid://shopify/Product/old", "operation": "clear_badge",
        "payload": {"namespace": "custom", "key": "badge"}, "dry_run": True,
    }


def test_plans_apply(spark):
    listings = spark.createDataFrame([("1", "New"), ("2", None)], "product_id string, badge string")
    ids = spark.createDataFrame([("1",), (" gid://shopify/Product/2",), ("9",), (None,)], "product_id string")
    dry = w.badge_set_plan(ids, "Sale")
    live = w.badge_set_plan(ids, "Sale", dry_run=False)
    clear = w.badge_clear_plan(ids, dry_run=False)
    result = lambda plan: {r["product_id"]: (r["badge"], r["changed"]) for r in w.badge_applied(listings, plan).collect()}
    assert result(dry) == {"1": ("New", False), "2": (None, False)}
    assert result(live) == {"1": ("Sale", True), "2": ("Sale", True)}
    assert result(clear) == {"1": (None, True), "2": (None, True)}
    summary = lambda plan: {r["status"]: r["change_count"] for r in w.change_summary(w.change_results(plan, listings)).collect()}
    assert summary(dry) == {"success": 4}
    assert summary(live) == {"success": 2, "failed": 2}

    tags = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a")], "product_id string, tag string")
    one = spark.createDataFrame([("1",)], "product_id string")
    added = w.tags_added(tags, w.tag_plan(one, ["a", "c"], add=True)).collect()
    removed = w.tags_removed(tags, w.tag_plan(one, "a", add=False)).collect()
    gid = "gid://shopify/Product/"
    assert sorted(tuple(r) for r in added) == [(gid + "1", "a"), (gid + "1", "b"), (gid + "1", "c"), (gid + "2", "a")]
    assert sorted(tuple(r) for r in removed) == [(gid + "1", "b"), (gid + "2", "a")]


def test_invariants(tables):
    from storelens.catalog import merchandising as c

    variants = c.variant_sales(tables).cache()
    rolled = m.listing_rollup(variants)
    assert rolled.agg(F.sum("units_sold_30d")).first() == variants.agg(F.sum("units_sold_30d")).first()
    listings = c.listing_sales(tables)
    shares = m.category_share(listings).agg(F.sum("pct_revenue")).first()[0]
    assert shares == pytest.approx(100)
    groups = m.type_share(listings).groupBy("category_group").agg(F.sum("pct_of_group")).collect()
    assert all(r[1] == pytest.approx(100) for r in groups)
    assert variants.filter("rate_of_sale_30d < 0 or isnan(rate_of_sale_30d)").count() == 0
    variants.unpersist()
