"""Collections in which many rows and many listings share a title."""

import random

import pytest

from storelens.catalog import CATALOG
from storelens.plans import merchandising as m
from tests.conftest import SMALL
from tests.test_plans import plan_of

LISTING = """title string, product_id string, units_sold_30d bigint, revenue_30d double, rate_of_sale_30d double,
    rate_of_sale_7d double, markdown_pct double, margin_pct double, weeks_of_sale double, published_at timestamp_ntz"""


@pytest.fixture(scope="module")
def shared(spark):
    rng = random.Random(5)
    # "many" has a title for most rows, "null" ends in rows without a position
    rows = [
        (c, None if c == "nulls" and p > 5 else p, rng.choice(["a", "a", "a", "b", "c", None]))
        for c, n in (("many", 60), ("nulls", 9), ("small", 2), (None, 4))
        for p in range(1, n + 1)
    ]
    collections = spark.createDataFrame(rows, "collection string, position bigint, name string")

    def number():
        return rng.choice([None, -1.0, 0.0, 1.0, 2.0004, 2.0, 5.0])

    listings = [
        (t, f"p{i}", i % 7, *[number() for _ in range(6)], None)
        for i, t in enumerate(["a"] * 40 + ["b"] * 3 + [None] * 4 + ["d"])
    ]
    return collections, spark.createDataFrame(listings, LISTING)


def texts(df, *columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("n", (1, 4, 50))
def test_candidates_have_the_first_and_the_buried_rows(shared, n):
    collections, listings = shared
    metrics = m.collection_metrics(collections, listings)
    found = m.collection_candidates(collections, listings, n, 3)
    first = ("collection", "position", "revenue_30d", "product_id", "row_no")
    for some in (found, m.collection_candidates(collections, listings, n, 0)):
        assert texts(m.collection_top(some, n), *first) == texts(m.collection_top(metrics, n), *first)
    buried = ("collection", "position", "revenue_30d", "product_id", "buried_no")
    assert texts(m.collection_buried(found, n, 3), *buried) == texts(m.collection_buried(metrics, n, 3), *buried)
    header = m.collection_report_header(found, n, 3, m.collection_sizes(collections, listings))
    assert texts(header, *header.columns) == texts(m.collection_report_header(metrics, n, 3), *header.columns)


def test_candidates_do_not_grow_with_the_pairs_of_a_title(shared):
    collections, listings = shared
    listings = listings.filter("title is not null")
    assert m.collection_metrics(collections, listings).count() > 1000
    assert m.collection_candidates(collections, listings, 1, 3).count() < 250


def test_ranks_among_all_pairs(shared):
    collections, listings = shared
    whole = m.collection_percentile_rank(m.collection_metrics(collections, listings), n=None)
    columns = ["collection", "position", "name", "product_id", *[f"{s}_rank" for _, s, _ in m.RANKED]]
    ranks = m.collection_ranks(collections, listings)
    assert texts(ranks, *columns) == texts(whole, *columns)
    with pytest.raises(ValueError):
        m.collection_percentile_rank(whole, 50, weight="position")


def test_positions_meet_the_ranks_last(spark):
    plan = plan_of(CATALOG.queries["collection_percentile_rank_whole"].run(spark, SMALL))
    # the join that makes a row of every pair is the last: nothing moves its rows
    assert plan.count("REPARTITION_BY_NUM") == 2
    join = min(plan.index(word) for word in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") if word in plan)
    assert "Exchange" not in plan[:join].replace("BroadcastExchange", "")
