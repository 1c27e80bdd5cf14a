"""What the physical plans must not contain."""

import re

import pytest

from storelens.catalog import CATALOG
from tests.conftest import SMALL

# Operators that run Python per row, pair everything with everything, or join without keys.
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Reports that number their last few rows.
RANKED_AFTER_LIMIT = {"top_sellers", "badge_distribution"}


@pytest.mark.parametrize("name", list(CATALOG.queries))
def test_plan(spark, name):
    plan = plan_of(CATALOG.queries[name].run(spark, SMALL))
    assert not [word for word in FORBIDDEN if word in plan]
    # a window without partition may only number the rows a limit left
    first_terms = re.findall(r"windowspecdefinition\(([^,]+),", plan)
    whole = [t for t in first_terms if re.search(r" (ASC|DESC)|specifiedwindowframe", t)]
    assert not whole or (name in RANKED_AFTER_LIMIT and "TakeOrderedAndProject" in plan)


def test_ranked_groups_are_cut_before_the_shuffle(spark):
    plan = plan_of(CATALOG.queries["collection_top50"].run(spark, SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(CATALOG.queries["variant_window_sales"].run(spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert schemas
    for schema in schemas:
        assert "l_tax" not in schema and "l_comment" not in schema and "o_totalprice" not in schema


# Exchanges of a query's initial plan, at most; a change that adds one has to say so.
EXCHANGES = {
    "variant_window_sales": 5,
    "stock_window": 1,
    "top_sellers": 4,
    "segment_purchase_stats": 14,
    "order_items_enriched": 9,
    "category_share": 3,
}


@pytest.mark.parametrize("name", list(EXCHANGES))
def test_tables_are_moved_no_more_often_than_needed(spark, name):
    plan = plan_of(CATALOG.queries[name].run(spark, SMALL))
    moved = re.findall(r"(?<!Reused)Exchange (?:hash|range|RoundRobin)\w*", plan)
    assert len(moved) <= EXCHANGES[name], moved
