"""Texts are read once, not again by every filter on what they say."""

from storelens.catalog import CATALOG
from tests.conftest import SMALL
from tests.test_plans import plan_of


def test_ship_dates_are_read_once_an_order(spark):
    plan = plan_of(CATALOG.queries["defaulted_ship_dates"].run(spark, SMALL))
    assert "regexp_extract" not in plan and "lineitem" not in plan
