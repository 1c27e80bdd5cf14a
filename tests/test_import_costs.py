"""The import table: sheets are built once, and first items are told by numbers."""

import pytest
from pyspark.sql import functions as F

from storelens.catalog import CATALOG
from storelens.operators.ordering import carry_forward
from storelens.plans import order_sheets as o
from tests.conftest import SMALL
from tests.test_plans import plan_of

ITEMS = "file string, start_row bigint, row_no bigint, pass_no int, size_pos int"


def first(spark, rows):
    return sorted(map(tuple, o.first_items(spark.createDataFrame(rows, ITEMS)).select(*ITEMS.split()[::2]).collect()))


@pytest.mark.parametrize("start", [0, -50, 1 << 40, (1 << 62) + 5])
def test_first_items_of_small_and_large_numbers(spark, start):
    rows = [("f", start, start + row, turn, size) for row in (3, 1, 2) for turn in (1, 0) for size in (7, 2, 0)]
    rows += [("g", start, start + 9, 2, 4), ("g", start, start + 9, 2, 4), ("f", None, start, 0, 0), (None, 1, 1, 0, 0)]
    assert first(spark, rows) == [("f", start, start + 1, 0, 0), ("g", start, start + 9, 2, 4)]


def test_first_items_without_numbers_or_items(spark):
    assert first(spark, []) == []
    assert first(spark, [("f", 1, None, 0, 0)]) == []
    assert first(spark, [("f", 1, None, 0, 0), ("f", 1, 2, 0, 1)]) == [("f", 1, 2, 0, 1)]


def test_first_items_sort_and_meet_nothing(spark):
    plan = plan_of(o.first_items(spark.createDataFrame([("f", 1, 1, 0, 0)], ITEMS)))
    assert "Join" not in plan and "SortAggregate" not in plan


def test_rows_are_carried_from_what_is_stored(spark):
    plan = plan_of(CATALOG.queries["order_groups"].run(spark, SMALL))
    assert "l_orderkey" not in plan and "Window" not in plan


def test_rows_without_group_or_number_are_left_out(spark):
    rows = [("f", 1, True), ("f", 2, False), (None, 3, True), ("f", None, True), ("f", 200_000, False)]
    df = spark.createDataFrame(rows, "file string, row_no bigint, start boolean")
    found = carry_forward(df, ["file"], "row_no", F.col("start"), "start_row")
    assert sorted(tuple(r) for r in found.select("row_no", "start_row").collect()) == [(1, 1), (2, 1), (200_000, 1)]
