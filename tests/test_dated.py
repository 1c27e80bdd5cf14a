"""Tables by day and by order: what a run replaces, what a scan reads, what moves."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from storelens.catalog.views import AS_OF
from storelens.plans import jobs, merchandising
from storelens.sources import dated
from storelens.sources.extract import ByDay, run_extracts
from tests.test_plans import plan_of

SCHEMA = "id int, made timestamp_ntz, key string"


def rows_of(df):
    return sorted((r["id"], r["made"].day, r["key"]) for r in df.collect())


def make(spark, rows):
    return spark.createDataFrame([(i, datetime(2024, 3, d, 5 * (i % 4)), k) for i, d, k in rows], SCHEMA)


@pytest.mark.parametrize("key,buckets", [(None, 0), ("key", 3)])
def test_a_run_replaces_the_days_it_covers(spark, tmp_path, key, buckets):
    path = str(tmp_path / "t")
    first = [(1, 1, "a"), (2, 2, "b"), (3, 2, None), (4, 3, "c"), (5, 4, "d")]
    assert dated.write_days(make(spark, first), path, "made", date(2024, 3, 1), key, buckets) == 5
    assert rows_of(dated.open_days(spark, path)) == sorted(first)
    # day 2 changes, day 3 has nothing any more, day 5 is new, day 1 is not covered
    second = [(9, 1, "late"), (6, 2, "x"), (5, 4, "d"), (7, 5, None)]
    assert dated.write_days(make(spark, second), path, "made", date(2024, 3, 2), key, buckets) == 3
    kept = [(1, 1, "a"), (5, 4, "d"), (6, 2, "x"), (7, 5, None)]
    assert rows_of(dated.open_days(spark, path)) == kept
    # a session that knows nothing of the table, and a run without rows
    spark.sql(f"drop table {dated._name(path)}")
    assert rows_of(dated.open_days(spark.newSession(), path)) == kept
    assert dated.write_days(make(spark, []), path, "made", date(2024, 3, 4), key, buckets) == 0
    assert rows_of(dated.open_days(spark, path)) == kept[:1] + kept[2:3]
    assert dated.write_days(make(spark, []), path, "made", None, key, buckets) == 0
    empty = dated.open_days(spark, path)
    assert empty.columns == ["id", "made", "key", "made_day"] and empty.count() == 0


def test_layout_is_fixed(spark, tmp_path):
    path = str(tmp_path / "t")
    dated.write_days(make(spark, []), path, "made", key="key", buckets=3)
    assert dated.open_days(spark, path).count() == 0
    with pytest.raises(ValueError, match="stored as"):
        dated.write_days(make(spark, []), path, "made", key="key", buckets=4)
    assert dated.read_layout(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        dated.open_days(spark, str(tmp_path / "none"))


def test_rows_without_a_moment_are_left_out(spark, tmp_path):
    path = str(tmp_path / "t")
    df = make(spark, [(1, 1, "a")]).union(spark.createDataFrame([(2, None, "b")], SCHEMA))
    assert dated.write_days(df, path, "made") == 1


def test_filters_by_day_and_moment(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(h, datetime(2024, 3, 2, h), "k") for h in range(24)], SCHEMA)
    dated.write_days(df, path, "made")
    stored = dated.open_days(spark, path)
    assert dated.since_day(stored, "made", datetime(2024, 3, 2, 20)).count() == 4
    assert dated.since_day(df, "made", datetime(2024, 3, 2, 20)).count() == 4
    only_day = stored.drop("made")
    assert dated.since_day(only_day, "made", datetime(2024, 3, 2)).count() == 24
    with pytest.raises(ValueError, match="within a day"):
        dated.since_day(only_day, "made", datetime(2024, 3, 2, 20))


def test_one_file_per_bucket_and_spread_rows_without_key(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, 1 + i % 2, None if i % 3 == 0 else f"k{i}") for i in range(600)]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        dated.write_days(make(spark, rows), path, "made", key="key", buckets=4)
    finally:
        spark.conf.set(setting, "true")
    files = dated.open_days(spark, path).select(F.input_file_name().alias("f"), "key")
    named = {r["f"] for r in files.where("key is not null").collect()}
    nameless = {r["f"] for r in files.where("key is null").collect()}
    assert len(named) == 8 and len(nameless - named) > 0 and len(nameless) > 2


@pytest.fixture(scope="module")
def extracted(spark, tables, tmp_path_factory):
    """Two extracts of a folder, the second a week after the first."""
    folder = tmp_path_factory.mktemp("extracts")
    (folder / "m.csv").write_text("SKU,EC,Unit Cost,Category-Group\nx-1,5,2,Rings\n")
    from storelens.catalog.intake import search_pages

    search_pages(tables).write.json(str(folder / "pages"))
    landed = {"raw_shopify_variants": "variants", "raw_shopify_products": "shopify_listings", "raw_shopify_orders": "s_orders",
              "raw_shopify_order_lines": "order_lines", "stock_daily": "stock_daily"}
    for name, view in landed.items():
        getattr(tables, view).write.parquet(str(folder / "landed" / name))
    for as_of in (AS_OF.replace(month=7, day=25), AS_OF):
        jobs.extract_merchandising(
            spark, str(folder / "landed"), str(folder / "m.csv"), str(folder / "pages"), str(folder / "in"), as_of, buckets=4
        )
    return jobs._Folder(spark, str(folder / "in"))


def test_extracts_accumulate_days(spark, tables, extracted):
    bounds = [datetime(2001, 6, 25), datetime(2001, 7, 2)]
    orders = extracted["shopify_orders"]
    assert orders.agg(F.min("created_at_day")).first()[0] <= bounds[1].date()
    since = tables.s_orders.where(F.col("created_at") >= F.lit(bounds[0]))
    assert orders.count() == since.count() > 0


def test_report_reads_the_trailing_days_only(spark, extracted):
    plan = plan_of(merchandising.stock_windows(extracted["stock_daily"], AS_OF))
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date_day#\d+ >= 2001-07-02", plan)
    plan = plan_of(merchandising.current_stock(extracted["stock_daily"]))
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date_day#\d+ = ", plan)


def test_bucketed_lines_meet_their_orders_without_a_shuffle(spark, extracted):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bound = datetime(2001, 7, 2)
        lines = dated.since_day(extracted["shopify_order_lines"], "created_at", bound)
        sales = merchandising.variant_window_sales(lines, extracted["shopify_orders"], AS_OF)
        plan = plan_of(sales)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert re.findall(r"hashpartitioning\((\w+)#", plan).count("order_id") == 0
    assert "hashpartitioning(variant_id" in plan and plan.count("Bucketed: true") >= 2
    assert re.search(r"PartitionFilters: \[[^\]]*created_at_day#\d+ >= 2001-07-02", plan)


def test_plain_lines_are_filtered_by_the_recent_orders(spark, tables):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k) for k in settings}
    plain = merchandising.variant_window_sales(tables.order_lines, tables.s_orders, AS_OF)
    expected = sorted(plain.select("variant_id", "units_sold_30d", "order_count_7d").collect())
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sales = merchandising.variant_window_sales(tables.order_lines, tables.s_orders, AS_OF)
        assert "might_contain" in plan_of(sales)
        assert sorted(sales.select("variant_id", "units_sold_30d", "order_count_7d").collect()) == expected
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_counts_of_dated_extracts(spark, tables, tmp_path):
    by_day = {"orders": ByDay("created_at")}
    counts = run_extracts(spark, {"orders": lambda: tables.s_orders.where("order_id < '3'")}, str(tmp_path), by_day=by_day)
    assert counts.first()["row_count"] == tables.s_orders.where("order_id < '3'").count()
