"""The chains as jobs from stored tables to stored results.

The extracts write what the other jobs read below ``source``; each job writes its
tables below ``target``; tables later steps read are read back from there.
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from storelens.functions.dates import extract_since
from storelens.operators.cleaning import normalize_headers
from storelens.operators.joins import assert_unique
from storelens.operators.reshape import size_columns
from storelens.plans import maintenance, merchandising, order_sheets, segments
from storelens.session import stage
from storelens.sources.dated import day_column, open_days, read_layout, since_day
from storelens.sources.extract import ByDay, run_extracts
from storelens.sources.files import read_master_csv, read_table, read_text_csvs, write_csv, write_table
from storelens.sources.pages import (
    PROFILE_PAGES,
    SEARCH_PAGES,
    SEGMENT_PAGES,
    PageKind,
    assert_complete,
    collection_positions,
    membership_from_pages,
    page_problems,
    profiles_from_pages,
    read_pages,
    readable_pages,
    segments_from_pages,
)
from storelens.sources.warehouse import WAREHOUSE_TABLES, read_landed, scan_table, since

# Fixed value: days of orders, lines and stock a merchandising extract covers.
EXTRACT_DAYS = 30

#: Buckets of the orders and lines of a day; choose them once for a target, so
#: that a bucket of the trailing days fits into a task.
ORDER_BUCKETS = 64


class _Folder:
    """Stored tables of one folder by name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getitem__(self, name: str) -> DataFrame:
        path = os.path.join(self.path, name)
        by_day = read_layout(self.spark, path) is not None
        return open_days(self.spark, path) if by_day else read_table(self.spark, path)

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        write_table(df, os.path.join(self.path, name), partition_by)
        return self[name]

    def report(self, name: str, df: DataFrame) -> None:
        write_csv(df, os.path.join(self.path, name))


def _whole_pull(spark: SparkSession, path: str, kind: PageKind, target: str, bad_pages: str) -> DataFrame:
    """The pages of a pull that can be read. What is wrong with the others, or
    missing, ends the extract (``bad_pages="fail"``) or is stored beside it
    (``"store"``) below ``bad_pages``."""
    if bad_pages not in ("fail", "store"):
        raise ValueError(f"bad_pages must be 'fail' or 'store', not {bad_pages!r}")
    pages = read_pages(spark, path)
    problems = page_problems(pages, kind)
    if bad_pages == "fail":
        assert_complete(problems, path)
    else:
        name = "_".join((kind.field, *kind.keys))
        write_table(problems, os.path.join(target, "bad_pages", name))
    return readable_pages(pages, kind)


def extract_merchandising(
    spark: SparkSession,
    landed: str,
    master: str,
    pages: str,
    target: str,
    as_of: datetime,
    buckets: int = ORDER_BUCKETS,
    bad_pages: str = "fail",
) -> DataFrame:
    """What ``merchandising_report`` reads: the product master file, the warehouse
    tables landed below ``landed``, those with dates for the trailing days, and
    the landed search pages of all collections. Returns the rows written.

    Orders, lines and stock are stored by day: a run replaces the trailing days
    and keeps older ones. Orders and lines are bucketed by order, so that the
    report joins them where they are."""
    bound = extract_since(as_of, EXTRACT_DAYS)
    scan = _landed(spark, landed)
    orders = ByDay("created_at", bound.date(), "order_id", buckets)
    by_day = {
        "shopify_orders": orders,
        "shopify_order_lines": orders,
        "stock_daily": ByDay("snapshot_date", bound.date()),
    }
    extracts = {
        "master_sku": lambda: read_master_csv(spark, master),
        "shopify_variants": lambda: scan("variants"),
        "shopify_listings": lambda: scan("shopify_listings"),
        "shopify_orders": lambda: scan("orders", bound, by_day=True),
        "shopify_order_lines": lambda: scan("order_lines", bound, by_day=True),
        "stock_daily": lambda: scan("stock_daily", bound, by_day=True),
        "collections": lambda: collection_positions(
            _whole_pull(spark, pages, SEARCH_PAGES, target, bad_pages)
        ),
    }
    return run_extracts(spark, extracts, target, {"collections": "collection"}, by_day)


def extract_marketing(
    spark: SparkSession,
    landed: str,
    segment_pages: str,
    profile_pages: str,
    target: str,
    since_day: datetime,
    bad_pages: str = "fail",
) -> DataFrame:
    """What ``segment_tables`` reads, but for the campaigns, which are uploaded:
    warehouse tables since a day, segments updated and profiles joined after it."""
    scan = _landed(spark, landed)

    def pull(path: str, kind: PageKind) -> DataFrame:
        return _whole_pull(spark, path, kind, target, bad_pages)

    profiles = pull(profile_pages, PROFILE_PAGES)
    extracts = {
        "shopify_customers": lambda: scan("shopify_customers", since_day),
        "shopify_orders": lambda: scan("orders", since_day),
        "shopify_order_lines": lambda: scan("order_lines", since_day),
        "shopify_variants": lambda: scan("variants"),
        "shopify_listings": lambda: scan("shopify_listings"),
        "segments": lambda: segments_from_pages(pull(segment_pages, SEGMENT_PAGES), updated_after=since_day),
        "profiles": lambda: profiles_from_pages(profiles, joined_after=since_day),
        "segment_membership": lambda: membership_from_pages(profiles, joined_after=since_day),
    }
    return run_extracts(spark, extracts, target)


def _landed(spark: SparkSession, folder: str):
    """Scans of landed warehouse tables by their registered name."""

    def scan(table: str, bound: datetime | None = None, by_day: bool = False) -> DataFrame:
        raw = read_landed(spark, os.path.join(folder, WAREHOUSE_TABLES[table][0]))
        return scan_table(raw, table, bound, by_day)

    return scan


def merchandising_report(spark: SparkSession, source: str, target: str, as_of: datetime) -> None:
    """Variant and listing sales, summaries, collection tables and report tables."""
    have, out = _Folder(spark, source), _Folder(spark, target)
    lines = have["shopify_order_lines"]
    if day_column("created_at") in lines.columns:
        # what the extract as of this moment covers, whatever else is stored
        lines = since_day(lines, "created_at", extract_since(as_of, EXTRACT_DAYS))
    variants = merchandising.variant_sales(
        lines,
        have["shopify_orders"],
        have["shopify_variants"],
        have["master_sku"],
        have["stock_daily"],
        as_of,
    )
    variants = out.write("variant_sales", variants)
    listings = out.write(
        "listing_sales", merchandising.listing_sales(variants, have["shopify_listings"])
    )
    for name, summary in (
        ("summary_by_type", merchandising.summary_by_type),
        ("summary_by_markdown", merchandising.summary_by_markdown),
    ):
        out.report(f"{name}_csv", out.write(name, summary(listings)))
    out.write("category_share", merchandising.category_share(listings))
    out.write("type_share", merchandising.type_share(listings))
    collections = have["collections"]
    metrics = stage(merchandising.collection_metrics(collections, listings), "collection_metrics")
    out.write("collection_analysis", merchandising.collection_analysis(metrics), "collection")
    out.write("collection_match_rate", merchandising.collection_match_rate(metrics))
    shown = stage(merchandising.collection_candidates(collections, listings), "collection_candidates")
    out.write("collection_heat", merchandising.collection_heat(shown))
    out.write("collection_buried_rank", merchandising.collection_buried_rank(shown))
    totals = merchandising.collection_sizes(collections, listings)
    out.write("collection_report_header", merchandising.collection_report_header(shown, totals=totals))


def segment_tables(spark: SparkSession, source: str, target: str) -> None:
    """Customers with profiles, order, customer and segment features, event-only buyers."""
    have, out = _Folder(spark, source), _Folder(spark, target)
    orders = have["shopify_orders"]
    customers = out.write(
        "customers", segments.customer_profiles(have["shopify_customers"], have["profiles"])
    )
    f_orders = out.write("f_orders", segments.order_features(orders))
    f_customers = out.write("f_customers", segments.customer_features(customers, f_orders))
    f_segments = segments.segment_features(
        have["segments"],
        have["segment_membership"],
        have["campaigns"],
        customers,
        orders,
        f_customers,
    )
    out.write("f_segments", f_segments)
    out.write("segment_bfcm_only", segments.event_only_segment(orders, customers))


def order_sheet_import(
    spark: SparkSession,
    sheets: str,
    master: str,
    variant_export: str,
    contacts: str,
    target: str,
    as_of: datetime,
    reps: dict[str, str],
    sales_team: str = order_sheets.SALES_TEAM,
    tag: str = order_sheets.ORDER_TAG,
) -> None:
    """All order sheets of a folder to the import table and its quality tables.

    The import files are one folder per sheet. Fails when the resolved product
    master still has a parent and size twice.
    """
    out = _Folder(spark, target)
    filtered = stage(
        order_sheets.master_filtered(
            order_sheets.master_ext_id(
                normalize_headers(read_text_csvs(spark, master)),
                normalize_headers(read_text_csvs(spark, variant_export)),
            )
        ),
        "master",
    )
    out.write("master_duplicates", order_sheets.master_duplicates(filtered))
    unique = stage(order_sheets.master_unique(filtered), "master_unique")
    assert_unique(unique, order_sheets.MASTER_KEY, "product master")
    lookup = stage(order_sheets.orderable(unique), "lookup")
    sheet = order_sheets.clean_sheet(read_text_csvs(spark, sheets, own_headers=True))
    sizes = size_columns(sheet.columns, filtered, "size_abbreviation")
    groups = out.write("order_groups", order_sheets.order_groups(sheet))
    ordered = order_sheets.order_items(groups, sizes)
    items = out.write("order_items", order_sheets.order_items_enriched(ordered, lookup))
    people = normalize_headers(read_text_csvs(spark, contacts))
    table = out.write("order_import", order_sheets.order_import(items, groups, people, as_of, reps, sales_team, tag))
    files = order_sheets.import_files(table)
    files.write.mode("overwrite").partitionBy("file").csv(os.path.join(target, "order_import_csv"), header=True)
    out.write("unmatched_items", order_sheets.order_items_unmatched(ordered, lookup))
    out.write("missing_ext_ids", order_sheets.missing_ext_ids(items))
    out.write("defaulted_ship_dates", order_sheets.defaulted_ship_dates(groups, as_of))
    out.write("unknown_rep_files", order_sheets.unknown_rep_files(groups, reps))


def best_sellers(
    spark: SparkSession, order_lines: DataFrame, source: str, target: str, as_of: datetime
) -> DataFrame:
    """The top sellers since the look-back, as a report; ``order_lines`` are raw rows."""
    have, out = _Folder(spark, source), _Folder(spark, target)
    bound = extract_since(as_of, maintenance.LOOKBACK_DAYS)
    sales = maintenance.product_sales_full_price(
        since(order_lines, "created_at", bound), have["shopify_variants"]
    )
    top = out.write("top_sellers", maintenance.top_sellers(sales, have["shopify_listings"]))
    out.report("top_sellers_csv", top.orderBy("rank"))
    out.write("badge_distribution", maintenance.badge_distribution(top))
    return top


def clear_stale_badges(
    spark: SparkSession, source: str, target: str, as_of: datetime, dry_run: bool = True
) -> DataFrame:
    """Plan the removal of stale badges; live, also write all listings as they are
    after it, under a name of their own."""
    have, out = _Folder(spark, source), _Folder(spark, target)
    stale = maintenance.stale_new_badges(have["shopify_listings"], as_of)
    plan = out.write("badge_plan", maintenance.badge_clear_plan(stale, dry_run))
    results = maintenance.change_results(plan, have["shopify_listings"])
    out.write("change_summary", maintenance.change_summary(results))
    if not dry_run:
        applied = maintenance.badge_applied(have["shopify_listings"], plan)
        out.write("shopify_listings_after", applied.drop("changed"))
    return plan
