"""Shop maintenance: best sellers, stale badges, badge and tag change plans."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.dates import cutoff, ts
from storelens.functions.ratios import is_true
from storelens.functions.text import product_gid
from storelens.operators.joins import join_tables, value_counts
from storelens.operators.ordering import top_n

# Report and rule parameters, and where a badge is stored.
LOOKBACK_DAYS = 60
TOP_SELLERS = 100
STALE_DAYS = 60
ACTIVE = "ACTIVE"
NEW_BADGE = "New"
BADGE_NAMESPACE, BADGE_KEY, BADGE_TYPE = "custom", "badge", "single_line_text_field"

SUCCESS, FAILED = "success", "failed"
BADGE_SET, BADGE_CLEAR = "update_badge", "clear_badge"
TAGS_ADD, TAGS_REMOVE = "add_tags", "remove_tags"


def active_listings(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col("status") == ACTIVE)


def full_price_variants(variants: DataFrame) -> DataFrame:
    """Variants that are not marked down."""
    list_price = F.col("compare_at_price")
    return variants.filter(list_price.isNull() | (list_price <= F.col("price")))


def product_sales_full_price(order_lines: DataFrame, variants: DataFrame) -> DataFrame:
    """Quantity, revenue and orders per product, sales of marked-down variants left out.

    Summing per (product, order) first makes distinct orders a plain count.
    """
    sold = full_price_variants(variants).select("variant_id", "product_id")
    lines = order_lines.select("variant_id", "order_id", "quantity", "variant_price")
    return (
        join_tables(lines, sold, "variant_id", how="inner")
        .filter(F.col("product_id").isNotNull())
        .groupBy("product_id", "order_id")
        .agg(
            F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
            F.sum(F.col("quantity") * F.col("variant_price")).alias("revenue"),
        )
        .groupBy("product_id")
        .agg(
            F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity"),
            F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_revenue"),
            F.count("order_id").alias("order_count"),
        )
    )


def top_sellers(product_sales: DataFrame, listings: DataFrame, n: int = TOP_SELLERS) -> DataFrame:
    """The ``n`` active products with the highest revenue, ranked from 1."""
    details = active_listings(listings).select(
        "product_id", "handle", "title", "product_type", "badge"
    )
    joined = join_tables(product_sales, details, "product_id", how="inner", null_keys="sql")
    order = [F.desc_nulls_last("total_revenue"), F.asc("product_id")]
    best = top_n(joined, order, n)
    # the window numbers the n rows that are left
    rank = F.row_number().over(Window.orderBy(*order))
    return best.select(rank.alias("rank"), "*").withColumn(
        "total_revenue", F.bround("total_revenue", 2)
    )


def badge_distribution(top: DataFrame) -> DataFrame:
    return value_counts(top, "badge")


def stale_new_badges(
    listings: DataFrame, as_of: datetime, threshold_days: int = STALE_DAYS
) -> DataFrame:
    """Active products that still carry the badge after the threshold, oldest first."""
    published = F.col("published_at")
    stale = active_listings(listings).filter(
        (F.col("badge") == NEW_BADGE) & (published < cutoff(as_of, threshold_days))
    )
    days = F.timestamp_diff("DAY", published, ts(as_of))
    return stale.withColumn("days_since_published", days).orderBy(
        F.desc("days_since_published"), "product_id"
    )


def _plan(products: DataFrame, operation: str, payload: Column, dry_run: bool) -> DataFrame:
    return products.select(
        product_gid(F.col("product_id")).alias("product_gid"),
        F.lit(operation).alias("operation"),
        payload.alias("payload"),
        F.lit(dry_run).alias("dry_run"),
    )


def badge_set_plan(products: DataFrame, badge: str, dry_run: bool = True) -> DataFrame:
    """One badge update per product."""
    payload = F.struct(
        F.lit(BADGE_NAMESPACE).alias("namespace"),
        F.lit(BADGE_KEY).alias("key"),
        F.lit(badge).alias("value"),
        F.lit(BADGE_TYPE).alias("type"),
    )
    return _plan(products, BADGE_SET, payload, dry_run)


def badge_clear_plan(products: DataFrame, dry_run: bool = True) -> DataFrame:
    """One badge removal per product."""
    payload = F.struct(
        F.lit(BADGE_NAMESPACE).alias("namespace"), F.lit(BADGE_KEY).alias("key")
    )
    return _plan(products, BADGE_CLEAR, payload, dry_run)


def tag_plan(
    products: DataFrame, tags: str | Sequence[str], add: bool, dry_run: bool = True
) -> DataFrame:
    """One tag change per product, for one or several tags."""
    names = [tags] if isinstance(tags, str) else [str(t) for t in tags]
    payload = F.struct(F.array(*[F.lit(t) for t in names]).alias("tags"))
    return _plan(products, TAGS_ADD if add else TAGS_REMOVE, payload, dry_run)


def _tag_changes(plan: DataFrame) -> DataFrame:
    return plan.select("product_gid", F.explode("payload.tags").alias("tag")).distinct()


def _with_gid(tags: DataFrame) -> DataFrame:
    return tags.select(product_gid(F.col("product_id")).alias("product_gid"), "tag")


def tags_added(tags: DataFrame, plan: DataFrame) -> DataFrame:
    """(product, tag) rows after an add plan: a set union."""
    return _with_gid(tags).union(_tag_changes(plan)).distinct()


def tags_removed(tags: DataFrame, plan: DataFrame) -> DataFrame:
    """(product, tag) rows after a remove plan: a set difference."""
    return _with_gid(tags).distinct().join(_tag_changes(plan), ["product_gid", "tag"], "left_anti")


def change_results(plan: DataFrame, listings: DataFrame) -> DataFrame:
    """Outcome of every change: unknown or missing products fail, a dry run never does."""
    known = listings.select(product_gid(F.col("product_id")).alias("product_gid")).distinct()
    marked = plan.join(known.withColumn("__known", F.lit(True)), "product_gid", "left")
    status = F.when(F.col("dry_run") | F.col("__known"), SUCCESS).otherwise(FAILED)
    return marked.withColumn("status", status).drop("__known")


def change_summary(results: DataFrame) -> DataFrame:
    """Succeeded and failed changes per operation."""
    return results.groupBy("operation", "status").agg(F.count(F.lit(1)).alias("change_count"))


def badge_applied(listings: DataFrame, plan: DataFrame) -> DataFrame:
    """Listings after a badge plan; a dry run changes nothing.

    A product named more than once in a plan is changed once; setting a badge
    takes the place of clearing it.
    """
    live = plan.filter(~F.col("dry_run"))
    names = {f.name for f in plan.schema["payload"].dataType.fields}
    value = F.col("payload.value") if "value" in names else F.lit(None).cast("string")
    change = live.groupBy("product_gid").agg(F.max(value).alias("__value"))
    keyed = listings.withColumn("product_gid", product_gid(F.col("product_id")))
    joined = keyed.join(change.withColumn("__hit", F.lit(True)), "product_gid", "left")
    hit = is_true(F.col("__hit"))
    return joined.withColumn(
        "badge", F.when(hit, F.col("__value")).otherwise(F.col("badge"))
    ).select(*listings.columns, hit.alias("changed"))
