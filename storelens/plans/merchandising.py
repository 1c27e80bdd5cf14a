"""Merchandising chain: variant sales, listing sales, summaries, collections."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.buckets import (
    heat_alpha,
    heat_band,
    heat_color,
    markdown_bucket,
    markdown_order,
)
from storelens.functions.dates import cutoff
from storelens.functions.ratios import (
    is_true,
    ratio,
    ratio_or_null,
    relative_drop,
    weeks_of_sale,
)
from storelens.functions.text import title_words
from storelens.operators.cleaning import id_columns_first
from storelens.operators.joins import collapse, join_tables, match_stats, spread_join, weighted_join
from storelens.operators.ordering import average_rank, join_ranks, top_per_group, value_ranks
from storelens.session import stage
from storelens.sources.dated import latest_rows, since_day

# Report parameters.
WINDOWS = (30, 14, 7)
MIN_CURRENT_QTY = 5
LOW_STOCK_WEEKS = 1
CATEGORY_GROUPS = ("CLOTHING", "JEWELRY")
TOP_N = 50
BURIED_N = 5

# Ranked metrics of the collection report: column, short name, lower is better.
RANKED = (
    ("revenue_30d", "revenue", False),
    ("rate_of_sale_30d", "ros", False),
    ("velocity_trend", "velocity", False),
    ("markdown_pct", "markdown", True),
    ("margin_pct", "margin", False),
)

# Ranks depend on ties, so metrics are compared without their last digits, which the
# order of addition decides.
RANK_DIGITS = {
    "revenue_30d": 3,
    "rate_of_sale_30d": 8,
    "rate_of_sale_7d": 8,
    "markdown_pct": 8,
    "margin_pct": 8,
    "weeks_of_sale": 6,
}

COLLECTION_COLUMNS = (
    "collection",
    "position",
    "name",
    "published_at",
    "units_sold_30d",
    "revenue_30d",
    "rate_of_sale_30d",
    "velocity_trend",
    "markdown_pct",
    "margin_pct",
    "weeks_of_sale",
    "low_stock",
)


def _sum0(c: Column) -> Column:
    """Sum that is zero instead of null when nothing is there to add."""
    return F.coalesce(F.sum(c), F.lit(0))


def variant_window_sales(
    order_lines: DataFrame, orders: DataFrame, as_of: datetime, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Units, revenue, orders and revenue per unit of each variant per trailing window.

    All windows come out of one pass. Lines meet the recent orders, then collapse
    per (order, variant) where they are; distinct orders are a plain count then.
    Tables bucketed by order meet without a shuffle. Of plain files Spark first
    leaves out lines whose order can't be recent, by a Bloom filter of bounded size
    over the recent order ids, and shuffles the others once, by order.
    Lines and orders without an order id are one order of their own.
    """
    recent = since_day(orders, "created_at", as_of - timedelta(days=max(windows)))
    recent = recent.select("order_id", "created_at")
    lines = order_lines.filter(F.col("variant_id").isNotNull()).select(
        "order_id", "variant_id", "quantity", "variant_price"
    )
    inside = {d: F.col("created_at") >= cutoff(as_of, d) for d in windows}
    units, revenue = F.col("quantity").cast("bigint"), F.col("variant_price") * F.col("quantity")
    per_order = (
        join_tables(lines, recent, "order_id", how="inner")
        .groupBy("order_id", "variant_id")
        .agg(
            *[_sum0(F.when(inside[d], units)).alias(f"units_{d}") for d in windows],
            *[_sum0(F.when(inside[d], revenue)).alias(f"revenue_{d}") for d in windows],
            *[F.bool_or(inside[d]).alias(f"ordered_{d}") for d in windows],
        )
        .drop("order_id")
    )
    # every nameless line meets every nameless order
    nameless = recent.filter(F.col("order_id").isNull()).agg(
        *[F.count_if(inside[d]).alias(f"times_{d}") for d in windows]
    )
    times = {d: nameless.select(f"times_{d}").scalar() for d in windows}
    without = (
        lines.filter(F.col("order_id").isNull())
        .groupBy("variant_id")
        .agg(_sum0(units).alias("units"), _sum0(revenue).alias("revenue"))
        .filter(times[max(windows)] > 0)
        .select(
            "variant_id",
            *[(F.col("units") * times[d]).alias(f"units_{d}") for d in windows],
            *[(F.col("revenue") * times[d]).alias(f"revenue_{d}") for d in windows],
            *[F.lit(False).alias(f"ordered_{d}") for d in windows],
        )
    )
    metrics = []
    for d in windows:
        metrics += [
            _sum0(F.col(f"units_{d}")).alias(f"units_sold_{d}d"),
            _sum0(F.col(f"revenue_{d}")).alias(f"revenue_{d}d"),
            F.count_if(F.col(f"ordered_{d}")).alias(f"order_count_{d}d"),
        ]
    sales = per_order.unionByName(without).groupBy("variant_id").agg(*metrics)
    return sales.withColumns(
        {
            f"aur_{d}d": ratio_or_null(F.col(f"revenue_{d}d"), F.col(f"units_sold_{d}d"))
            for d in windows
        }
    )


def current_stock(stock_daily: DataFrame) -> DataFrame:
    """Free quantity per sku at the latest snapshot of the whole table."""
    return latest_rows(stock_daily, "snapshot_date").select(
        F.col("internal_reference").alias("sku"), F.col("free_qty").alias("current_qty")
    )


def stock_windows(
    stock_daily: DataFrame, as_of: datetime, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Days in stock and mean free quantity per sku and trailing window."""
    metrics = []
    for d in windows:
        inside = F.col("snapshot_date") >= cutoff(as_of, d)
        metrics += [
            F.count_if(inside & (F.lower("in_stock") == "true")).alias(f"days_in_stock_{d}d"),
            F.avg(F.when(inside, F.col("free_qty"))).alias(f"avg_free_qty_{d}d"),
        ]
    return (
        since_day(stock_daily, "snapshot_date", as_of - timedelta(days=max(windows)))
        .filter(F.col("internal_reference").isNotNull())
        .groupBy(F.col("internal_reference").alias("sku"))
        .agg(*metrics)
    )


def _with_master(variants: DataFrame, master_sku: DataFrame) -> DataFrame:
    joined = join_tables(
        variants, master_sku.select("sku", "ec", "unit_cost", "category_group"), "sku"
    )
    list_price = F.coalesce("compare_at_price", "ec", "price")
    return joined.withColumn("compare_at_price", list_price).drop("ec")


def variant_base(variants: DataFrame, master_sku: DataFrame) -> DataFrame:
    """Variants with cost and category; a missing list price falls back to master, then price."""
    base = variants.select("variant_id", "product_id", "sku", "price", "compare_at_price")
    return _with_master(base, master_sku)


def variant_pricing(base: DataFrame) -> DataFrame:
    """Add the markdown and margin shares."""
    price, list_price, cost = F.col("price"), F.col("compare_at_price"), F.col("unit_cost")
    return base.withColumns(
        {
            "markdown_pct": relative_drop(list_price, price, list_price),
            "margin_pct": relative_drop(price, cost, price),
        }
    )


def variant_current_stock(variants: DataFrame, stock_daily: DataFrame) -> DataFrame:
    """Variants with the quantity at the latest snapshot, zero when unlisted."""
    joined = join_tables(variants, current_stock(stock_daily), "sku")
    return joined.withColumn("current_qty", F.coalesce("current_qty", F.lit(0.0)))


def variant_sales(
    order_lines: DataFrame,
    orders: DataFrame,
    variants: DataFrame,
    master_sku: DataFrame,
    stock_daily: DataFrame,
    as_of: datetime,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """One wide row per variant: price, stock and sales of every window."""
    sales = variant_window_sales(order_lines, orders, as_of, windows)
    stock = stock_windows(stock_daily, as_of, windows)
    base = variants.select("variant_id", "product_id", "sku", "price", "compare_at_price")
    # the three sku joins share one partitioning of the variants
    wide = variant_pricing(_with_master(base, master_sku))
    wide = variant_current_stock(wide, stock_daily)
    wide = join_tables(wide, stock, "sku")
    wide = join_tables(wide, sales, "variant_id", null_keys="sql")

    filled = {}
    for d in windows:
        for metric in ("units_sold", "order_count", "days_in_stock"):
            filled[f"{metric}_{d}d"] = F.coalesce(f"{metric}_{d}d", F.lit(0))
        for metric in ("revenue", "avg_free_qty"):
            filled[f"{metric}_{d}d"] = F.coalesce(f"{metric}_{d}d", F.lit(0.0))
    wide = wide.withColumns(filled)
    wide = wide.withColumns(
        {
            f"rate_of_sale_{d}d": ratio(F.col(f"units_sold_{d}d"), F.col(f"days_in_stock_{d}d"))
            for d in windows
        }
    )
    return wide.withColumn(
        "weeks_of_sale",
        weeks_of_sale(F.col("current_qty"), F.col(f"rate_of_sale_{max(windows)}d")),
    )


def listing_rollup(variants: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Variant rows summed up per product; the first category by variant id counts."""
    means = ("price", "compare_at_price", "markdown_pct", "unit_cost", "margin_pct")
    sums = ("units_sold", "revenue", "order_count", "days_in_stock")
    has_category = F.when(F.col("category_group").isNotNull(), F.col("variant_id"))
    return (
        variants.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count("sku").alias("variant_count"),
            F.min_by("category_group", has_category).alias("category_group"),
            *[F.avg(c).alias(c) for c in means],
            _sum0(F.col("current_qty")).alias("current_qty"),
            *[_sum0(F.col(f"{m}_{d}d")).alias(f"{m}_{d}d") for d in windows for m in sums],
        )
    )


def listing_sales(
    variants: DataFrame,
    listings: DataFrame,
    min_current_qty: float = MIN_CURRENT_QTY,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """Product metrics with rates, without nearly sold-out products, with listing details."""
    rolled = listing_rollup(variants, windows).filter(F.col("current_qty") >= min_current_qty)
    rates = {}
    for d in windows:
        units = F.col(f"units_sold_{d}d")
        rates[f"rate_of_sale_{d}d"] = ratio(units, F.col(f"days_in_stock_{d}d"))
        rates[f"aur_{d}d"] = ratio(F.col(f"revenue_{d}d"), units)
    rated = rolled.withColumns(rates)
    rated = rated.withColumn(
        "weeks_of_sale",
        weeks_of_sale(F.col("current_qty"), F.col(f"rate_of_sale_{max(windows)}d")),
    )
    details = listings.select("product_id", "title", "product_type", "published_at")
    joined = join_tables(rated, details, "product_id", null_keys="sql")
    return id_columns_first(
        joined, ["product_id", "title", "product_type", "category_group", "variant_count"]
    )


def _revenue_summary(listings: DataFrame, *keys: str) -> DataFrame:
    summed = (
        listings.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
        .groupBy(*keys)
        .agg(
            F.count("product_id").alias("listing_count"),
            _sum0(F.col("units_sold_30d")).alias("units_sold_30d"),
            _sum0(F.col("revenue_30d")).alias("revenue_30d"),
        )
    )
    return summed.withColumn(
        "avg_revenue_per_listing", ratio_or_null(F.col("revenue_30d"), F.col("listing_count"))
    )


def summary_by_type(listings: DataFrame) -> DataFrame:
    """Revenue by category and product type, largest first."""
    keys = ("category_group", "product_type")
    return _revenue_summary(listings, *keys).orderBy(F.desc_nulls_last("revenue_30d"), *keys)


def summary_by_markdown(listings: DataFrame) -> DataFrame:
    """Revenue by markdown class in class order."""
    classed = listings.withColumn("markdown_bucket", markdown_bucket(F.col("markdown_pct")))
    return _revenue_summary(classed, "markdown_bucket").orderBy(
        markdown_order(F.col("markdown_bucket"))
    )


def _reported(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col("category_group").isin(*CATEGORY_GROUPS))


def category_share(listings: DataFrame) -> DataFrame:
    """Revenue and its share of the total for the reported categories."""
    reported = _reported(listings)
    grouped = reported.groupBy("category_group").agg(
        _sum0(F.col("revenue_30d")).alias("revenue_30d"),
        _sum0(F.col("units_sold_30d")).alias("units_sold_30d"),
    )
    total = grouped.agg(_sum0(F.col("revenue_30d"))).scalar()
    return grouped.withColumn(
        "pct_revenue", ratio_or_null(F.col("revenue_30d") * 100, total)
    ).orderBy(F.desc_nulls_last("revenue_30d"), "category_group")


def type_share(listings: DataFrame) -> DataFrame:
    """Revenue of each product type as share of all and of its category."""
    by_type = (
        _reported(listings)
        .filter(F.col("product_type").isNotNull())
        .groupBy("category_group", "product_type")
        .agg(
            _sum0(F.col("revenue_30d")).alias("revenue_30d"),
            _sum0(F.col("units_sold_30d")).alias("units_sold_30d"),
        )
    )
    total = _reported(listings).agg(_sum0(F.col("revenue_30d"))).scalar()
    group_total = F.sum("revenue_30d").over(Window.partitionBy("category_group"))
    percent = F.col("revenue_30d") * 100
    return by_type.withColumns(
        {
            "pct_of_total": ratio_or_null(percent, total),
            "pct_of_group": ratio_or_null(percent, group_total),
        }
    ).orderBy("category_group", F.desc_nulls_last("revenue_30d"), "product_type")


def collection_metrics(
    collections: DataFrame,
    listings: DataFrame,
    columns: Sequence[str] = ("collection", "position", "name"),
) -> DataFrame:
    """All collections in one table: position and listing metrics matched by title,
    rounded to the digits they are ranked by.

    Keeps the product id, the tie break of everything ordered by position. A title
    that many rows of a collection and many listings have makes a row of every pair;
    what needs only some of them begins with ``collection_candidates``, what counts
    them with ``collection_sizes`` or ``collection_ranks``.
    """
    metrics = listings.withColumns({c: F.round(c, d) for c, d in RANK_DIGITS.items()}).select(
        "title",
        "product_id",
        "units_sold_30d",
        "revenue_30d",
        "rate_of_sale_30d",
        "rate_of_sale_7d",
        "markdown_pct",
        "margin_pct",
        "weeks_of_sale",
        "published_at",
    )
    joined = join_tables(
        collections.select(*columns), metrics, "name", right_on="title"
    )
    trend = ratio(F.col("rate_of_sale_7d"), F.col("rate_of_sale_30d"))
    low = is_true(F.col("weeks_of_sale") < LOW_STOCK_WEEKS)
    return joined.withColumns({"velocity_trend": trend, "low_stock": low.cast("int")})


def collection_analysis(metrics: DataFrame) -> DataFrame:
    """The stored columns of the collection table."""
    return metrics.select(*COLLECTION_COLUMNS)


def collection_match_rate(metrics: DataFrame) -> DataFrame:
    """Share of collection rows that found a listing."""
    return match_stats(
        metrics, F.col("rate_of_sale_30d").isNotNull(), "collection", by=["collection"]
    )


def _by_position() -> list[Column]:
    return [F.asc_nulls_last("position"), F.asc_nulls_last("product_id")]


def collection_candidates(
    collections: DataFrame, listings: DataFrame, n: int = TOP_N, buried: int = BURIED_N
) -> DataFrame:
    """The rows of ``collection_metrics`` that the first ``n`` of a collection and the
    ``buried`` best sellers after them are among.

    Every collection row has at least one row there, so the first ones come from the
    first ``n`` positions. Of the others only pairs count that fewer than ``buried``
    pairs of the same title surpass: those of the title's first rows in the
    collection and of its best listings.
    """
    rows = collections.select("collection", "position", "name")
    by_position = Window.partitionBy("collection").orderBy(F.asc_nulls_last("position"))
    near = rows.withColumn("__rank", F.rank().over(by_position)).filter(F.col("__rank") <= n)
    near = near.drop("__rank")
    found = collection_metrics(near, listings)
    if not buried:
        return found
    last = near.groupBy("collection").agg(
        F.max("position").alias("last_position"), F.bool_or(F.col("position").isNull()).alias("to_the_end")
    )
    later = is_true(F.col("position") > F.col("last_position")) | F.col("position").isNull()
    far = spread_join(rows, last, "collection").filter(~F.col("to_the_end") & later).select(*rows.columns)
    far = top_per_group(far, ["collection", "name"], [F.asc_nulls_last("position")], buried, "__nth")
    revenue = F.round("revenue_30d", RANK_DIGITS["revenue_30d"])
    order = [F.desc_nulls_last(revenue), F.asc_nulls_last("product_id")]
    best = top_per_group(listings.filter(F.col("title").isNotNull()), ["title"], order, buried, "__nth")
    return found.unionByName(collection_metrics(far, best))


def collection_sizes(collections: DataFrame, listings: DataFrame) -> DataFrame:
    """Number of rows ``collection_metrics`` has for each collection."""
    titles = collapse(listings.select(F.col("title").alias("name")), ["name"])
    rows = weighted_join(collapse(collections, ["collection", "name"]), titles, "name")
    return rows.groupBy("collection").agg(F.sum("weight").alias("total"))


def collection_top(metrics: DataFrame, n: int = TOP_N) -> DataFrame:
    """First ``n`` rows of every collection."""
    return top_per_group(metrics, ["collection"], _by_position(), n, "row_no")


def _shown_last(metrics: DataFrame, n: int) -> DataFrame:
    """Sort key of the last shown row of collections that have one to hide."""
    return (
        collection_top(metrics, n)
        .filter(F.col("row_no") == n)
        .select(
            "collection",
            F.col("position").alias("last_position"),
            F.col("product_id").alias("last_product"),
        )
    )


def collection_rest(metrics: DataFrame, n: int = TOP_N) -> DataFrame:
    """Rows after the first ``n`` of their collection.

    Found by comparing with the n-th row's sort key, one row per collection,
    so no task has to number a whole collection. That row joins with the
    collection spread over many tasks.
    """
    last = _shown_last(metrics, n)
    joined = spread_join(metrics, last, "collection")
    same = F.col("position").eqNullSafe(F.col("last_position"))
    later = is_true(F.col("position") > F.col("last_position")) | (
        F.col("position").isNull() & F.col("last_position").isNotNull()
    )
    later_product = is_true(F.col("product_id") > F.col("last_product")) | (
        F.col("product_id").isNull() & F.col("last_product").isNotNull()
    )
    return joined.filter(later | (same & later_product)).drop("last_position", "last_product")


def collection_buried(metrics: DataFrame, n: int = TOP_N, buried: int = BURIED_N) -> DataFrame:
    """Best sellers among the rows after the first ``n``."""
    order = [F.desc_nulls_last("revenue_30d"), *_by_position()]
    return top_per_group(collection_rest(metrics, n), ["collection"], order, buried, "buried_no")


def _with_heat(df: DataFrame, known: dict[str, Column]) -> DataFrame:
    """Add band, opacity and color of each ranked metric."""
    bands, alphas, colors = {}, {}, {}
    for _, short, invert in RANKED:
        rank = F.when(known[short], F.col(f"{short}_rank"))
        bands[f"{short}_band"] = heat_band(rank, invert)
        alphas[f"{short}_alpha"] = heat_alpha(rank, invert)
        colors[f"{short}_color"] = heat_color(F.col(f"{short}_band"), F.col(f"{short}_alpha"))
    return df.withColumns({**bands, **alphas}).withColumns(colors)


def collection_percentile_rank(
    metrics: DataFrame, n: int | None = TOP_N, weight: str | None = None
) -> DataFrame:
    """Percentile ranks among the first rows of each collection, or among all.

    Margins are ranked among positive ones only, the rest sits in the middle. Among
    all, a row may stand for several: as many as the column ``weight`` says.
    """
    sells_at_profit = is_true(F.col("margin_pct") > 0)
    if weight and n is not None:
        raise ValueError("rows with a weight are ranked among all only")
    if n is None:
        rows = ranked = metrics.withColumn("__profit", sells_at_profit)
        for column, short, _ in RANKED:
            part = ["collection", "__profit"] if short == "margin" else ["collection"]
            ranks = value_ranks(rows, part, column, f"{short}_rank", weight)
            ranked = join_ranks(ranked, ranks, [*part, column])
        margin = F.when(F.col("__profit"), F.col("margin_rank")).otherwise(0.5)
        return ranked.withColumn("margin_rank", margin).drop("__profit")
    ranks = {
        f"{short}_rank": average_rank(F.col(column), ["collection"])
        for column, short, _ in RANKED
        if short != "margin"
    }
    ranks["margin_rank"] = F.when(
        sells_at_profit, average_rank(F.col("margin_pct"), ["collection"], of=sells_at_profit)
    ).otherwise(0.5)
    return collection_top(metrics, n).withColumns(ranks)


def collection_ranks(collections: DataFrame, listings: DataFrame) -> DataFrame:
    """Percentile ranks among all rows ``collection_metrics`` has for a collection.

    Rows of a collection with the same name have the same metrics. They are one
    weighted row until all ranks are known; positions meet the result, in the only
    step that makes a row of every pair. What that step reads is small, so it is
    spread over all partitions by number: adaptive execution would put it together.
    """
    named = collapse(collections, ["collection", "name"])
    metrics = collection_metrics(named, listings, ["collection", "name", "weight"])
    ranked = collection_percentile_rank(stage(metrics, "named-metrics"), n=None, weight="weight")
    parts = int(collections.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct("collection", "name")  # never null, equal where both have the same nulls
    rows = collections.select("collection", "position", "name", key.alias("__key")).repartition(parts, "__key")
    ranked = ranked.withColumn("__key", key).drop("collection", "name", "weight")
    return rows.join(ranked.repartition(parts, "__key"), "__key").drop("__key")


def collection_heat(metrics: DataFrame, n: int = TOP_N) -> DataFrame:
    """Percentile ranks with their colors; unknown metrics and zero margins stay plain."""
    ranked = collection_percentile_rank(metrics, n)
    known = {short: F.col(column).isNotNull() for column, short, _ in RANKED}
    known["margin"] = is_true(F.col("margin_pct") != 0)
    return _with_heat(ranked, known)


def _relative_rank(v: Column, p30: Column, p70: Column) -> Column:
    """Where a value lies against the 30th and 70th percentile of the shown rows.

    A polygon through (0, 0), (p30, 0.15), then from (p30, 0.30) to (p70, 0.70),
    then from (p70, 0.70) to (1.5 p70, 1), where it ends. A part that is not
    there because its limit is not positive, or both limits are equal, is 0 at
    the low, 1 at the high end, and one half between.
    """

    below = F.when(p30 > 0, F.lit(0.15) * (v / p30)).otherwise(0.0)
    beyond = F.least((v - p70) / (p70 * 0.5), F.lit(1.0))
    above = F.when(p70 > 0, F.lit(0.70) + F.lit(0.30) * beyond).otherwise(1.0)
    between = F.coalesce(F.lit(0.30) + F.try_divide(F.lit(0.40) * (v - p30), p70 - p30), F.lit(0.5))
    # the place among the limits picks the part of the polygon
    part = F.when(v <= p30, below).when(v < p70, between).otherwise(above)
    return F.when(v.isNotNull(), part).otherwise(0.5)


def collection_buried_rank(
    metrics: DataFrame, n: int = TOP_N, buried: int = BURIED_N
) -> DataFrame:
    """Buried rows ranked and colored against the shown rows of their collection."""
    limits = (
        collection_top(metrics, n)
        .groupBy("collection")
        .agg(
            *[
                F.percentile(column, F.array(F.lit(0.30), F.lit(0.70))).alias(f"{short}_limits")
                for column, short, _ in RANKED
            ]
        )
    )
    rows = collection_buried(metrics, n, buried).join(limits, "collection")
    ranks, known = {}, {}
    for column, short, _ in RANKED:
        bounds = F.col(f"{short}_limits")
        known[short] = bounds.isNotNull()
        ranks[f"{short}_rank"] = F.when(
            known[short], _relative_rank(F.col(column), bounds[0], bounds[1])
        )
    ranked = _with_heat(rows.withColumns(ranks), known)
    return ranked.drop(*[f"{short}_limits" for _, short, _ in RANKED])


def collection_report_header(
    metrics: DataFrame, n: int = TOP_N, buried: int = BURIED_N, totals: DataFrame | None = None
) -> DataFrame:
    """Counts of matched, shown and hidden rows of each collection; ``totals`` has the
    rows of each where ``metrics`` are only the candidates."""
    matched = F.count_if(F.col("rate_of_sale_30d").isNotNull())
    shown = collection_top(metrics, n).groupBy("collection").agg(matched.alias("top_matched"))
    extra = (
        collection_buried(metrics, n, buried)
        .groupBy("collection")
        .agg(matched.alias("buried_matched"))
    )
    if totals is None:
        totals = metrics.groupBy("collection").agg(F.count(F.lit(1)).alias("total"))
    hidden = F.greatest(F.col("total") - n, F.lit(0))
    found = F.col("top_matched") + F.coalesce("buried_matched", F.lit(0))
    return (
        totals.join(shown, "collection", "left")
        .join(extra, "collection", "left")
        .select(
            "collection",
            title_words(F.col("collection")).alias("name"),
            found.alias("matched"),
            "total",
            (F.least(F.col("total"), F.lit(n)) + F.least(hidden, F.lit(buried))).alias(
                "total_shown"
            ),
            ratio(found * 100, F.col("total")).alias("match_rate"),
            hidden.alias("buried_count"),
            (hidden > 0).alias("has_buried"),
        )
    )
