"""Shop-maintenance queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.registry import Catalog
from storelens.catalog.views import AS_OF, RetailTables
from storelens.functions.dates import extract_since
from storelens.functions.text import product_gid
from storelens.plans import maintenance as w
from storelens.sources.warehouse import since

SINCE = extract_since(AS_OF, w.LOOKBACK_DAYS)
SET_TAGS = ["Clearance", "Plain"]


def product_sales(t: RetailTables) -> DataFrame:
    return w.product_sales_full_price(since(t.order_lines, "created_at", SINCE), t.variants)


def top_sellers(t: RetailTables) -> DataFrame:
    return w.top_sellers(product_sales(t), t.shopify_listings)


def stale(t: RetailTables) -> DataFrame:
    return w.stale_new_badges(t.shopify_listings, AS_OF)


def sale_products(t: RetailTables) -> DataFrame:
    """Products with a marked-down variant, some of them unlisted, and one missing id."""
    marked_down = t.variants.filter("compare_at_price > price").select("product_id").distinct()
    missing = t.shopify_listings.groupBy().agg(F.lit(None).cast("string").alias("product_id"))
    foreign = t.listing_tags.groupBy("tag").agg(F.concat(F.lit("x-"), "tag").alias("product_id"))
    return marked_down.union(missing).union(foreign.select("product_id"))


def badge_changes(t: RetailTables) -> DataFrame:
    return w.badge_set_plan(sale_products(t), "Sale", dry_run=False)


def tag_changes(t: RetailTables, add: bool) -> DataFrame:
    return w.tag_plan(sale_products(t).dropna(), SET_TAGS, add, dry_run=False)


def register(c: Catalog) -> None:
    c.part(
        "full_price",
        "select * from variants where compare_at_price is null or compare_at_price <= price",
    )
    c.part(
        "sold_products",
        f"""select v.product_id, cast(sum(l.quantity) as bigint) as total_quantity, sum(l.quantity * l.variant_price) as total_revenue,
                   count(distinct l.order_id) as order_count
            from order_lines l join full_price v on l.variant_id = v.variant_id
            where l.created_at >= timestamp '{SINCE}' and v.product_id is not null group by v.product_id""",
    )
    c.part(
        "best",
        """select cast(row_number() over (order by round(total_revenue, 4) desc, p.product_id) as int) as rank, p.product_id, p.total_quantity,
                  round_even(p.total_revenue, 2) as total_revenue, p.order_count, l.handle, l.title, l.product_type, l.badge
           from sold_products p join shopify_listings l on p.product_id = l.product_id where l.status = 'ACTIVE'
           order by rank limit 100""",
    )
    c.part(
        "stale_badges",
        f"""select *, cast(floor(epoch(timestamp '{AS_OF}' - published_at) / 86400) as bigint) as days_since_published
            from shopify_listings
            where status = 'ACTIVE' and badge = 'New' and published_at < timestamp '{AS_OF}' - interval 60 day""",
    )
    gid = """case when trim({0}) like 'gid://%' then trim({0}) else 'gid://shopify/Product/' || trim({0}) end"""
    c.part(
        "sale_ids",
        """select product_id from (select distinct product_id from variants where compare_at_price > price) a
           union all select null
           union all select 'x-' || tag from (select distinct tag from listing_tags) b""",
    )
    c.part("sale_gids", f"select {gid.format('product_id')} as product_gid from sale_ids")
    c.part(
        "tag_rows",
        f"select distinct {gid.format('product_id')} as product_gid, tag from listing_tags",
    )
    c.part(
        "tag_change_rows",
        "select product_gid, unnest(['Clearance', 'Plain']) as tag from sale_gids where product_gid is not null",
    )

    c.add(
        "active_listings",
        lambda t: w.active_listings(t.shopify_listings),
        "select * from shopify_listings where status = 'ACTIVE'",
    )
    c.add(
        "full_price_variants",
        lambda t: w.full_price_variants(t.variants),
        "select * from full_price",
    )
    c.add(
        "product_sales_full_price",
        product_sales,
        "select * from sold_products",
        total_revenue=3,
    )
    c.add("top_sellers", top_sellers, "select * from best", total_revenue=2)
    c.add(
        "badge_distribution",
        lambda t: w.badge_distribution(top_sellers(t)),
        "select badge, count(*) as row_count from best group by badge",
    )
    c.add(
        "stale_new_badges",
        stale,
        "select * from stale_badges",
    )
    c.add(
        "product_gid",
        lambda t: t.shopify_listings.select(
            "product_id",
            product_gid(F.concat(F.lit(" "), "product_id", F.lit(" "))).alias("gid"),
            product_gid(product_gid(F.col("product_id"))).alias("gid_again"),
        ),
        """select product_id, 'gid://shopify/Product/' || product_id as gid, 'gid://shopify/Product/' || product_id as gid_again
           from shopify_listings""",
    )
    flat = ["product_gid", "operation", "dry_run"]
    c.add(
        "badge_clear_plan",
        lambda t: w.badge_clear_plan(stale(t)).select(*flat, "payload.namespace", "payload.key"),
        f"""select {gid.format('product_id')} as product_gid, 'clear_badge' as operation, true as dry_run,
                   'custom' as namespace, 'badge' as key from stale_badges""",
    )
    c.add(
        "badge_set_plan",
        lambda t: badge_changes(t).select(*flat, "payload.*"),
        """select product_gid, 'update_badge' as operation, false as dry_run, 'custom' as namespace, 'badge' as key,
                  'Sale' as value, 'single_line_text_field' as type from sale_gids""",
    )
    c.add(
        "badge_applied",
        lambda t: w.badge_applied(t.shopify_listings, badge_changes(t)),
        """select * exclude (hit, badge), case when hit then 'Sale' else badge end as badge, hit as changed
           from (select *, product_id in (select product_id from sale_ids where product_id is not null) as hit from shopify_listings) l""",
    )
    c.add(
        "listings_after_clear",
        lambda t: w.badge_applied(t.shopify_listings, w.badge_clear_plan(stale(t), dry_run=False)).drop("changed"),
        """select * replace (case when product_id in (select product_id from stale_badges) then null else badge end as badge)
           from shopify_listings""",
    )
    c.add(
        "change_summary",
        lambda t: w.change_summary(w.change_results(badge_changes(t), t.shopify_listings)),
        """select 'update_badge' as operation, case when product_id in (select product_id from shopify_listings) then 'success' else 'failed' end as status,
                  count(*) as change_count from sale_ids group by 2""",
    )
    for name, add in (("tag_add_plan", True), ("tag_remove_plan", False)):
        c.add(
            name,
            lambda t, add=add: w.tag_plan(sale_products(t), SET_TAGS, add).select(
                *flat, F.array_join("payload.tags", ",").alias("tags")
            ),
            f"""select product_gid, '{w.TAGS_ADD if add else w.TAGS_REMOVE}' as operation, true as dry_run,
                       'Clearance,Plain' as tags from sale_gids""",
        )
    c.add(
        "tags_added",
        lambda t: w.tags_added(t.listing_tags, tag_changes(t, True)),
        "select * from tag_rows union select * from tag_change_rows",
    )
    c.add(
        "tags_removed",
        lambda t: w.tags_removed(t.listing_tags, tag_changes(t, False)),
        "select * from tag_rows except select * from tag_change_rows",
    )
