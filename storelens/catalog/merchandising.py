"""Merchandising queries."""

from __future__ import annotations

from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.registry import Catalog
from storelens.catalog.views import AS_OF, RetailTables
from storelens.operators.ordering import range_rank
from storelens.plans import merchandising as m
from storelens.session import stage

WINDOWS = m.WINDOWS


def _moment(days: int) -> str:
    return f"timestamp '{AS_OF - timedelta(days=days)}'"


def variant_sales(t: RetailTables) -> DataFrame:
    return m.variant_sales(
        t.order_lines, t.s_orders, t.variants, t.master_sku, t.stock_daily, AS_OF
    )


def listing_sales(t: RetailTables) -> DataFrame:
    return m.listing_sales(variant_sales(t), t.shopify_listings)


def stored_listings(t: RetailTables) -> DataFrame:
    """The listing table written first, for results that read it more than once."""
    return stage(listing_sales(t), "listing_sales")


def collection_metrics(t: RetailTables) -> DataFrame:
    return m.collection_metrics(t.searchspring_collection, stored_listings(t))


def shown_metrics(t: RetailTables) -> DataFrame:
    """The rows of ``collection_metrics`` that the first rows are among."""
    return m.collection_candidates(t.searchspring_collection, stored_listings(t), buried=0)


def candidates(t: RetailTables, listings: DataFrame | None = None) -> DataFrame:
    """The rows of ``collection_metrics`` that the first and the buried rows are among."""
    listings = stored_listings(t) if listings is None else listings
    return stage(m.collection_candidates(t.searchspring_collection, listings), "collection_candidates")


def report_header(t: RetailTables) -> DataFrame:
    listings = stored_listings(t)
    totals = m.collection_sizes(t.searchspring_collection, listings)
    return m.collection_report_header(candidates(t, listings), totals=totals)


# What the SQL below ranks: column, short name, whether lower is better; and the
# digits metrics are compared to. Said again here so that the library is checked.
SQL_RANKED = (
    ("revenue_30d", "revenue", False),
    ("rate_of_sale_30d", "ros", False),
    ("velocity_trend", "velocity", False),
    ("markdown_pct", "markdown", True),
    ("margin_pct", "margin", False),
)
SQL_DIGITS = """round(revenue_30d, 3) as revenue_30d, round(rate_of_sale_30d, 8) as rate_of_sale_30d,
    round(rate_of_sale_7d, 8) as rate_of_sale_7d, round(markdown_pct, 8) as markdown_pct,
    round(margin_pct, 8) as margin_pct, round(weeks_of_sale, 6) as weeks_of_sale"""


def _over(step, source):
    return lambda t: step(source(t))


def register(c: Catalog) -> None:
    # -- shared SQL -----------------------------------------------------------
    c.part(
        "dated_lines",
        """select l.order_id, l.variant_id, l.quantity, l.variant_price, o.created_at as ordered_at
           from order_lines l left join s_orders o on l.order_id is not distinct from o.order_id""",
    )
    for d in WINDOWS:
        c.part(
            f"sales_{d}",
            f"""select variant_id, cast(sum(quantity) as bigint) as units, sum(variant_price * quantity) as revenue,
                       count(distinct order_id) as n_orders
                from dated_lines where ordered_at >= {_moment(d)} and variant_id is not null group by variant_id""",
        )
        c.part(
            f"stock_{d}",
            f"""select internal_reference as sku,
                       cast(sum(case when lower(in_stock) = 'true' then 1 else 0 end) as bigint) as days, avg(free_qty) as qty
                from stock_daily where snapshot_date >= {_moment(d)} and internal_reference is not null
                group by internal_reference""",
        )
    c.part(
        "priced",
        """select v.variant_id, v.product_id, v.sku, v.price, coalesce(v.compare_at_price, k.ec, v.price) as compare_at_price,
                  k.unit_cost, k.category_group
           from variants v left join master_sku k on v.sku = k.sku""",
    )
    c.part(
        "priced_pct",
        """select *, greatest(coalesce((compare_at_price - price) / nullif(compare_at_price, 0), 0), 0) as markdown_pct,
                  greatest(coalesce((price - unit_cost) / nullif(price, 0), 0), 0) as margin_pct
           from priced""",
    )
    c.part(
        "stock_now",
        """select internal_reference as sku, free_qty as current_qty from stock_daily
           where snapshot_date = (select max(snapshot_date) from stock_daily)""",
    )
    sales = ", ".join(
        f"""coalesce(s{d}.units, 0) as units_sold_{d}d, coalesce(s{d}.revenue, 0) as revenue_{d}d,
            coalesce(s{d}.n_orders, 0) as order_count_{d}d, s{d}.revenue / nullif(s{d}.units, 0) as aur_{d}d"""
        for d in WINDOWS
    )
    stock = ", ".join(
        f"coalesce(k{d}.days, 0) as days_in_stock_{d}d, coalesce(k{d}.qty, 0) as avg_free_qty_{d}d"
        for d in WINDOWS
    )
    rates = ", ".join(
        f"coalesce(s{d}.units / nullif(cast(k{d}.days as double), 0), 0) as rate_of_sale_{d}d"
        for d in WINDOWS
    )
    joins = " ".join(
        f"left join sales_{d} s{d} on v.variant_id = s{d}.variant_id left join stock_{d} k{d} on v.sku = k{d}.sku"
        for d in WINDOWS
    )
    weeks = """case when rate_of_sale_30d = 0 then case when current_qty = 0 then 0.0 else 9999.0 end
                    else current_qty / (rate_of_sale_30d * 7) end as weeks_of_sale"""
    c.part(
        "variant_sales",
        f"""select *, {weeks} from (
              select v.*, coalesce(n.current_qty, 0) as current_qty, {sales}, {stock}, {rates}
              from priced_pct v left join stock_now n on v.sku = n.sku {joins}) w""",
    )
    means = ("price", "compare_at_price", "markdown_pct", "unit_cost", "margin_pct")
    sums = ("units_sold", "revenue", "order_count", "days_in_stock")
    whole = ("units_sold", "order_count", "days_in_stock")

    def _sum(name: str, d: int) -> str:
        total = f"sum({name}_{d}d)"
        return f"cast({total} as bigint)" if name in whole else f"coalesce({total}, 0)"

    c.part(
        "listing_rollup",
        "select product_id, count(sku) as variant_count, "
        "arg_min(category_group, variant_id) filter (where category_group is not null) as category_group, "
        + ", ".join(f"avg({x}) as {x}" for x in means)
        + ", coalesce(sum(current_qty), 0) as current_qty, "
        + ", ".join(f"{_sum(x, d)} as {x}_{d}d" for d in WINDOWS for x in sums)
        + " from variant_sales where product_id is not null group by product_id",
    )
    listing_rates = ", ".join(
        f"coalesce(units_sold_{d}d / nullif(cast(days_in_stock_{d}d as double), 0), 0) as rate_of_sale_{d}d, "
        f"coalesce(revenue_{d}d / nullif(units_sold_{d}d, 0), 0) as aur_{d}d"
        for d in WINDOWS
    )
    c.part(
        "listing_sales",
        f"""select l.*, s.title, s.product_type, s.published_at
            from (select *, {weeks} from (select *, {listing_rates} from listing_rollup) r where current_qty >= 5) l
            left join shopify_listings s on l.product_id = s.product_id""",
    )
    c.part("rounded_listings", f"select * replace ({SQL_DIGITS}) from listing_sales")
    c.part(
        "collection_metrics",
        """select k.collection, k.position, k.name, s.product_id, s.published_at, s.units_sold_30d, s.revenue_30d,
                  s.rate_of_sale_30d, coalesce(s.rate_of_sale_7d / nullif(s.rate_of_sale_30d, 0), 0) as velocity_trend,
                  s.markdown_pct, s.margin_pct, s.weeks_of_sale,
                  case when s.weeks_of_sale < 1 then 1 else 0 end as low_stock
           from searchspring_collection k left join rounded_listings s on k.name = s.title""",
    )
    c.part(
        "collection_rows",
        """select *, cast(row_number() over (partition by collection order by position nulls last, product_id nulls last) as int) as row_no
           from collection_metrics""",
    )
    c.part("shown_rows", "select * from collection_rows where row_no <= 50")
    c.part(
        "buried_rows",
        """select * from (
             select *, cast(row_number() over (partition by collection
                      order by revenue_30d desc nulls last, position nulls last, product_id nulls last) as int) as buried_no
             from collection_rows where row_no > 50) r
           where buried_no <= 5""",
    )

    def pct_rank(column: str, part: str = "collection") -> str:
        return (
            f"(rank() over (partition by {part} order by {column} nulls last) "
            f"+ (count(*) over (partition by {part}, {column}) - 1) / 2.0e0) / count(*) over (partition by {part})"
        )

    ranks = ", ".join(
        f"{pct_rank(column)} as {short}_rank" for column, short, _ in SQL_RANKED if short != "margin"
    )
    c.part(
        "ranked_rows",
        f"""select *, {ranks}, case when margin_pct > 0 then {pct_rank('margin_pct', 'collection, coalesce(margin_pct > 0, false)')}
                    else 0.5e0 end as margin_rank
            from shown_rows""",
    )

    def heat(short: str, invert: bool, known: str) -> str:
        r = f"(1 - {short}_rank)" if invert else f"{short}_rank"
        low, high = f"({known}) and {r} <= 0.30e0", f"({known}) and {r} >= 0.70e0"
        low_alpha = f"(0.3e0 + 0.5e0 * (0.30e0 - {r}) / 0.30e0)"
        high_alpha = f"(0.3e0 + 0.5e0 * ({r} - 0.70e0) / 0.30e0)"
        return (
            f"case when {low} then -1 when {high} then 1 else 0 end as {short}_band, "
            f"case when {low} then {low_alpha} when {high} then {high_alpha} end as {short}_alpha, "
            f"case when {low} then concat('rgba(255, 107, 107, ', printf('%.8f', {low_alpha}), ')') "
            f"when {high} then concat('rgba(46, 204, 113, ', printf('%.8f', {high_alpha}), ')') "
            f"else 'transparent' end as {short}_color"
        )

    shown_heat = ", ".join(
        heat(short, invert, f"{column} is not null" + (" and margin_pct <> 0" if short == "margin" else ""))
        for column, short, invert in SQL_RANKED
    )
    limits = ", ".join(
        f"quantile_cont({column}, 0.30) as {short}_p30, quantile_cont({column}, 0.70) as {short}_p70"
        for column, short, _ in SQL_RANKED
    )
    c.part("shown_limits", f"select collection, {limits} from shown_rows group by collection")

    def relative(column: str, short: str) -> str:
        p30, p70 = f"{short}_p30", f"{short}_p70"
        return (
            f"case when {p30} is null then null when {column} is null then 0.5e0 "
            f"when {column} <= {p30} then case when {p30} > 0 then 0.15e0 * ({column} / {p30}) else 0.0e0 end "
            f"when {column} >= {p70} then case when {p70} > 0 "
            f"then 0.70e0 + 0.30e0 * least(({column} - {p70}) / ({p70} * 0.5e0), 1.0e0) else 1.0e0 end "
            f"when {p70} > {p30} then 0.30e0 + 0.40e0 * ({column} - {p30}) / ({p70} - {p30}) else 0.5e0 end as {short}_rank"
        )

    relatives = ", ".join(relative(column, short) for column, short, _ in SQL_RANKED)
    c.part(
        "buried_ranked",
        f"select b.* exclude (row_no), {relatives} from buried_rows b join shown_limits using (collection)",
    )
    buried_heat = ", ".join(
        heat(short, invert, f"{short}_rank is not null") for _, short, invert in SQL_RANKED
    )

    # -- queries --------------------------------------------------------------
    money = {f"revenue_{d}d": 3 for d in WINDOWS}
    aur = {f"aur_{d}d": 6 for d in WINDOWS}
    ros = {f"rate_of_sale_{d}d": 8 for d in WINDOWS}
    free = {f"avg_free_qty_{d}d": 6 for d in WINDOWS}
    pct = {"markdown_pct": 8, "margin_pct": 8}
    price = {"price": 6, "compare_at_price": 6, "unit_cost": 6}
    weeks_d = {"weeks_of_sale": 6}

    window_sql = ", ".join(
        f"coalesce(s{d}.units, 0) as units_sold_{d}d, coalesce(s{d}.revenue, 0) as revenue_{d}d, "
        f"coalesce(s{d}.n_orders, 0) as order_count_{d}d, s{d}.revenue / nullif(s{d}.units, 0) as aur_{d}d"
        for d in WINDOWS
    )
    c.add(
        "variant_window_sales",
        lambda t: m.variant_window_sales(t.order_lines, t.s_orders, AS_OF),
        f"""select s30.variant_id, {window_sql} from sales_30 s30
            left join sales_14 s14 on s30.variant_id = s14.variant_id
            left join sales_7 s7 on s30.variant_id = s7.variant_id""",
        **money,
        **aur,
    )
    c.add("current_stock", lambda t: m.current_stock(t.stock_daily), "select * from stock_now")
    c.add(
        "stock_window",
        lambda t: m.stock_windows(t.stock_daily, AS_OF),
        "select k30.sku, "
        + ", ".join(
            f"coalesce(k{d}.days, 0) as days_in_stock_{d}d, k{d}.qty as avg_free_qty_{d}d"
            for d in WINDOWS
        )
        + " from stock_30 k30 left join stock_14 k14 on k30.sku = k14.sku left join stock_7 k7 on k30.sku = k7.sku",
        **free,
    )
    c.add("variant_base", lambda t: m.variant_base(t.variants, t.master_sku), "select * from priced")
    c.add(
        "variant_pricing",
        lambda t: m.variant_pricing(m.variant_base(t.variants, t.master_sku)),
        "select * from priced_pct",
        **pct,
    )
    c.add(
        "variant_current_stock",
        lambda t: m.variant_current_stock(t.variants, t.stock_daily),
        """select v.*, coalesce(n.current_qty, 0) as current_qty
           from variants v left join stock_now n on v.sku = n.sku""",
    )
    c.add(
        "variant_sales",
        variant_sales,
        "select * from variant_sales",
        **money, **aur, **ros, **free, **pct, **weeks_d,
    )
    c.add(
        "listing_rollup",
        _over(m.listing_rollup, variant_sales),
        "select * from listing_rollup",
        **money, **pct, **price,
    )
    c.add(
        "listing_sales",
        listing_sales,
        "select * from listing_sales",
        **money, **aur, **ros, **pct, **price, **weeks_d,
    )
    summary = """count(product_id) as listing_count, cast(sum(units_sold_30d) as bigint) as units_sold_30d,
                 sum(revenue_30d) as revenue_30d, sum(revenue_30d) / count(product_id) as avg_revenue_per_listing"""
    c.add(
        "summary_by_type",
        _over(m.summary_by_type, listing_sales),
        f"""select category_group, product_type, {summary} from listing_sales
            where category_group is not null and product_type is not null group by category_group, product_type""",
        revenue_30d=3,
        avg_revenue_per_listing=5,
    )
    c.add(
        "summary_by_markdown",
        _over(m.summary_by_markdown, listing_sales),
        f"""select case when markdown_pct = 0 then '0% (Full Price)' when markdown_pct <= 0.20 then '1-20%'
                        when markdown_pct <= 0.50 then '21-50%' else '50%+' end as markdown_bucket, {summary}
            from listing_sales group by 1""",
        revenue_30d=3,
        avg_revenue_per_listing=5,
    )
    c.add(
        "category_share",
        _over(m.category_share, stored_listings),
        """select category_group, sum(revenue_30d) as revenue_30d, cast(sum(units_sold_30d) as bigint) as units_sold_30d,
                  sum(revenue_30d) * 100 / sum(sum(revenue_30d)) over () as pct_revenue
           from listing_sales where category_group in ('CLOTHING', 'JEWELRY') group by category_group""",
        revenue_30d=3,
        pct_revenue=7,
    )
    c.add(
        "type_share",
        _over(m.type_share, stored_listings),
        """select category_group, product_type, revenue_30d, units_sold_30d,
                  revenue_30d * 100 / (select sum(revenue_30d) from listing_sales where category_group in ('CLOTHING', 'JEWELRY')) as pct_of_total,
                  revenue_30d * 100 / sum(revenue_30d) over (partition by category_group) as pct_of_group
           from (select category_group, product_type, sum(revenue_30d) as revenue_30d, cast(sum(units_sold_30d) as bigint) as units_sold_30d
                 from listing_sales where category_group in ('CLOTHING', 'JEWELRY') and product_type is not null
                 group by category_group, product_type) g""",
        revenue_30d=3,
        pct_of_total=7,
        pct_of_group=7,
    )
    metric_digits = {
        "revenue_30d": 3,
        "rate_of_sale_30d": 8,
        "velocity_trend": 7,
        **pct,
        **weeks_d,
    }
    stored = ", ".join(m.COLLECTION_COLUMNS)
    c.add(
        "collection_analysis",
        _over(m.collection_analysis, collection_metrics),
        f"select {stored} from collection_metrics",
        **metric_digits,
    )
    c.add(
        "collection_match_rate",
        _over(m.collection_match_rate, collection_metrics),
        """select 'collection' as check_name, collection, count(rate_of_sale_30d) as matched, count(*) as total,
                  count(rate_of_sale_30d) * 100.0e0 / count(*) as match_pct from collection_metrics group by collection""",
        match_pct=7,
    )
    rank_keys = ["collection", "position", "product_id"]
    shorts = [short for _, short, _ in SQL_RANKED]

    def pick(step, source, columns):
        return lambda t: step(source(t)).select(*columns)

    top_columns = [*m.COLLECTION_COLUMNS, "product_id", "row_no"]
    c.add(
        "collection_top50",
        pick(partial(m.collection_top, n=50), shown_metrics, top_columns),
        f"select {', '.join(top_columns)} from shown_rows",
        **metric_digits,
    )
    buried_columns = [*m.COLLECTION_COLUMNS, "product_id", "buried_no"]
    c.add(
        "collection_buried",
        pick(m.collection_buried, candidates, buried_columns),
        f"select {', '.join(buried_columns)} from buried_rows",
        **metric_digits,
    )
    rank_columns = [*rank_keys, *[f"{s}_rank" for s in shorts]]
    c.add(
        "collection_percentile_rank",
        pick(m.collection_percentile_rank, shown_metrics, rank_columns),
        f"select {', '.join(rank_columns)} from ranked_rows",
        **{f"{s}_rank": 8 for s in shorts},
    )
    whole_ranks = ", ".join(
        f"{pct_rank(column)} as {short}_rank" for column, short, _ in SQL_RANKED if short != "margin"
    )
    c.add(
        "collection_percentile_rank_whole",
        lambda t: m.collection_ranks(t.searchspring_collection, stored_listings(t)).select(*rank_columns),
        f"""select {', '.join(rank_keys)}, {whole_ranks},
                   case when margin_pct > 0 then {pct_rank('margin_pct', 'collection, coalesce(margin_pct > 0, false)')}
                        else 0.5e0 end as margin_rank
            from collection_rows""",
        **{f"{s}_rank": 8 for s in shorts},
    )
    c.add(
        "price_rank_in_category",
        lambda t: range_rank(
            range_rank(
                m.variant_base(t.variants, t.master_sku), ["category_group"], "price", "price_rank"
            ),
            ["category_group"],
            "unit_cost",
            "cost_rank",
        ).select("variant_id", "category_group", "price_rank", "cost_rank"),
        f"""select variant_id, category_group, {pct_rank('price', 'category_group')} as price_rank,
                   {pct_rank('unit_cost', 'category_group')} as cost_rank from priced""",
        price_rank=9,
        cost_rank=9,
    )
    heat_columns = [f"{s}_{x}" for s in shorts for x in ("band", "alpha", "color")]
    c.add(
        "collection_heat",
        pick(m.collection_heat, shown_metrics, [*rank_keys, *heat_columns]),
        f"select {', '.join(rank_keys)}, {shown_heat} from ranked_rows",
        **{f"{s}_alpha": 7 for s in shorts},
    )
    c.add(
        "collection_buried_rank",
        pick(m.collection_buried_rank, candidates, [*rank_columns, "buried_no", *heat_columns]),
        f"select {', '.join(rank_columns)}, buried_no, {buried_heat} from buried_ranked",
        **{f"{s}_rank": 7 for s in shorts},
        **{f"{s}_alpha": 6 for s in shorts},
    )
    c.add(
        "collection_report_header",
        report_header,
        """select collection, concat(upper(substring(collection, 1, 1)), lower(substring(collection, 2))) as name,
                  cast(sum(case when rate_of_sale_30d is not null and shown then 1 else 0 end) as bigint) as matched, count(*) as total,
                  cast(sum(case when shown then 1 else 0 end) as bigint) as total_shown,
                  sum(case when rate_of_sale_30d is not null and shown then 100.0e0 else 0.0e0 end) / count(*) as match_rate,
                  cast(sum(case when row_no > 50 then 1 else 0 end) as bigint) as buried_count,
                  max(row_no) > 50 as has_buried
           from (select r.*, r.row_no <= 50 or b.buried_no is not null as shown from collection_rows r
                 left join buried_rows b on r.collection = b.collection and r.row_no = b.row_no) x
           group by collection""",
        match_rate=7,
    )
