"""Queries on tables stored by day and by order, as repeated extracts leave them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.registry import Catalog
from storelens.catalog.views import AS_OF, RetailTables
from storelens.functions.dates import extract_since
from storelens.plans import merchandising as m
from storelens.plans.jobs import EXTRACT_DAYS
from storelens.session import shared_dir
from storelens.sources.dated import day_column, open_days, write_days
from storelens.sources.extract import ByDay, run_extracts
from storelens.sources.warehouse import scan_table

# The run before the one as of AS_OF; both cover some days.
EARLIER = AS_OF - timedelta(days=20)
BUCKETS = 4


def _bound(as_of: datetime) -> datetime:
    return extract_since(as_of, EXTRACT_DAYS)


def orders_in_two_runs(t: RetailTables) -> DataFrame:
    """Orders after two extracts. The later one has other prices, and nothing of
    the fifth of a month, which the earlier one had."""
    path = shared_dir(t.spark, "orders-by-day")
    early = t.s_orders.filter(F.col("created_at") <= F.lit(EARLIER).cast("timestamp_ntz"))
    late = t.s_orders.filter(F.dayofmonth("created_at") != 5).withColumn(
        "current_total_price", F.col("current_total_price") + 1
    )
    for rows, as_of in ((early, EARLIER), (late, AS_OF)):
        bound = _bound(as_of)
        by_day = ByDay("created_at", bound.date(), "order_id", BUCKETS)
        extract = lambda rows=rows, bound=bound: scan_table(rows, "orders", bound, by_day=True)
        run_extracts(t.spark, {"orders": extract}, path, by_day={"orders": by_day})
    return open_days(t.spark, f"{path}/orders")


def stock_by_day(t: RetailTables) -> DataFrame:
    path = shared_dir(t.spark, "stock-by-day")
    write_days(t.stock_daily, path, "snapshot_date")
    return open_days(t.spark, path)


def lines_and_orders(t: RetailTables) -> tuple[DataFrame, DataFrame]:
    """Lines and orders of the trailing days, bucketed by order."""
    bound, frames = _bound(AS_OF), []
    for rows, table in ((t.order_lines, "order_lines"), (t.s_orders, "orders")):
        path = shared_dir(t.spark, f"{table}-by-day")
        write_days(
            scan_table(rows, table, bound, by_day=True), path, "created_at", bound.date(), "order_id", BUCKETS
        )
        frames.append(open_days(t.spark, path))
    return frames[0], frames[1]


def register(c: Catalog) -> None:
    first, second = (f"timestamp '{_bound(moment)}'" for moment in (EARLIER, AS_OF))
    c.add(
        "orders_by_day_rerun",
        lambda t: orders_in_two_runs(t).drop(day_column("created_at")),
        f"""select order_id, customer_id, created_at, current_total_price, channel_name, discount_codes
            from s_orders where created_at >= {first} and created_at < {second} and created_at <= timestamp '{EARLIER}'
            union all
            select order_id, customer_id, created_at, current_total_price + 1 as current_total_price, channel_name,
                   discount_codes
            from s_orders where created_at >= {second} and day(created_at) <> 5""",
    )
    c.add(
        "stock_window_by_day",
        lambda t: m.stock_windows(stock_by_day(t), AS_OF),
        "select k30.sku, "
        + ", ".join(
            f"coalesce(k{d}.days, 0) as days_in_stock_{d}d, k{d}.qty as avg_free_qty_{d}d" for d in m.WINDOWS
        )
        + " from stock_30 k30 left join stock_14 k14 on k30.sku = k14.sku left join stock_7 k7 on k30.sku = k7.sku",
        **{f"avg_free_qty_{d}d": 6 for d in m.WINDOWS},
    )
    c.add("current_stock_by_day", lambda t: m.current_stock(stock_by_day(t)), "select * from stock_now")
    windows = {d: f"timestamp '{AS_OF - timedelta(days=d)}'" for d in m.WINDOWS}
    sums = ", ".join(
        f"""cast(coalesce(sum(quantity) filter (where ordered_at >= {w}), 0) as bigint) as units_sold_{d}d,
            coalesce(sum(variant_price * quantity) filter (where ordered_at >= {w}), 0) as revenue_{d}d,
            count(distinct order_id) filter (where ordered_at >= {w}) as order_count_{d}d,
            sum(variant_price * quantity) filter (where ordered_at >= {w})
                / nullif(sum(quantity) filter (where ordered_at >= {w}), 0) as aur_{d}d"""
        for d, w in windows.items()
    )
    c.add(
        "variant_window_sales_bucketed",
        lambda t: m.variant_window_sales(*lines_and_orders(t), AS_OF),
        f"""select variant_id, {sums} from (
              select l.order_id, l.variant_id, l.quantity, l.variant_price, o.created_at as ordered_at
              from order_lines l join s_orders o on l.order_id = o.order_id
              where l.created_at >= {second} and o.created_at >= {windows[max(m.WINDOWS)]} and l.variant_id is not null) x
            group by variant_id""",
        **{f"revenue_{d}d": 3 for d in m.WINDOWS},
        **{f"aur_{d}d": 6 for d in m.WINDOWS},
    )
