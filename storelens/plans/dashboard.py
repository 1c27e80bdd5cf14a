"""The dashboard's queries as DataFrame builders with checked parameters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.dates import ts

# Fixed value: rows of one dashboard page.
PAGE_ROWS = 50

CAMPAIGN_COLUMNS = (
    "campaign_name",
    "subject",
    "list",
    "send_time",
    "total_recipients",
    "unique_opens",
    "open_rate",
    "unique_clicks",
    "click_rate",
    "revenue",
    "unsubscribes",
    "spam_complaints_rate",
)

SEGMENT_COLUMNS = (
    "segment_name",
    "total_campaigns",
    "total_sends",
    "avg_open_rate",
    "avg_click_rate",
    "total_campaign_revenue",
    "total_unsubscribes",
    "avg_spam_rate",
    "avg_bounce_rate",
    "total_customers",
    "total_orders",
    "total_order_revenue",
    "avg_order_value",
    "holiday_pct_morning",
    "holiday_pct_afternoon",
    "holiday_pct_evening",
    "holiday_pct_night",
    "workday_pct_morning",
    "workday_pct_afternoon",
    "workday_pct_evening",
    "workday_pct_night",
)


def _sort(column: str, descending: bool, allowed: tuple[str, ...], tie: str) -> list[Column]:
    """Order by a listed column, nulls at the end either way, then by the tie break."""
    if column not in allowed:
        raise ValueError(f"cannot sort by {column!r}, choose one of {', '.join(allowed)}")
    chosen = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
    return [chosen, F.asc_nulls_last(tie)]


def campaign_lists(campaigns: DataFrame) -> DataFrame:
    """The lists campaigns were sent to."""
    return campaigns.select("list").distinct().orderBy(F.asc_nulls_last("list"))


def campaign_list(
    campaigns: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    list_name: str | None = None,
    min_sends: int = 0,
    sort_by: str = "send_time",
    descending: bool = True,
    limit: int = PAGE_ROWS,
) -> DataFrame:
    """One page of campaigns after the chosen filters."""
    rows = campaigns
    if start is not None:
        rows = rows.filter(F.col("send_time") >= ts(start))
    if end is not None:
        rows = rows.filter(F.col("send_time") <= ts(end))
    if list_name:
        rows = rows.filter(F.col("list") == list_name)
    if min_sends > 0:
        rows = rows.filter(F.col("total_recipients") >= min_sends)
    order = _sort(sort_by, descending, CAMPAIGN_COLUMNS, "campaign_name")
    return rows.orderBy(*order).limit(limit).select(*CAMPAIGN_COLUMNS)


def segment_list(
    segments: DataFrame,
    min_sends: int = 0,
    sort_by: str = "total_customers",
    descending: bool = True,
) -> DataFrame:
    """Segments with at least the given sends."""
    order = _sort(sort_by, descending, SEGMENT_COLUMNS, "segment_name")
    return (
        segments.filter(F.col("total_sends") >= min_sends).orderBy(*order).select(*SEGMENT_COLUMNS)
    )
