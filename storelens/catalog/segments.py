"""Marketing-segment and dashboard queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.registry import Catalog
from storelens.catalog.views import RetailTables
from storelens.functions.buckets import DAY_PARTS, hour_bucket, tz_cohort
from storelens.functions.dates import day_type
from storelens.operators.joins import value_counts
from storelens.plans import dashboard as d
from storelens.plans import segments as s

EVENT_START, EVENT_END = datetime(1996, 6, 1), datetime(2001, 7, 20)


def customers(t: RetailTables) -> DataFrame:
    return s.customer_profiles(t.shopify_customers, t.profiles)


def order_features(t: RetailTables) -> DataFrame:
    return s.order_features(t.s_orders)


def customer_features(t: RetailTables) -> DataFrame:
    return s.customer_features(customers(t), order_features(t))


def segment_features(t: RetailTables) -> DataFrame:
    return s.segment_features(
        t.segments,
        t.segment_membership,
        t.campaigns,
        customers(t),
        t.s_orders,
        customer_features(t),
    )


def loose_tables(t: RetailTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members, customers and orders with more nulls on both sides of their keys,
    and orders that several customers share."""
    profile, customer, order = F.col("profile_id"), F.col("customer_id"), F.col("order_id")
    odd = (F.length(profile) % 5 == 0) & profile.endswith("7")
    members = t.segment_membership.select(F.when(~odd, profile).alias("profile_id"), "segment_id")
    owners = customers(t).select(
        F.when(~customer.endswith("3"), profile).alias("profile_id"),
        F.when(~customer.endswith("19"), customer).alias("customer_id"),
    )
    shared = F.concat(F.lit("shared-"), F.substring(order, 1, 2))
    sold = t.s_orders.select(
        F.when(order.endswith("11"), shared).otherwise(order).alias("order_id"),
        "customer_id",
        "current_total_price",
    )
    return members, owners, sold


def register(c: Catalog) -> None:
    # -- shared SQL -----------------------------------------------------------
    c.part(
        "matched_customers",
        """select c.*, p.profile_id from shopify_customers c
           left join profiles p on trim(lower(c.email)) = trim(lower(p.email))""",
    )
    c.part(
        "calendar_days",
        """select cast(g.day as date) as day, extract(isodow from g.day) as dow, year(g.day) as y, month(g.day) as mon, day(g.day) as dom,
                  row_number() over (partition by year(g.day), month(g.day), extract(isodow from g.day) order by g.day) as nth,
                  row_number() over (partition by year(g.day), month(g.day), extract(isodow from g.day) order by g.day desc) as nth_last
           from (select unnest(generate_series(timestamp '1990-01-01', timestamp '2031-12-31', interval 1 day)) as day) g""",
    )
    c.part(
        "fixed_days",
        """select day, dow from calendar_days
           where (mon = 1 and dom = 1) or (mon = 7 and dom = 4) or (mon = 11 and dom = 11)
              or (mon = 12 and dom = 25) or (mon = 6 and dom = 19 and y >= 2021)""",
    )
    c.part(
        "holiday_days",
        """select day from fixed_days
           union select day - 1 from fixed_days where dow = 6
           union select day + 1 from fixed_days where dow = 7
           union select day from calendar_days
                 where (mon = 1 and dow = 1 and nth = 3) or (mon = 2 and dow = 1 and nth = 3) or (mon = 5 and dow = 1 and nth_last = 1)
                    or (mon = 9 and dow = 1 and nth = 1) or (mon = 10 and dow = 1 and nth = 2) or (mon = 11 and dow = 4 and nth = 4)""",
    )
    c.part(
        "timed_orders",
        """select *, cast(hour(created_at) as int) as hour,
                  case when extract(isodow from created_at) >= 6 or cast(created_at as date) in (select day from holiday_days)
                       then 'holiday' else 'workday' end as day_type
           from s_orders""",
    )
    c.part(
        "own_hours",
        """select customer_id, median(hour) filter (where day_type = 'holiday') as holiday_send_hour,
                  median(hour) filter (where day_type = 'workday') as workday_send_hour
           from timed_orders where customer_id is not null group by customer_id""",
    )
    state = "upper(trim(default_address_province))"
    states = f"""
        when {state} in ('CT', 'DC', 'DE', 'FL', 'GA', 'IN', 'KY', 'MA', 'MD', 'ME', 'MI', 'NC', 'NH', 'NJ', 'NY', 'OH', 'PA', 'RI', 'SC', 'VA', 'VT', 'WV') then 'eastern'
        when {state} in ('AL', 'AR', 'IA', 'IL', 'KS', 'LA', 'MN', 'MO', 'MS', 'ND', 'NE', 'OK', 'SD', 'TN', 'TX', 'WI') then 'central'
        when {state} in ('AZ', 'CO', 'ID', 'MT', 'NM', 'UT', 'WY') then 'mountain'
        when {state} in ('AK', 'CA', 'HI', 'NV', 'OR', 'WA') then 'pacific'
    """
    c.part("cohorts", f"select *, case {states} end as tz_cohort from matched_customers")
    c.part(
        "hours_one",
        """select c.*, coalesce(h.holiday_send_hour, h.workday_send_hour) as h1, coalesce(h.workday_send_hour, h.holiday_send_hour) as w1
           from cohorts c left join own_hours h on c.customer_id = h.customer_id""",
    )
    c.part(
        "hours_two",
        """select o.*, coalesce(o.h1, d.h) as h2, coalesce(o.w1, d.w) as w2 from hours_one o
           left join (select tz_cohort, median(h1) as h, median(w1) as w from hours_one where tz_cohort is not null group by tz_cohort) d
             on o.tz_cohort = d.tz_cohort""",
    )
    c.part(
        "f_customers",
        """select * exclude (h1, w1, h2, w2),
                  cast(round_even(coalesce(h2, (select median(h2) from hours_two)), 0) as int) as holiday_send_hour,
                  cast(round_even(coalesce(w2, (select median(w2) from hours_two)), 0) as int) as workday_send_hour
           from hours_two""",
    )
    c.part(
        "campaign_totals",
        """select list as segment_name, count(campaign_id) as total_campaigns, cast(sum(total_recipients) as bigint) as total_sends,
                  avg(open_rate) as avg_open_rate, avg(click_rate) as avg_click_rate, sum(revenue) as total_campaign_revenue,
                  cast(sum(unsubscribes) as bigint) as total_unsubscribes, avg(spam_complaints_rate) as avg_spam_rate,
                  avg(bounce_rate) as avg_bounce_rate
           from campaigns where list is not null group by list""",
    )

    def bucket(hour: str) -> str:
        return (
            f"case when {hour} is null then null when {hour} >= 6 and {hour} < 12 then 'morning' "
            f"when {hour} >= 12 and {hour} < 18 then 'afternoon' when {hour} >= 18 and {hour} < 24 then 'evening' else 'night' end"
        )

    c.part(
        "member_times",
        f"""select m.segment_id, {bucket('f.holiday_send_hour')} as holiday_bucket, {bucket('f.workday_send_hour')} as workday_bucket
            from segment_membership m left join f_customers f on m.profile_id = f.profile_id""",
    )
    shares = ", ".join(
        f"coalesce(count(*) filter (where {k}_bucket = '{p}') / nullif(cast(count({k}_bucket) as double), 0), 0) as {k}_pct_{p}"
        for k in ("holiday", "workday")
        for p in DAY_PARTS
    )
    c.part(
        "send_times",
        f"""select segment_id, {shares} from member_times group by segment_id
            having count(holiday_bucket) > 0 or count(workday_bucket) > 0""",
    )
    c.part(
        "purchases",
        """select segment_id, total_customers, total_orders, total_order_revenue,
                  coalesce(total_order_revenue / nullif(total_orders, 0), 0) as avg_order_value
           from (select m.segment_id, count(distinct m.profile_id) as total_customers, count(distinct o.order_id) as total_orders,
                        coalesce(sum(o.current_total_price), 0) as total_order_revenue
                 from segment_membership m
                 left join matched_customers c on m.profile_id = c.profile_id
                 left join s_orders o on c.customer_id = o.customer_id
                 group by m.segment_id) g""",
    )
    pct_columns = [f"{k}_pct_{p}" for k in ("holiday", "workday") for p in DAY_PARTS]
    c.part(
        "f_segments",
        f"""select s.segment_id, s.segment_name, coalesce(t.total_campaigns, 0) as total_campaigns, coalesce(t.total_sends, 0) as total_sends,
                   t.avg_open_rate, t.avg_click_rate, t.total_campaign_revenue, coalesce(t.total_unsubscribes, 0) as total_unsubscribes,
                   t.avg_spam_rate, t.avg_bounce_rate, {', '.join(f'coalesce(d.{x}, 0) as {x}' for x in pct_columns)},
                   coalesce(p.total_customers, 0) as total_customers, coalesce(p.total_orders, 0) as total_orders,
                   p.total_order_revenue, p.avg_order_value
            from segments s left join campaign_totals t on s.segment_name = t.segment_name
            left join send_times d on s.segment_id = d.segment_id left join purchases p on s.segment_id = p.segment_id""",
    )

    # -- queries --------------------------------------------------------------
    c.add("customer_profiles", customers, "select * from matched_customers")
    c.add("order_features", order_features, "select * from timed_orders")
    c.add(
        "order_day_type",
        lambda t: t.s_orders.select("order_id", day_type(F.col("created_at")).alias("day_type")),
        "select order_id, day_type from timed_orders",
    )
    c.add(
        "tz_cohort",
        lambda t: t.shopify_customers.select(
            "customer_id", tz_cohort(F.col("default_address_province")).alias("tz_cohort")
        ),
        f"select customer_id, case {states} end as tz_cohort from shopify_customers",
    )
    c.add(
        "hour_bucket",
        lambda t: t.s_orders.select(
            "order_id", hour_bucket(F.hour("created_at")).alias("day_part")
        ),
        f"select order_id, {bucket('hour(created_at)')} as day_part from s_orders",
    )
    c.add(
        "customer_median_hours",
        lambda t: s.customer_median_hours(order_features(t)),
        "select * from own_hours",
    )
    c.add("customer_send_hours", customer_features, "select * from f_customers")
    rates = {"avg_open_rate": 8, "avg_click_rate": 8, "avg_spam_rate": 8, "avg_bounce_rate": 8}
    pct_digits = {x: 8 for x in pct_columns}
    c.add(
        "campaign_stats",
        lambda t: s.campaign_stats(t.campaigns),
        "select * from campaign_totals",
        **rates,
        total_campaign_revenue=3,
    )
    c.add(
        "segment_send_time",
        lambda t: s.segment_send_time(t.segment_membership, customer_features(t)),
        "select * from send_times",
        **pct_digits,
    )
    c.add(
        "segment_purchase_stats",
        lambda t: s.segment_purchase_stats(t.segment_membership, customers(t), t.s_orders),
        "select * from purchases",
        total_order_revenue=2,
        avg_order_value=4,
    )
    for null_keys, equal in (("sql", "="), ("match", "is not distinct from")):
        c.add(
            f"segment_purchase_stats_null_{null_keys}",
            lambda t, null_keys=null_keys: s.segment_purchase_stats(
                *loose_tables(t), null_keys=null_keys
            ),
            f"""with members as (
                  select case when length(profile_id) % 5 = 0 and profile_id like '%7' then null else profile_id end as profile_id,
                         segment_id from segment_membership
                ), owners as (
                  select case when customer_id like '%3' then null else profile_id end as profile_id,
                         case when customer_id like '%19' then null else customer_id end as customer_id
                  from matched_customers
                ), sold as (
                  select case when order_id like '%11' then concat('shared-', substring(order_id, 1, 2)) else order_id end as order_id,
                         customer_id, current_total_price from s_orders
                )
                select segment_id, total_customers, total_orders, total_order_revenue,
                       coalesce(total_order_revenue / nullif(total_orders, 0), 0) as avg_order_value
                from (select m.segment_id, count(distinct m.profile_id) as total_customers,
                             count(distinct o.order_id) as total_orders, coalesce(sum(o.current_total_price), 0) as total_order_revenue
                      from members m left join owners c on m.profile_id {equal} c.profile_id
                      left join sold o on c.customer_id {equal} o.customer_id
                      group by m.segment_id) g""",
            total_order_revenue=2,
            avg_order_value=4,
        )
    wide = {
        **rates,
        **pct_digits,
        "total_campaign_revenue": 3,
        "total_order_revenue": 2,
        "avg_order_value": 4,
    }
    c.add("segment_features", segment_features, "select * from f_segments", **wide)
    c.add(
        "bfcm_only_segment",
        lambda t: s.event_only_segment(t.s_orders, customers(t), EVENT_START, EVENT_END),
        f"""select customer_id, min(created_at) as first_order_date from s_orders
            where customer_id in (select customer_id from matched_customers where profile_id is not null)
            group by customer_id
            having bool_and(created_at between timestamp '{EVENT_START}' and timestamp '{EVENT_END}')
               and min(created_at) between timestamp '{EVENT_START}' and timestamp '{EVENT_END}'""",
    )
    c.add(
        "day_type_distribution",
        lambda t: value_counts(order_features(t), "day_type"),
        "select day_type, count(*) as row_count from timed_orders group by day_type",
    )
    c.add(
        "hour_distribution",
        lambda t: value_counts(order_features(t), "hour"),
        "select hour, count(*) as row_count from timed_orders group by hour",
    )
    c.add(
        "tz_cohort_distribution",
        lambda t: value_counts(customer_features(t), "tz_cohort"),
        "select tz_cohort, count(*) as row_count from f_customers group by tz_cohort",
    )
    c.add(
        "send_hour_distribution",
        lambda t: value_counts(customer_features(t), "holiday_send_hour"),
        "select holiday_send_hour, count(*) as row_count from f_customers group by holiday_send_hour",
    )
    c.add(
        "workday_send_hour_distribution",
        lambda t: value_counts(customer_features(t), "workday_send_hour"),
        "select workday_send_hour, count(*) as row_count from f_customers group by workday_send_hour",
    )
    c.add(
        "campaign_lists",
        lambda t: d.campaign_lists(t.campaigns),
        "select distinct list from campaigns",
    )
    c.add(
        "campaign_list",
        lambda t: d.campaign_list(
            t.campaigns,
            start=datetime(2024, 1, 3),
            end=datetime(2024, 1, 25),
            min_sends=2,
            sort_by="click_rate",
        ),
        f"""select {', '.join(d.CAMPAIGN_COLUMNS)} from campaigns
            where send_time >= timestamp '2024-01-03' and send_time <= timestamp '2024-01-25' and total_recipients >= 2
            order by click_rate desc nulls last, campaign_name nulls last limit 50""",
        revenue=3,
    )
    c.add(
        "segment_list",
        lambda t: d.segment_list(segment_features(t), min_sends=10),
        f"select {', '.join(d.SEGMENT_COLUMNS)} from f_segments where total_sends >= 10",
        **wide,
    )
