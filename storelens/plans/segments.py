"""Marketing chain: customers, order and customer features, segment features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.buckets import DAY_PARTS, hour_bucket, tz_cohort
from storelens.functions.dates import day_type, within
from storelens.functions.ratios import ratio
from storelens.functions.text import email_key
from storelens.operators.bitmaps import bitmap_sets, number_ids, set_sizes
from storelens.operators.joins import collapse, join_tables, spread_join, weighted_join
from storelens.session import stage

# The sale event whose only-then buyers form a segment.
SALE_START = datetime(2024, 11, 24)
SALE_END = datetime(2024, 12, 2)

SEND_HOURS = ("holiday_send_hour", "workday_send_hour")

# Columns of the segment table that are zero, not null, for a segment without data.
COUNT_COLUMNS = (
    "total_campaigns",
    "total_sends",
    "total_unsubscribes",
    "total_customers",
    "total_orders",
)


def customer_profiles(
    customers: DataFrame, profiles: DataFrame, null_keys: str = "sql"
) -> DataFrame:
    """Customers with the ids of all profiles that share their email.

    Customers without an email have no profile. ``null_keys="match"`` lets
    customers and profiles without an email meet each other, every one with
    every other; count the pairs first.
    """
    keyed = customers.withColumn("__email", email_key(F.col("email")))
    other = profiles.select("profile_id", email_key(F.col("email")).alias("__email"))
    joined = join_tables(keyed, other, "__email", null_keys=null_keys)
    return joined.drop("__email")


def order_features(orders: DataFrame, holiday_years: tuple[int, int] | None = None) -> DataFrame:
    """Orders with their hour and day type."""
    created = F.col("created_at")
    return orders.withColumns({"hour": F.hour(created), "day_type": day_type(created, holiday_years)})


def customer_median_hours(order_features: DataFrame) -> DataFrame:
    """Median order hour per customer and day type, one column each.

    The aggregate keeps a count per distinct hour, so its state never exceeds
    24 entries per customer however many orders there are.
    """

    def median_of(kind: str) -> Column:
        return F.median(F.when(F.col("day_type") == kind, F.col("hour")))

    hours = (
        order_features.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            median_of("holiday").alias("holiday_send_hour"),
            median_of("workday").alias("workday_send_hour"),
        )
    )
    return hours.dropna("all", subset=list(SEND_HOURS))


def customer_features(customers: DataFrame, order_features: DataFrame) -> DataFrame:
    """Customers with time-zone cohort and a send hour for both day types.

    A missing hour is taken from the other day type, then from the cohort's
    median, then from the median of everybody, each step using the values the
    one before left behind.
    """
    holiday, workday = SEND_HOURS
    own = join_tables(
        customers.withColumn("tz_cohort", tz_cohort(F.col("default_address_province"))),
        customer_median_hours(order_features),
        "customer_id",
        null_keys="sql",
    )
    own = own.withColumns(
        {holiday: F.coalesce(holiday, workday), workday: F.coalesce(workday, holiday)}
    )
    # at most one row per cohort name, of which there are four
    defaults = (
        own.filter(F.col("tz_cohort").isNotNull())
        .groupBy("tz_cohort")
        .agg(*[F.median(h).alias(f"cohort_{h}") for h in SEND_HOURS])
    )
    local = own.join(F.broadcast(defaults), "tz_cohort", "left").withColumns(
        {h: F.coalesce(h, f"cohort_{h}") for h in SEND_HOURS}
    )
    overall = local.agg(F.struct(*[F.median(h).alias(h) for h in SEND_HOURS])).scalar()
    filled = local.withColumns(
        {h: F.bround(F.coalesce(F.col(h), overall[h])).cast("int") for h in SEND_HOURS}
    )
    return filled.select(*customers.columns, "tz_cohort", *SEND_HOURS)


def campaign_stats(campaigns: DataFrame) -> DataFrame:
    """Campaign totals and plain mean rates per list."""
    return (
        campaigns.filter(F.col("list").isNotNull())
        .groupBy(F.col("list").alias("segment_name"))
        .agg(
            F.count("campaign_id").alias("total_campaigns"),
            F.coalesce(F.sum("total_recipients"), F.lit(0)).alias("total_sends"),
            F.avg("open_rate").alias("avg_open_rate"),
            F.avg("click_rate").alias("avg_click_rate"),
            F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_campaign_revenue"),
            F.coalesce(F.sum("unsubscribes"), F.lit(0)).alias("total_unsubscribes"),
            F.avg("spam_complaints_rate").alias("avg_spam_rate"),
            F.avg("bounce_rate").alias("avg_bounce_rate"),
        )
    )


def segment_send_time(membership: DataFrame, customer_features: DataFrame) -> DataFrame:
    """Share of each part of the day among the send hours of a segment's members.

    Customers are counted per profile before the join, so a membership row
    meets one row whatever the number of customers behind the profile.
    """
    kinds = {"holiday": SEND_HOURS[0], "workday": SEND_HOURS[1]}
    cells = [(kind, part) for kind in kinds for part in DAY_PARTS]
    per_profile = customer_features.groupBy("profile_id").agg(
        *[
            F.count_if(hour_bucket(F.col(kinds[kind])) == part).alias(f"{kind}_{part}")
            for kind, part in cells
        ]
    )
    members = membership.filter(F.col("segment_id").isNotNull())
    counted = (
        join_tables(members, per_profile, "profile_id")
        .groupBy("segment_id")
        .agg(*[F.coalesce(F.sum(f"{k}_{p}"), F.lit(0)).alias(f"{k}_{p}") for k, p in cells])
    )

    def known(kind: str) -> Column:
        return sum((F.col(f"{kind}_{part}") for part in DAY_PARTS), F.lit(0))

    return counted.filter((known("holiday") > 0) | (known("workday") > 0)).select(
        "segment_id",
        *[ratio(F.col(f"{k}_{p}"), known(k)).alias(f"{k}_pct_{p}") for k, p in cells],
    )


def _order_sets(
    orders: DataFrame, links: DataFrame, groups: DataFrame | None, loose: DataFrame
) -> DataFrame:
    """Distinct orders per segment, as bitmaps of order numbers.

    Orders are numbered by customer, so a customer's are neighbours. ``links`` are
    (segment, customer) rows. ``groups`` are (segment, kind) rows of segments that
    also have all orders without a customer ("guests") or those of the ``loose``
    customers, whose bitmaps are made once and then handed to these segments.
    """
    named = orders.filter(F.col("order_id").isNotNull()).select("order_id", "customer_id").distinct()
    homes = named.groupBy("order_id").agg(F.min("customer_id").alias("home"))
    # guest orders go together with nothing
    numbers = number_ids(homes, "order_id", F.coalesce("home", "order_id"), "order-numbers")
    numbered = named.join(numbers, "order_id").select("customer_id", "n")
    if groups is not None:
        numbered = stage(numbered, "customer-orders")
    sets = bitmap_sets(links.join(numbered, "customer_id"), ["segment_id"])
    if groups is not None:
        guests = numbered.filter(F.col("customer_id").isNull()).withColumn("kind", F.lit("guests"))
        other = numbered.join(loose, "customer_id", "left_semi").withColumn("kind", F.lit("loose"))
        shared = stage(bitmap_sets(guests.unionByName(other), ["kind"]), "shared-orders")
        handed = spread_join(shared, groups, "kind").select("segment_id", "bucket", "bits")
        sets = sets.unionByName(handed)
    return set_sizes(sets, ["segment_id"], "total_orders")


def segment_purchase_stats(
    membership: DataFrame,
    customers: DataFrame,
    orders: DataFrame,
    order_has_one_customer: bool = False,
    null_keys: str = "sql",
) -> DataFrame:
    """Distinct members and orders, revenue and mean order value per segment.

    Everything is summed up before it meets: orders per customer, these per
    profile, members per segment and profile. Distinct orders are bitmaps of order
    numbers, so no row of a segment and an order is moved; an order with two
    customers counts once. Where an order is known to belong to one customer,
    ``order_has_one_customer=True`` adds up counts per customer instead.

    With ``null_keys="match"`` a member without a customer meets every order
    without one, and members without a profile meet all customers without one, as
    in joins in which null keys are equal. What the nulls of a side stand for is
    one row there, so no pairs arise.
    """
    match = null_keys == "match"
    members = collapse(membership.filter(F.col("segment_id").isNotNull()), ["segment_id", "profile_id"])
    members = stage(members, "members")
    owners = stage(collapse(customers, ["profile_id", "customer_id"]), "owners")
    revenue = F.coalesce(F.sum("current_total_price"), F.lit(0.0)).alias("revenue")
    per_customer = orders.groupBy("customer_id").agg(revenue).withColumn("weight", F.lit(1).cast("bigint"))
    per_profile = (
        weighted_join(owners, per_customer, "customer_id", null_keys)
        .groupBy("profile_id")
        .agg(
            F.coalesce(F.sum(F.col("revenue") * F.col("weight")), F.lit(0.0)).alias("revenue"),
            F.bool_or(F.col("customer_id").isNull()).alias("guest"),
        )
        .withColumns({"weight": F.lit(1).cast("bigint"), "matched": F.lit(True)})
    )
    seen = weighted_join(members, per_profile, "profile_id", null_keys)
    if match:
        guests = orders.filter(F.col("customer_id").isNull()).agg(revenue).scalar()
        seen = seen.withColumn("revenue", F.when(F.col("matched"), F.col("revenue")).otherwise(guests))
    unmatched = F.coalesce(F.col("guest"), F.lit(True))
    stats = seen.groupBy("segment_id").agg(
        F.count("profile_id").alias("total_customers"),
        F.coalesce(F.sum(F.col("revenue") * F.col("weight")), F.lit(0.0)).alias("total_order_revenue"),
        F.bool_or(unmatched).alias("guests"),
        F.bool_or(F.col("profile_id").isNull() & F.col("matched")).alias("loose"),
    )
    if match:
        stats = stage(stats, "segment-revenue")
    # rows with a null on either side are not links but groups
    links = members.join(owners.filter(F.col("customer_id").isNotNull()), "profile_id").select(
        "segment_id", "customer_id"
    )
    loose = owners.filter(F.col("profile_id").isNull() & F.col("customer_id").isNotNull()).select("customer_id")
    if order_has_one_customer and not match:
        counts = orders.groupBy("customer_id").agg(F.count_distinct("order_id").alias("n"))
        counted = links.distinct().join(counts, "customer_id").groupBy("segment_id")
        counted = counted.agg(F.sum("n").alias("total_orders"))
    else:
        kinds = F.array_compact(F.array(*[F.when(F.col(k), F.lit(k)) for k in ("guests", "loose")]))
        groups = stats.select("segment_id", F.explode(kinds).alias("kind")) if match else None
        counted = _order_sets(orders, links, groups, loose)
    return stats.join(counted, "segment_id", "left").withColumn(
        "total_orders", F.coalesce("total_orders", F.lit(0))
    ).select(
        "segment_id",
        "total_customers",
        "total_orders",
        "total_order_revenue",
        ratio(F.col("total_order_revenue"), F.col("total_orders")).alias("avg_order_value"),
    )


def segment_features(
    segments: DataFrame,
    membership: DataFrame,
    campaigns: DataFrame,
    customers: DataFrame,
    orders: DataFrame,
    customer_features: DataFrame,
    null_keys: str = "sql",
) -> DataFrame:
    """Segments with campaign totals, send-time shares and purchase statistics."""
    send_time = segment_send_time(membership, customer_features)
    wide = join_tables(segments, campaign_stats(campaigns), "segment_name", null_keys="sql")
    wide = join_tables(wide, send_time, "segment_id", null_keys="sql")
    wide = join_tables(
        wide,
        segment_purchase_stats(membership, customers, orders, null_keys=null_keys),
        "segment_id",
        null_keys="sql",
    )
    shares = [c for c in send_time.columns if "_pct_" in c]
    return wide.withColumns(
        {
            **{c: F.coalesce(c, F.lit(0.0)) for c in shares},
            **{c: F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in COUNT_COLUMNS},
        }
    )


def event_only_segment(
    orders: DataFrame,
    customers: DataFrame,
    start: datetime = SALE_START,
    end: datetime = SALE_END,
) -> DataFrame:
    """Customers with a profile whose orders all lie in the event window.

    The window is closed and ends at the given moment. Its first order being
    inside follows from all orders being inside.
    """
    consented = customers.filter(F.col("profile_id").isNotNull()).select("customer_id")
    inside = within(F.col("created_at"), start, end)
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("created_at").alias("first_order_date"), F.bool_and(inside).alias("all_inside"))
        .filter(F.col("all_inside"))
        .join(consented, "customer_id", "left_semi")
        .select("customer_id", "first_order_date")
    )
