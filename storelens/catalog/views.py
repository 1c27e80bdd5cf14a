"""The retail tables as views over the given tables.

The given tables are TPC-H-like; each view derives one retail table from
them. The text is plain SQL that Spark and other engines read alike, so that
the queries and the SQL they are compared with start from the same input.
``{name}`` refers to another view or a given table, ``{ts}`` begins a
timestamp literal.
"""

from __future__ import annotations

import string
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators.ordering import row_numbers

AS_OF = datetime(2001, 8, 1, 12)

GIVEN = ("customer", "part", "orders", "lineitem", "events")

_STATES = "CANYTXAZWAFLILCOORGAMIUTNVOHTNPAIDNCMOMAWIVAAKHIZZ"

VIEWS: dict[str, str] = {
    "order_lines": """
        select concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string)) as line_item_id,
               cast(l_orderkey as string) as order_id, cast(l_partkey as string) as variant_id,
               cast(l_quantity as int) as quantity, floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 as variant_price,
               l_shipdate as created_at
        from {lineitem}""",
    "s_orders": """
        select cast(o_orderkey as string) as order_id,
               case when o_orderkey % 20 = 0 then null else cast(o_custkey as string) end as customer_id,
               o_orderdate + interval '1' hour * cast((o_orderkey * 7 + o_custkey) % 24 as int) as created_at,
               o_totalprice as current_total_price, o_orderpriority as channel_name,
               cast(null as string) as discount_codes
        from {orders}""",
    "variants": """
        select cast(p_partkey as string) as variant_id,
               cast(cast(floor(p_partkey / 5.0) as bigint) as string) as product_id,
               case when p_partkey % 97 = 0 then null else concat('SKU-', cast(p_partkey as string)) end as sku,
               p_retailprice as price,
               case p_size % 4 when 0 then null when 1 then p_retailprice when 2 then floor(p_retailprice * 1.15 * 100 + 0.5) / 100 else floor(p_retailprice * 1.6 * 100 + 0.5) / 100 end as compare_at_price
        from {part}""",
    "master_sku": """
        select concat('SKU-', cast(p_partkey as string)) as sku, floor(p_retailprice * 1.1 * 100 + 0.5) / 100 as ec,
               case when p_partkey % 31 = 0 then null else floor(p_retailprice * 0.35 * 100 + 0.5) / 100 end as unit_cost,
               case when p_type in ('STANDARD', 'PROMO', 'ECONOMY') then 'CLOTHING' when p_type in ('MEDIUM', 'SMALL') then 'JEWELRY' else 'OTHER' end as category_group
        from {part} where p_partkey % 10 <> 9""",
    "shopify_listings": """
        select cast(cast(floor(p_partkey / 5.0) as bigint) as string) as product_id,
               concat('p-', cast(p_partkey as string)) as handle,
               concat(p_name, ' ', p_brand) as title, p_type as product_type,
               case when p_partkey % 35 = 0 then 'DRAFT' else 'ACTIVE' end as status,
               case p_size % 5 when 0 then 'New' when 1 then 'Best Seller' else null end as badge,
               {ts} '2001-08-01 00:00:00' - interval '1' day * cast(p_size * 3 as int) as published_at
        from {part} where p_partkey % 5 = 0""",
    "snapshot_days": """
        select distinct l_shipdate as snapshot_date from {lineitem}
        where l_shipdate <= {ts} '2001-08-01 00:00:00'
          and (l_shipdate > {ts} '2001-06-25 00:00:00' or day(l_shipdate) = 1 and month(l_shipdate) % 6 = 1)""",
    "stock_daily": """
        select concat('SKU-', cast(p_partkey as string)) as internal_reference, d.snapshot_date,
               case when (p_partkey * 13 + day(d.snapshot_date) * 7) % 40 > 3 then 'True' else 'False' end as in_stock,
               cast((p_partkey * 13 + day(d.snapshot_date) * 7) % 40 as double) as free_qty
        from {part} cross join {snapshot_days} d where p_partkey % 23 <> 0""",
    "shopify_customers": f"""
        select cast(c_custkey as string) as customer_id,
               case when c_custkey % 50 = 0 then null else concat('User', cast(c_custkey as string), '@Example.com') end as email,
               case when c_custkey % 11 = 0 then 'California' when c_custkey % 7 = 0 then lower(substring('{_STATES}', c_nationkey * 2 + 1, 2)) else substring('{_STATES}', c_nationkey * 2 + 1, 2) end as default_address_province,
               {{ts}} '2001-08-01 00:00:00' - interval '1' day * cast(c_custkey % 400 as int) as updated_at
        from {{customer}}""",
    "profiles": """
        select distinct concat('P', cast(user_id as string)) as profile_id,
               case when user_id % 40 = 0 then null else concat(' user', cast(user_id as string), '@example.com ') end as email
        from {events}""",
    "segments": """
        select distinct concat('S-', event_type) as segment_id, event_type as segment_name from {events}""",
    "segment_membership": """
        select concat('P', cast(user_id as string)) as profile_id, concat('S-', event_type) as segment_id
        from {events} group by user_id, event_type having count(*) % 3 <> 0""",
    "campaigns": """
        select concat(event_type, '-', cast(cast(ts as date) as string)) as campaign_id,
               concat(event_type, ' of ', cast(cast(ts as date) as string)) as campaign_name,
               concat('News on ', event_type) as subject, event_type as list,
               cast(cast(ts as date) as {ts}) as send_time, count(*) as total_recipients,
               count(distinct user_id) as unique_opens,
               cast(count(distinct user_id) as double) / count(*) as open_rate,
               count(distinct case when value > 20 then user_id end) as unique_clicks,
               cast(count(distinct case when value > 20 then user_id end) as double) / count(*) as click_rate,
               cast(sum(case when event_id % 17 = 0 then 1 else 0 end) as bigint) as unsubscribes,
               avg(case when event_id % 29 = 0 then 1.0e0 when event_id % 7 = 0 then null else 0.0e0 end) as spam_complaints_rate,
               avg(case when event_id % 13 = 0 then 1.0e0 else 0.0e0 end) as bounce_rate,
               sum(value) as revenue
        from {events} group by event_type, cast(ts as date)""",
    "searchspring_collection": """
        select p_type as collection,
               row_number() over (partition by p_type order by (p_partkey * 7919) % 1009, p_partkey) as position,
               case when p_partkey % 65 = 0 then concat('missing ', p_name) else concat(p_name, ' ', p_brand) end as name,
               p_retailprice as price
        from {part} where p_partkey % 5 = 0""",
    "listing_tags": """
        select product_id, product_type as tag from {shopify_listings}
        union all
        select product_id, coalesce(badge, 'Plain') as tag from {shopify_listings}
        union all
        select product_id, 'Sale' as tag from {variants} where compare_at_price > price""",
    "master_rows": """
        select p_partkey * 2 as row_no,
               concat('par-', cast(cast(floor(p_partkey / 4.0) as bigint) as string), ' ') as sku_parent,
               case when p_partkey % 41 = 0 then 'n/a' else case p_partkey % 4 when 0 then 'SM' when 1 then 'm ' when 2 then 'LXL' else 'OSFM' end end as size_abbreviation,
               case when p_partkey % 113 = 0 then concat('hic-', cast(p_partkey as string)) else concat(' sku-', cast(p_partkey as string)) end as sku,
               case when p_partkey % 5 = 0 then ' ' else concat('0', cast(p_partkey as string)) end as upc,
               case when p_brand = 'Brand#7' then 'Harem Pants' else 'Core' end as collection,
               case when p_size = 50 then 'Exclusive' else '' end as season,
               case when p_size = 49 then 'EXCLUSIVE ' else 'Active' end as faho24_status
        from {part}
        union all
        select p_partkey * 2 + 1 as row_no,
               concat('PAR-', cast(cast(floor(p_partkey / 4.0) as bigint) as string)) as sku_parent,
               case p_partkey % 4 when 0 then 'S' when 1 then 'M' when 2 then 'L' else 'OSFM' end as size_abbreviation,
               concat('SKU-', cast(p_partkey as string), '-B') as sku,
               concat('9', cast(p_partkey as string)) as upc, 'CORE' as collection, '' as season,
               'ACTIVE' as faho24_status
        from {part} where p_partkey % 6 < 2""",
    "variant_export": """
        select p_partkey as row_no,
               case when p_partkey % 2 = 0 then concat('sku-', cast(p_partkey as string), ' ') else concat('SKU-', cast(p_partkey as string)) end as internal_reference,
               case when p_partkey % 6 = 0 then '' else concat('EXT-', cast(p_partkey as string)) end as id
        from {part} where p_partkey % 7 <> 0
        union all
        select p_partkey + 1000000000 as row_no, concat('SKU-', cast(p_partkey as string)) as internal_reference,
               concat('LATE-', cast(p_partkey as string), ' ') as id
        from {part} where p_partkey % 9 = 0
        union all
        select p_partkey + 2000000000 as row_no, concat('SKU-', cast(p_partkey as string), '-B') as internal_reference,
               concat('EXTB-', cast(p_partkey as string)) as id
        from {part} where p_partkey % 12 = 1""",
    "contacts": """
        select c_custkey as row_no, cast(c_custkey as string) as id,
               case c_custkey % 4 when 0 then c_name when 1 then concat(upper(c_name), '!') when 2 then concat(c_name, ' Store') else concat('x', cast(c_custkey as string)) end as name,
               case when c_custkey % 3 = 0 then 'True' else 'False' end as is_a_company
        from {customer}
        union all
        select c_custkey + 1000000000 as row_no, concat('B', cast(c_custkey as string)) as id,
               case c_custkey % 5 when 0 then c_name when 1 then concat('The ', c_name, ' Shop') else concat(c_name, ' & Sons') end as name,
               case when c_custkey % 2 = 0 then 'True' else 'False' end as is_a_company
        from {customer} where c_custkey % 5 < 3""",
    "order_sheet": """
        select concat(case o_orderkey % 3 when 0 then 'AK' when 1 then 'jc1' else 'ZZ' end, '-1.csv') as file,
               o_orderkey * 10 + ln as row_no, case when ln = 1 then c_name else '' end as customer,
               concat('PAR-', cast(cast(floor(pk / 4.0) as bigint) as string)) as parent_sku,
               case o_orderkey % 6 when 0 then 'ASAP' when 1 then '3/15' when 2 then '4/1 apparel' when 3 then '2/30' when 4 then '12-24-01' else '' end as ship_date,
               case when pk % 3 = 0 then concat('note ', cast(pk as string)) else '' end as rep_notes,
               cast(q % 3 as string) as s, cast(q % 4 as string) as m, cast(q % 5 as string) as l,
               case when q % 7 = 0 then '1,000' else '' end as osfm
        from (select l_orderkey,
                     row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as ln,
                     l_partkey as pk, cast(l_quantity as bigint) as q
              from {lineitem}) x
        join {orders} on o_orderkey = l_orderkey join {customer} on c_custkey = o_custkey""",
    "raw_cells": """
        select concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string), cast(l_extendedprice as string)) as cell_id,
               case l_partkey % 9 when 0 then concat(' part ', cast(l_partkey as string), ' ') when 1 then '' when 2 then 'NULL' when 3 then 'N/A' when 4 then 'None' when 5 then ' NULL ' when 6 then '  ' when 7 then null else concat('part ', cast(l_partkey as string)) end as text_cell,
               case l_partkey % 9 when 0 then concat('1,', cast(100 + l_partkey % 900 as string)) when 1 then concat(cast(l_linenumber as string), '%') when 2 then concat('-', cast(l_linenumber as string), '.9') when 3 then '1e3' when 4 then 'x' when 5 then '1d' when 6 then 'N/A' when 7 then concat(' ', cast(l_partkey as string), ' ') else 'nan' end as int_cell,
               case l_partkey % 6 when 0 then concat('$1,', cast(100 + l_partkey % 900 as string), '.50') when 1 then 'n/a' when 2 then concat('.', cast(l_linenumber as string)) when 3 then '1_000' when 4 then null else concat('-$', cast(l_partkey as string)) end as float_cell,
               case l_partkey % 5 when 0 then concat(cast(l_linenumber as string), '2.5%') when 1 then '0.05' when 2 then 'None' when 3 then '12,5%' else concat(' ', cast(l_linenumber as string), ' % ') end as percent_cell,
               case l_partkey % 6 when 0 then cast(cast(l_shipdate as date) as string) when 1 then concat(cast(cast(l_shipdate as date) as string), ' 13:45:10') when 2 then concat(cast(month(l_shipdate) as string), '/', cast(day(l_shipdate) as string), '/', cast(year(l_shipdate) as string)) when 3 then 'soon' when 4 then 'NULL' else concat(cast(cast(l_shipdate as date) as string), 'T08:30:00') end as datetime_cell,
               case l_partkey % 11 when 0 then 'ASAP' when 1 then ' asap ' when 2 then concat(cast(month(l_shipdate) as string), '/', cast(day(l_shipdate) as string)) when 3 then concat(cast(month(l_shipdate) as string), '-', cast(day(l_shipdate) as string), '-0', cast(l_linenumber as string)) when 4 then concat('by ', cast(month(l_shipdate) as string), '/', cast(day(l_shipdate) as string), '/', cast(year(l_shipdate) as string), ' please') when 5 then '2/30' when 6 then concat(cast(month(l_shipdate) as string), '/', cast(day(l_shipdate) + 9 as string), ' apparel') when 7 then 'soon' when 8 then '13/5' when 9 then concat(cast(month(l_shipdate) as string), '/', cast(day(l_shipdate) as string), '/7', cast(l_linenumber as string)) else '' end as ship_cell
        from {lineitem}""",
}


def _names_in(text: str) -> list[str]:
    found = [name for _, name, _, _ in string.Formatter().parse(text) if name]
    return [n for n in dict.fromkeys(found) if n != "ts"]


def sql_of(name: str) -> str:
    """The text of a view for an engine in which all tables exist by name."""
    refs = {n: n for n in _names_in(VIEWS[name])}
    return VIEWS[name].format(ts="timestamp", **refs)


class RetailTables:
    """The retail tables of one folder of given tables, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEWS and name not in GIVEN:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def _load(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name == "stock_daily":
            return self._stock_daily()
        if name == "searchspring_collection":
            return self._searchspring_collection()
        if name == "order_sheet":
            return self._order_sheet()
        refs = {n: getattr(self, n) for n in _names_in(VIEWS[name])}
        return self.spark.sql(VIEWS[name].replace("{ts}", "timestamp_ntz"), **refs)

    def _stock_daily(self) -> DataFrame:
        """Every product on every snapshot day: the last weeks, and two days of every
        year before. They come as one array, so no join of the two tables is needed."""
        days = self.snapshot_days.agg(F.collect_set("snapshot_date")).scalar()
        day = F.col("snapshot_date")
        amount = (F.col("p_partkey") * 13 + F.dayofmonth(day) * 7) % 40
        return (
            self.part.filter(F.col("p_partkey") % 23 != 0)
            .withColumn("snapshot_date", F.explode(days))
            .select(
                F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias(
                    "internal_reference"
                ),
                day,
                F.when(amount > 3, "True").otherwise("False").alias("in_stock"),
                amount.cast("double").alias("free_qty"),
            )
        )

    def _order_sheet(self) -> DataFrame:
        """The view's text with orders meeting their customers first: joined after the
        lines, a customer table too large to broadcast has all lines moved once more.
        Prices stay out: they decide between lines that are alike in all that is shown."""
        named = self.orders.join(self.customer, F.col("c_custkey") == F.col("o_custkey")).select(
            "o_orderkey", "o_custkey", F.col("c_name").alias("name")
        )
        text = VIEWS["order_sheet"].replace(" join {customer} on c_custkey = o_custkey", "")
        text = text.replace("c_name", "name").replace(", l_extendedprice)", ")")
        return self.spark.sql(text, lineitem=self.lineitem, orders=named)

    def _searchspring_collection(self) -> DataFrame:
        """Ranked products of every type; no task numbers a whole type."""
        key = F.col("p_partkey")
        ranked = row_numbers(
            self.part.filter(key % 5 == 0).withColumn("bucket", (key * 7919) % 1009),
            ["p_type"],
            "bucket",
            [key],
            "position",
        )
        listed = F.concat("p_name", F.lit(" "), "p_brand")
        missing = F.concat(F.lit("missing "), "p_name")
        return ranked.select(
            F.col("p_type").alias("collection"),
            "position",
            F.when(key % 65 == 0, missing).otherwise(listed).alias("name"),
            F.col("p_retailprice").alias("price"),
        )
