"""Queries on sources and cell cleaning."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.catalog.registry import Catalog
from storelens.catalog.views import RetailTables
from storelens.functions import casts
from storelens.operators.ordering import row_numbers
from storelens.operators.cleaning import normalize_headers, process_table
from storelens.session import shared_dir
from storelens.sources import files, pages, warehouse
from storelens.sources.extract import run_extracts

SINCE = datetime(2001, 7, 2)
CAST_CELLS = {
    "string": ("text_cell", casts.to_string),
    "int": ("int_cell", casts.to_int),
    "float": ("float_cell", casts.to_float),
    "percent": ("percent_cell", casts.to_percent),
    "datetime": ("datetime_cell", casts.to_datetime),
}


def _json_pages(rows: DataFrame, keys: list[str], field: str, item, more) -> DataFrame:
    """Pages as an API would have landed them: items of a page in item order, and
    what the body says about further pages."""
    listed = F.array_sort(F.collect_list(item))
    return (
        rows.groupBy(*keys)
        .agg(listed.alias(field), F.first(more).alias("more"))
        .select(*keys, F.to_json(F.struct(field, "more.*")).alias("body"))
    )


def _next_link(page, pages):
    """The link of a page to the next one; the last page has none."""
    link = F.when(page < pages, F.concat(F.lit("https://api.example/items?cursor="), page + 1))
    return F.struct(F.struct(link.alias("next")).alias("links"))


def segment_pages(t: RetailTables) -> DataFrame:
    """One segment a page, by name."""
    rows = t.events.groupBy("event_type").agg(
        F.min("ts").alias("created"), F.max("ts").alias("updated")
    )
    names = t.events.agg(F.array_sort(F.collect_set("event_type"))).scalar()
    moment = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    item = F.struct(
        F.concat(F.lit("S-"), "event_type").alias("id"),
        F.struct(
            F.col("event_type").alias("name"),
            moment("created").alias("created"),
            moment("updated").alias("updated"),
        ).alias("attributes"),
    )
    paged = rows.withColumn("page", F.array_position(names, F.col("event_type")))
    return _json_pages(paged, ["page"], "data", item, _next_link(F.col("page"), F.size(names)))


def profile_pages(t: RetailTables) -> DataFrame:
    """Members of a segment on pages of at most 50; the email differs by segment."""
    rows = t.events.groupBy("event_type", "user_id").agg(F.max("ts").alias("joined"))
    item = F.struct(
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("id"),
        F.date_format("joined", "yyyy-MM-dd'T'HH:mm:ss").alias("joined_group_at"),
        F.struct(
            F.concat(
                F.lit("u"), F.col("user_id").cast("string"), F.lit("@"), "event_type"
            ).alias("email")
        ).alias("attributes"),
    )
    placed = rows.withColumn("bucket", F.floor(F.col("user_id") / 1000))
    placed = row_numbers(placed, ["event_type"], "bucket", [F.col("user_id")], "nth")
    sizes = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("size"))
    paged = placed.join(sizes, "event_type").select(
        F.concat(F.lit("S-"), "event_type").alias("segment_id"),
        F.ceil(F.col("nth") / 50).alias("page"),
        F.ceil(F.col("size") / 50).alias("pages"),
        "event_type",
        "user_id",
        "joined",
    )
    link = _next_link(F.col("page"), F.col("pages"))
    return _json_pages(paged, ["segment_id", "page"], "data", item, link)


def search_pages(t: RetailTables, per_page: int = 100) -> DataFrame:
    """Collections on pages of at most so many products."""
    item = F.struct(
        "position",
        "name",
        "price",
        (F.col("price") * 2).alias("msrp"),
        (F.col("position") % 2).cast("string").alias("ss_available"),
    )
    products = t.searchspring_collection
    sizes = products.groupBy("collection").agg(F.count(F.lit(1)).alias("size"))
    paged = products.join(sizes, "collection").withColumn("page", F.ceil(F.col("position") / per_page))
    total = F.struct(F.ceil(F.col("size") / per_page).alias("totalPages"))
    return _json_pages(paged, ["collection", "page"], "results", item, F.struct(total.alias("pagination")))


def damaged_pages(t: RetailTables) -> DataFrame:
    """Search pages of five products, of which some are missing, cut off in the
    middle, landed twice, or an error message; of some pulls the end is missing."""
    page, body = F.col("page"), F.col("body")
    total = F.get_json_object(body, "$.pagination.totalPages").cast("bigint")
    last_is_lost = (page == total) & (F.length("collection") % 2 == 0)
    kept = search_pages(t, 5).filter((page % 7 != 3) & ~last_is_lost)
    text = (
        F.when(page % 11 == 5, F.expr("left(body, length(body) - 10)"))
        .when(page % 17 == 8, F.lit('{"errors": ["too many requests"]}'))
        .otherwise(body)
    )
    copies = F.when(page % 13 == 6, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return kept.select("collection", "page", text.alias("body"), F.explode(copies).alias("copy")).drop("copy")


def master_csv(t: RetailTables) -> DataFrame:
    path = shared_dir(t.spark, "master")
    raw = t.part.select(
        F.concat(F.lit("Café "), "p_name").alias("Name"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("SKU"),
        F.concat(F.lit("$"), F.col("p_retailprice").cast("string")).alias("EC"),
        F.col("p_type").alias(" Category-Group "),
        F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("Min. Qty"),
        F.lit("dropped").alias("Other"),
    )
    raw.write.csv(path, header=True, encoding=files.MASTER_ENCODING)
    return files.read_master_csv(t.spark, path)


def mixed_encodings(t: RetailTables) -> DataFrame:
    """The same columns written in two encodings into one folder, read back.

    The byte 80 makes a file a windows file, in which it means the euro sign.
    """
    path = shared_dir(t.spark, "encodings")
    rows = t.part.select(
        F.col("p_partkey").cast("string").alias("key"),
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("naïve "), "p_name"))
        .when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit('\n"é", ok')))
        .when(F.col("p_partkey") % 2 == 1, F.concat(F.lit("\u0080 "), "p_name"))
        .otherwise(F.lit(""))
        .alias("cell"),
        (F.col("p_partkey") % 2).alias("kind"),
    )
    for kind, encoding in ((0, files.UTF_8), (1, files.LATIN_1)):
        part = rows.filter(F.col("kind") == kind).drop("kind")
        part.write.mode("append").csv(path, header=True, encoding=encoding, escape='"')
    return files.read_text_csvs(t.spark, path).select("key", "cell")


def round_trip(t: RetailTables) -> DataFrame:
    path = shared_dir(t.spark, "table")
    files.write_table(t.shopify_listings, path, partition_by="status")
    return files.read_table(t.spark, path)


def extract_counts(t: RetailTables) -> DataFrame:
    extracts = {
        "shopify_customers": lambda: t.shopify_customers,
        "shopify_orders": lambda: warehouse.since(t.s_orders, "created_at", SINCE),
        "shopify_order_lines": lambda: warehouse.since(t.order_lines, "created_at", SINCE),
        "shopify_variants": lambda: t.variants,
        "shopify_listings": lambda: t.shopify_listings,
        "collections": lambda: t.searchspring_collection,
    }
    folder = shared_dir(t.spark, "extracts")
    return run_extracts(t.spark, extracts, folder, {"collections": "collection"})


def registered(t: RetailTables) -> DataFrame:
    """A stored table registered for SQL and queried by name."""
    path = shared_dir(t.spark, "campaigns")
    files.write_table(t.campaigns, path)
    name = f"campaigns_{os.path.basename(path).rpartition('-')[2]}"
    files.register(t.spark, name, path)
    return t.spark.sql(
        f"select list, count(*) as campaigns, max(send_time) as last_send from {name} group by list"
    )


def messy_lines(t: RetailTables) -> DataFrame:
    return t.raw_cells.select(
        F.col("int_cell").alias(" Quantity? "),
        F.col("cell_id").alias("Line Item-ID"),
        F.col("text_cell").alias("Order/ID"),
        F.col("text_cell").alias("Variant  ID."),
        F.col("float_cell").alias("Variant Price ($)"),
        F.col("ship_cell").alias("Notes, internal"),
    )


def register(c: Catalog) -> None:
    # The tokens for null, as SQL.
    def kept(x: str) -> str:
        return f"case when {x} in ('', 'NULL', 'N/A', 'None') then null else {x} end"

    def number(x: str) -> str:
        pattern = r"\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"
        return f"case when regexp_full_match({x}, '{pattern}') then try_cast(trim({x}) as double) end"

    def less(x: str, *drop: str) -> str:
        for character in drop:
            x = f"replace({x}, '{character}', '')"
        return x

    sql_casts = {
        "string": lambda x: f"trim({kept(x)})",
        "int": lambda x: f"cast(trunc({number(less(kept(x), ',', '%'))}) as bigint)",
        "float": lambda x: number(less(kept(x), ",", "$")),
        "percent": lambda x: f"{number(less(kept(x), '%'))} / 100",
        "datetime": lambda x: (
            f"coalesce(try_cast({kept(x)} as timestamp), try_strptime({kept(x)}, '%m/%d/%Y'))"
        ),
    }
    for kind, (cell, cast) in CAST_CELLS.items():
        c.add(
            f"cast_{kind}",
            lambda t, cell=cell, cast=cast: t.raw_cells.select(
                "cell_id", cell, cast(F.col(cell)).alias("value")
            ),
            f"select cell_id, {cell}, {sql_casts[kind](cell)} as value from raw_cells",
        )
    c.add(
        "normalize_headers",
        lambda t: normalize_headers(
            t.lineitem.select(
                F.col("l_orderkey").alias(" Order-Key\n"),
                F.col("l_discount").alias("Open Rate (%)"),
                F.col("l_extendedprice").alias("  $ Sales/Qty # "),
                F.col("l_tax").alias("A - B?"),
            )
        ),
        """select l_orderkey as order_key, l_discount as "open_rate_%", l_extendedprice as sales_qty, l_tax as a_b from lineitem""",
    )
    c.add(
        "process_table",
        lambda t: process_table(messy_lines(t), "order_lines"),
        f"""select {sql_casts['string']('cell_id')} as line_item_id, {sql_casts['string']('text_cell')} as order_id,
                   {sql_casts['string']('text_cell')} as variant_id, {sql_casts['int']('int_cell')} as quantity,
                   {sql_casts['float']('float_cell')} as variant_price from raw_cells""",
    )
    at = f"timestamp '{SINCE}'"
    c.add(
        "scan_orders_since",
        lambda t: warehouse.scan_table(t.s_orders, "orders", SINCE),
        f"""select order_id, customer_id, created_at, current_total_price, channel_name, discount_codes
            from s_orders where created_at >= {at}""",
    )
    c.add(
        "scan_order_lines_since",
        lambda t: warehouse.scan_table(t.order_lines, "order_lines", SINCE),
        f"""select line_item_id, order_id, variant_id, cast(quantity as bigint) as quantity, variant_price
            from order_lines where created_at >= {at}""",
    )
    c.add(
        "scan_customers_since",
        lambda t: warehouse.scan_table(t.shopify_customers, "shopify_customers", SINCE),
        f"""select customer_id, email, updated_at, default_address_province from shopify_customers
            where updated_at >= {at}""",
    )
    c.add(
        "scan_stock_since",
        lambda t: warehouse.scan_table(t.stock_daily, "stock_daily", SINCE),
        f"""select internal_reference, snapshot_date, in_stock, free_qty from stock_daily
            where snapshot_date >= {at}""",
    )
    c.add(
        "scan_variants",
        lambda t: warehouse.scan_table(t.variants, "variants"),
        "select variant_id, product_id, sku, price, compare_at_price from variants",
    )
    c.add(
        "scan_listings",
        lambda t: warehouse.scan_table(t.shopify_listings, "shopify_listings"),
        "select product_id, handle, title, product_type, status, badge, published_at from shopify_listings",
    )
    c.add(
        "scan_listing_tags",
        lambda t: warehouse.scan_listing_tags(t.listing_tags),
        "select * from listing_tags",
    )
    c.add(
        "segments_from_pages",
        lambda t: pages.segments_from_pages(
            segment_pages(t),
            created_after=datetime(2023, 12, 31),
            created_before=datetime(2024, 1, 1, 0, 12),
            updated_after=datetime(2024, 1, 2),
        ),
        """select concat('S-', event_type) as segment_id, event_type as segment_name from events group by event_type
           having date_trunc('second', min(ts)) > timestamp '2023-12-31' and date_trunc('second', min(ts)) < timestamp '2024-01-01 00:12:00'
              and date_trunc('second', max(ts)) > timestamp '2024-01-02'""",
    )
    c.part(
        "page_items",
        """select concat('S-', event_type) as segment_id, concat('P', user_id) as profile_id, floor(user_id / 50) as page,
                  concat('u', user_id, '@', event_type) as email, date_trunc('second', max(ts)) as joined
           from events group by event_type, user_id""",
    )
    c.add(
        "profiles_dedup",
        lambda t: pages.profiles_from_pages(profile_pages(t)),
        """select profile_id, email from (
             select *, row_number() over (partition by profile_id order by segment_id, page) as nth from page_items) x where nth = 1""",
    )
    c.add(
        "segment_membership",
        lambda t: pages.membership_from_pages(profile_pages(t), datetime(2024, 1, 25)),
        "select profile_id, segment_id from page_items where joined > timestamp '2024-01-25'",
    )
    c.add(
        "collection_positions",
        lambda t: pages.collection_positions(search_pages(t)),
        """select collection, position, name, price, price * 2 as compare_at_price, cast(position % 2 as varchar) as available
           from searchspring_collection""",
    )
    c.part(
        "landed_pages",
        """select collection, page, max(page) over (partition by collection) as highest, total,
                  page % 11 = 5 as cut_off, page % 11 <> 5 and page % 17 = 8 as an_error, page % 13 = 6 as twice
           from (select distinct collection, cast(ceil(position / 5.0) as bigint) as page,
                        cast(ceil(max(position) over (partition by collection) / 5.0) as bigint) as total
                 from searchspring_collection) p
           where page % 7 <> 3 and not (page = total and length(collection) % 2 = 0)""",
    )
    c.add(
        "page_problems",
        lambda t: pages.page_problems(damaged_pages(t), pages.SEARCH_PAGES),
        """select collection, page, case when cut_off then 'unreadable' else 'no items' end as problem
           from landed_pages, (select unnest([1, 2]) as copy) where (cut_off or an_error) and (copy = 1 or twice)
           union all select collection, page, 'repeated' from landed_pages where twice
           union all
           select collection, page - 1, 'gap' from landed_pages l where page > 1
              and not exists (select 1 from landed_pages k where k.collection = l.collection and k.page = l.page - 1)
           union all
           select collection, page, 'cut' from landed_pages where page = highest and page < total and not (cut_off or an_error)""",
    )
    c.add(
        "positions_of_readable_pages",
        lambda t: pages.collection_positions(
            pages.readable_pages(damaged_pages(t).distinct(), pages.SEARCH_PAGES)
        ).select("collection", "position", "name"),
        """select s.collection, row_number() over (partition by s.collection order by s.position) as position, s.name
           from searchspring_collection s join landed_pages l
             on s.collection = l.collection and l.page = cast(ceil(s.position / 5.0) as bigint)
           where not (l.cut_off or l.an_error)""",
    )
    c.add(
        "read_master_csv",
        master_csv,
        """select concat('Café ', p_name) as name, concat('SKU-', p_partkey) as sku, p_retailprice as ec, p_type as category_group,
                  cast(p_size as bigint) as min_qty from part""",
    )
    c.add(
        "csv_encoding_choice",
        mixed_encodings,
        """select cast(p_partkey as varchar) as key,
                  case p_partkey % 3 when 0 then concat('naïve ', p_name) when 1 then concat(p_name, chr(10), '"é", ok')
                            else case when p_partkey % 2 = 1 then concat('€ ', p_name) else '' end end as cell
           from part""",
    )
    c.add("parquet_roundtrip", round_trip, "select * from shopify_listings")
    counts = " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {source}"
        for name, source in (
            ("shopify_customers", "shopify_customers"),
            ("shopify_orders", f"s_orders where created_at >= {at}"),
            ("shopify_order_lines", f"order_lines where created_at >= {at}"),
            ("shopify_variants", "variants"),
            ("shopify_listings", "shopify_listings"),
            ("collections", "searchspring_collection"),
        )
    )
    c.add("extract_row_counts", extract_counts, counts)
    c.add(
        "registered_table",
        registered,
        "select list, count(*) as campaigns, max(send_time) as last_send from campaigns group by list",
    )
