"""Table registry: declared columns and their logical types.

Fixed values: the column names, their order and their logical types are the
data contract of the source systems.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, FLOAT, PERCENT, DATETIME = "string", "int", "float", "percent", "datetime"

SPARK_TYPES: dict[str, T.DataType] = {
    STRING: T.StringType(),
    INT: T.LongType(),
    FLOAT: T.DoubleType(),
    PERCENT: T.DoubleType(),
    DATETIME: T.TimestampNTZType(),
}


TABLES: dict[str, dict[str, str]] = {
    "campaigns": {
        "campaign_id": STRING,
        "campaign_name": STRING,
        "tags": STRING,
        "subject": STRING,
        "list": STRING,
        "send_time": DATETIME,
        "send_weekday": STRING,
        "total_recipients": INT,
        "unique_placed_order": INT,
        "placed_order_rate": PERCENT,
        "revenue": FLOAT,
        "unique_opens": INT,
        "open_rate": PERCENT,
        "total_opens": INT,
        "unique_clicks": INT,
        "click_rate": PERCENT,
        "total_clicks": INT,
        "unsubscribes": INT,
        "spam_complaints": INT,
        "spam_complaints_rate": PERCENT,
        "successful_deliveries": INT,
        "bounces": INT,
        "bounce_rate": PERCENT,
        "campaign_channel": STRING,
    },
    "shopify_listings": {
        "product_id": STRING,
        "handle": STRING,
        "title": STRING,
        "product_type": STRING,
        "status": STRING,
        "badge": STRING,
        "created_at": DATETIME,
        "updated_at": DATETIME,
        "published_at": DATETIME,
    },
    "segments": {
        "segment_id": STRING,
        "segment_name": STRING,
    },
    "segment_membership": {
        "profile_id": STRING,
        "segment_id": STRING,
    },
    "profiles": {
        "profile_id": STRING,
        "email": STRING,
    },
    "orders": {
        "order_id": STRING,
        "customer_id": STRING,
        "created_at": DATETIME,
        "current_total_price": FLOAT,
        "channel_name": STRING,
        "discount_codes": STRING,
    },
    "order_lines": {
        "line_item_id": STRING,
        "order_id": STRING,
        "variant_id": STRING,
        "quantity": INT,
        "variant_price": FLOAT,
    },
    "variants": {
        "variant_id": STRING,
        "product_id": STRING,
        "sku": STRING,
        "price": FLOAT,
        "compare_at_price": FLOAT,
        "created_at": DATETIME,
        "updated_at": DATETIME,
    },
    "shopify_customers": {
        "customer_id": STRING,
        "email": STRING,
        "phone": STRING,
        "first_name": STRING,
        "last_name": STRING,
        "display_name": STRING,
        "verified_email": STRING,
        "created_at": DATETIME,
        "updated_at": DATETIME,
        "state": STRING,
        "number_of_orders": INT,
        "amount_spent": FLOAT,
        "amount_spent_currency": STRING,
        "last_order_id": STRING,
        "last_order_created_at": DATETIME,
        "default_address_country": STRING,
        "default_address_province": STRING,
        "default_address_city": STRING,
        "default_address_zip": STRING,
        "data_sale_opt_out": STRING,
    },
    "master_sku": {
        "date_added_to_ms": DATETIME,
        "date_last_adjusted": DATETIME,
        "expected_receive_date": DATETIME,
        "ws_ship_date": STRING,
        "release_month": STRING,
        "category_group": STRING,
        "category": STRING,
        "sub_category": STRING,
        "collection": STRING,
        "collection_status": STRING,
        "fabric_code": STRING,
        "sku_parent": STRING,
        "sku": STRING,
        "name": STRING,
        "season": STRING,
        "faho24_status": STRING,
        "spsu25_status": STRING,
        "faho25_status": STRING,
        "spsu26_status": STRING,
        "sold_by_info": STRING,
        "carded_non_carded": STRING,
        "card_properties": STRING,
        "properties": STRING,
        "stones": STRING,
        "color_group": STRING,
        "color": STRING,
        "pattern_parent": STRING,
        "cord_print_pattern": STRING,
        "clasp_type": STRING,
        "material": STRING,
        "length": STRING,
        "size": STRING,
        "size_abbreviation": STRING,
        "unit_cost": FLOAT,
        "ws": FLOAT,
        "ec": FLOAT,
        "weight_lbs": FLOAT,
        "upc": STRING,
        "min_qty": INT,
        "ws_sku": STRING,
        "ec_sku": STRING,
        "amazon_sku": STRING,
        "vendor": STRING,
        "bom_category": STRING,
        "yards_per_unit": FLOAT,
        "labor_cost": FLOAT,
        "card_sku": STRING,
        "prefix": STRING,
        "prepack_sku": STRING,
        "prepack_assortment_qty": INT,
        "available_sizes": STRING,
        "fabric_image_url": STRING,
        "item_image_url": STRING,
        "hts_code": STRING,
        "coming_in_tall": STRING,
        "advertised_sku_yn": STRING,
        "safety_stock_qty": INT,
        "drop_name": STRING,
        "metal_color": STRING,
        "rack": STRING,
    },
    "searchspring_collection": {
        "position": INT,
        "name": STRING,
        "price": FLOAT,
        "compare_at_price": FLOAT,
        "available": STRING,
    },
    "stock_daily": {
        "internal_reference": STRING,
        "snapshot_date": DATETIME,
        "in_stock": STRING,
        "free_qty": FLOAT,
        "outgoing_qty": FLOAT,
        "incoming_qty": FLOAT,
    },
}


def struct_type(table: str) -> T.StructType:
    """The Spark schema of a cleaned table."""
    return T.StructType(
        [T.StructField(name, SPARK_TYPES[kind], True) for name, kind in TABLES[table].items()]
    )
