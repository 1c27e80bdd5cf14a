"""Warehouse tables with an optional lower time bound."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.dates import ts
from storelens.operators.cleaning import process_table
from storelens.sources.dated import day_column, with_day

# Warehouse table, registry table and the column an incremental
# pull is bounded on (None: always read whole).
WAREHOUSE_TABLES = {
    "shopify_customers": ("raw_shopify_customers", "updated_at"),
    "orders": ("raw_shopify_orders", "created_at"),
    "order_lines": ("raw_shopify_order_lines", "created_at"),
    "shopify_listings": ("raw_shopify_products", None),
    "variants": ("raw_shopify_variants", None),
    "stock_daily": ("stock_daily", "snapshot_date"),
}
TAGS_TABLE = "shopify_product_tags"


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """A landed table; files partitioned by date are pruned by the bound."""
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 32,
    **options: str,
) -> DataFrame:
    """A warehouse table over JDBC, split into ranges of a column when one is given.

    Filters on the result are pushed into the database. Credentials come in
    through ``options``.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.options(**options).load()


def since(df: DataFrame, column: str | None, bound: datetime | None) -> DataFrame:
    """Rows at or after the bound. Filters the raw column, before any cast,
    so that the bound reaches the scan."""
    if column is None or bound is None:
        return df
    return df.filter(F.col(column) >= ts(bound))


def scan_table(
    raw: DataFrame, table: str, bound: datetime | None = None, by_day: bool = False
) -> DataFrame:
    """A cleaned warehouse table, optionally from a moment on.

    The bounded column need not be part of the cleaned table. ``by_day`` adds its
    day, which a table is stored by.
    """
    _, column = WAREHOUSE_TABLES[table]
    rows = since(raw, column, bound)
    if by_day:
        return process_table(with_day(rows, column), table, keep=(day_column(column),))
    return process_table(rows, table)


def scan_listing_tags(raw: DataFrame) -> DataFrame:
    """Product tags as stored; no schema applies."""
    return raw
