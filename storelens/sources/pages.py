"""Landed API pages: one row per page with its JSON body.

A page table has ``page`` (its number within the pull), ``body`` and the keys of
the pull. Whether a pull is complete shows in its pages: their numbers have no
gap, each but the last says that there are more, and every body can be read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.casts import to_datetime
from storelens.functions.dates import ts
from storelens.operators.cleaning import process_table
from storelens.operators.joins import spread_join
from storelens.operators.ordering import keep_first, running_position

SEGMENT_PAGE = (
    "struct<data: array<struct<id: string, attributes: "
    "struct<name: string, created: string, updated: string>>>>"
)
PROFILE_PAGE = (
    "struct<data: array<struct<id: string, joined_group_at: string, "
    "attributes: struct<email: string>>>>"
)
SEARCH_PAGE = (
    "struct<results: array<struct<name: string, price: string, msrp: string, "
    "ss_available: string>>>"
)


LINKS = "links: struct<next: string>"
TOTAL_PAGES = "pagination: struct<totalPages: bigint>"
CORRUPT = "__corrupt"


@dataclass(frozen=True)
class PageKind:
    """What pages of one API look like: keys of a pull, the field with the items,
    the body's schema, and whether it says that there are more pages by a link or
    by the number of all pages."""

    keys: tuple[str, ...]
    field: str
    schema: str
    by_link: bool = True

    def parsed(self, body: Column) -> Column:
        more = LINKS if self.by_link else TOTAL_PAGES
        fields = self.schema.removeprefix("struct<").removesuffix(">")
        return F.from_json(
            body, f"struct<{fields}, {more}, {CORRUPT}: string>", {"columnNameOfCorruptRecord": CORRUPT}
        )

    def has_more(self, parsed: Column) -> Column:
        if self.by_link:
            return F.coalesce(parsed["links"]["next"] != "", F.lit(False))
        return F.col("page") < F.coalesce(parsed["pagination"]["totalPages"], F.lit(1))


SEGMENT_PAGES = PageKind((), "data", SEGMENT_PAGE)
PROFILE_PAGES = PageKind(("segment_id",), "data", PROFILE_PAGE)
SEARCH_PAGES = PageKind(("collection",), "results", SEARCH_PAGE, by_link=False)


def _looked_at(pages: DataFrame, kind: PageKind) -> DataFrame:
    """Pages with what is wrong about them by themselves, if anything."""
    parsed = pages.withColumn("__parsed", kind.parsed(F.col("body")))
    body = F.col("__parsed")
    problem = (
        F.when(F.col("page").isNull(), "no number")
        .when(F.col("body").isNull() | body[CORRUPT].isNotNull(), "unreadable")
        .when(body[kind.field].isNull(), "no items")
    )
    return parsed.withColumns({"problem": problem, "more": kind.has_more(body)}).drop("__parsed")


def readable_pages(pages: DataFrame, kind: PageKind) -> DataFrame:
    """The pages whose body can be read."""
    return _looked_at(pages, kind).filter(F.col("problem").isNull()).select(*pages.columns)


def page_problems(pages: DataFrame, kind: PageKind, first: int = 1) -> DataFrame:
    """(keys, page, problem) of everything that makes a pull incomplete.

    ``no number``, ``unreadable`` and ``no items`` are about a landed page,
    ``repeated`` about a number that several have. ``gap`` is the first number that
    is missing before a page, ``cut`` a last page that says there are more, and
    ``early end`` one before it that says there are none. Gaps are found by a join
    with the numbers moved by one: a pull of any length is looked at by many tasks.
    """
    keys = list(kind.keys)
    looked = _looked_at(pages, kind)
    own = looked.filter(F.col("problem").isNotNull()).select(*keys, "page", "problem")
    numbers = (
        looked.filter(F.col("page").isNotNull())
        .groupBy(*keys, "page")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bool_and("more").alias("all_more"),
            F.bool_or("more").alias("some_more"),
            F.bool_or(F.col("problem").isNotNull()).alias("bad"),
        )
    )
    repeated = numbers.filter("n > 1").select(*keys, "page", F.lit("repeated").alias("problem"))
    everything = F.lit(0).alias("__pull")  # a pull without keys is one pull
    ends = numbers.groupBy(everything, *keys).agg(F.min("page").alias("lowest"), F.max("page").alias("highest"))
    ended = spread_join(numbers.withColumn("__pull", F.lit(0)), ends, ["__pull", *keys])
    unless_first = ended.filter(F.col("page") > F.lit(first)).select(
        *keys, (F.col("page") - 1).alias("page"), F.lit("gap").alias("problem")
    )
    gap = unless_first.join(numbers.select(*keys, "page"), [*keys, "page"], "left_anti")
    last = F.col("page") == F.col("highest")
    chain = F.when(last & F.col("some_more"), "cut").when(~last & ~F.col("all_more"), "early end")
    broken = ended.filter(~F.col("bad")).select(*keys, "page", chain.alias("problem"))
    broken = broken.filter(F.col("problem").isNotNull())
    return own.unionByName(repeated).unionByName(gap).unionByName(broken)


def assert_complete(problems: DataFrame, what: str) -> None:
    """Fail when pages have problems, naming a few."""
    found = problems.limit(5).collect()
    if found:
        raise ValueError(f"{what}: incomplete pull, for example {[row.asDict() for row in found]}")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page files written as JSON lines with page, body and the pull's keys."""
    return spark.read.json(path)


def _items(pages: DataFrame, schema: str, field: str, *keys: str) -> DataFrame:
    body = F.from_json("body", schema)
    return pages.select(*keys, "page", F.posexplode(body[field]).alias("pos", "item"))


def segments_from_pages(
    pages: DataFrame,
    created_after: datetime | None = None,
    created_before: datetime | None = None,
    updated_after: datetime | None = None,
) -> DataFrame:
    """Segments of all pages; every given bound is strict."""
    items = _items(pages, SEGMENT_PAGE, "data")
    attributes = F.col("item.attributes")
    bounds: list[Column] = []
    if created_after is not None:
        bounds.append(to_datetime(attributes["created"]) > ts(created_after))
    if created_before is not None:
        bounds.append(to_datetime(attributes["created"]) < ts(created_before))
    if updated_after is not None:
        bounds.append(to_datetime(attributes["updated"]) > ts(updated_after))
    for bound in bounds:
        items = items.filter(bound)
    found = items.select(
        F.col("item.id").alias("segment_id"), attributes["name"].alias("segment_name")
    )
    return process_table(found, "segments")


def _profile_items(pages: DataFrame, joined_after: datetime | None) -> DataFrame:
    items = _items(pages, PROFILE_PAGE, "data", "segment_id")
    if joined_after is not None:
        items = items.filter(to_datetime(F.col("item.joined_group_at")) > ts(joined_after))
    return items


def profiles_from_pages(pages: DataFrame, joined_after: datetime | None = None) -> DataFrame:
    """One row per profile: as first seen by segment, page and place."""
    seen = _profile_items(pages, joined_after).select(
        F.col("item.id").alias("profile_id"),
        F.col("item.attributes.email").alias("email"),
        "segment_id",
        "page",
        "pos",
    )
    order = [F.col("segment_id"), F.col("page"), F.col("pos")]
    first = keep_first(seen, ["profile_id"], order)
    return process_table(first, "profiles")


def membership_from_pages(pages: DataFrame, joined_after: datetime | None = None) -> DataFrame:
    """One row per page item and segment."""
    found = _profile_items(pages, joined_after).select(
        F.col("item.id").alias("profile_id"), "segment_id"
    )
    return process_table(found, "segment_membership")


def collection_positions(pages: DataFrame) -> DataFrame:
    """Products of all collections with their running position across pages.

    Pages are numbered by their sizes alone, one number per page; the products
    themselves only meet the offset of their page.
    """
    sized = pages.withColumn("results", F.from_json("body", SEARCH_PAGE)["results"])
    size = F.coalesce(F.size("results"), F.lit(0))
    sizes = sized.groupBy("collection", "page").agg(F.sum(size).alias("size"))
    offsets = running_position(sizes, ["collection"], "page", F.col("size"), F.lit(0), "before")
    offsets = offsets.select("collection", "page", "before")
    results = sized.select("collection", "page", F.posexplode("results").alias("pos", "item"))
    items = results.join(offsets, ["collection", "page"])
    found = items.select(
        "collection",
        (F.col("before") + F.col("pos") + 1).alias("position"),
        F.col("item.name").alias("name"),
        F.col("item.price").alias("price"),
        F.col("item.msrp").alias("compare_at_price"),
        F.col("item.ss_available").alias("available"),
    )
    return process_table(found, "searchspring_collection", keep=("collection",))
