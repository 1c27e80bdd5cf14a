"""The jobs from stored tables and files to stored results."""

from storelens.catalog import merchandising as cm
from storelens.catalog import segments as cs
from storelens.catalog.intake import profile_pages, search_pages, segment_pages
from storelens.catalog.views import AS_OF
from storelens.functions.dates import extract_since
from storelens.plans import jobs, merchandising
from storelens.sources.warehouse import since

import pytest

STORED = {
    "shopify_order_lines": "order_lines",
    "shopify_orders": "s_orders",
    "shopify_variants": "variants",
    "shopify_listings": "shopify_listings",
    "shopify_customers": "shopify_customers",
    "master_sku": "master_sku",
    "stock_daily": "stock_daily",
    "collections": "searchspring_collection",
    "profiles": "profiles",
    "segments": "segments",
    "segment_membership": "segment_membership",
    "campaigns": "campaigns",
}


@pytest.fixture(scope="module")
def source(tables, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    for name, view in STORED.items():
        getattr(tables, view).write.parquet(str(folder / name))
    return str(folder)


def stored(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}")


def test_extracts_feed_the_report(spark, tables, tmp_path):
    landed = {"raw_shopify_variants": "variants", "raw_shopify_products": "shopify_listings", "raw_shopify_orders": "s_orders",
              "stock_daily": "stock_daily"}
    for name, view in landed.items():
        getattr(tables, view).write.parquet(str(tmp_path / "landed" / name))
    tables.order_lines.write.parquet(str(tmp_path / "landed" / "raw_shopify_order_lines"))
    (tmp_path / "m.csv").write_text("SKU,EC,Unit Cost,Category-Group\nx-1,5,2,Rings\n")
    search_pages(tables).write.json(str(tmp_path / "pages"))
    counts = jobs.extract_merchandising(
        spark, str(tmp_path / "landed"), str(tmp_path / "m.csv"), str(tmp_path / "pages"), str(tmp_path / "in"), AS_OF
    )
    written = {r["table_name"]: r["row_count"] for r in counts.collect()}
    assert written["master_sku"] == 1 and written["shopify_variants"] == tables.variants.count()
    assert written["collections"] == tables.searchspring_collection.count()
    assert 0 < written["shopify_orders"] < tables.s_orders.count()
    jobs.merchandising_report(spark, str(tmp_path / "in"), str(tmp_path / "out"), AS_OF)
    recent = since(tables.order_lines, "created_at", extract_since(AS_OF, jobs.EXTRACT_DAYS))
    sold = merchandising.variant_window_sales(recent, tables.s_orders, AS_OF).where("units_sold_30d > 0")
    sold = sold.select("variant_id", "units_sold_30d", "order_count_30d")
    known = sold.join(tables.variants.select("variant_id"), "variant_id", "left_semi")
    found = stored(spark, tmp_path / "out", "variant_sales").where("units_sold_30d > 0").select(*sold.columns)
    assert sorted(found.collect()) == sorted(known.collect()) and found.count() > 0


def test_extract_marketing(spark, tables, tmp_path):
    landed = {"raw_shopify_variants": "variants", "raw_shopify_products": "shopify_listings", "raw_shopify_orders": "s_orders",
              "raw_shopify_customers": "shopify_customers"}
    for name, view in landed.items():
        getattr(tables, view).write.parquet(str(tmp_path / "landed" / name))
    tables.order_lines.write.parquet(str(tmp_path / "landed" / "raw_shopify_order_lines"))
    segment_pages(tables).write.json(str(tmp_path / "segments"))
    profile_pages(tables).write.json(str(tmp_path / "profiles"))
    long_ago = AS_OF.replace(year=1980)
    counts = jobs.extract_marketing(
        spark, str(tmp_path / "landed"), str(tmp_path / "segments"), str(tmp_path / "profiles"), str(tmp_path / "in"), long_ago
    )
    written = {r["table_name"]: r["row_count"] for r in counts.collect()}
    assert written["segments"] == 5 and 0 < written["profiles"] <= written["segment_membership"]
    tables.campaigns.write.parquet(str(tmp_path / "in" / "campaigns"))
    jobs.segment_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert stored(spark, tmp_path / "out", "f_segments").count() == 5


def test_merchandising_report(spark, tables, source, tmp_path):
    jobs.merchandising_report(spark, source, str(tmp_path), AS_OF)
    listings = stored(spark, tmp_path, "listing_sales")
    assert listings.count() == cm.listing_sales(tables).count()
    header = stored(spark, tmp_path, "collection_report_header").collect()
    analysis = stored(spark, tmp_path, "collection_analysis")
    assert sum(r["total"] for r in header) == analysis.count()
    summary = spark.read.csv(str(tmp_path / "summary_by_markdown_csv"), header=True)
    assert summary.count() == stored(spark, tmp_path, "summary_by_markdown").count()


def test_segment_tables(spark, tables, source, tmp_path):
    jobs.segment_tables(spark, source, str(tmp_path))
    expected = {r["segment_id"]: r["total_orders"] for r in cs.segment_features(tables).collect()}
    found = stored(spark, tmp_path, "f_segments").collect()
    assert {r["segment_id"]: r["total_orders"] for r in found} == expected
    assert stored(spark, tmp_path, "segment_bfcm_only").count() == 0


def test_order_sheet_import(spark, tmp_path):
    files = {
        "sheets/JC-3.csv": "Customer,Parent SKU,Ship Date,Rep Notes,S,M,QTY L\n"
        "Xavier,a ,3/15,hello,2,,1\n,b,,,,x,4\nYves,b,ASAP,,,,5\n",
        "sheets/ZZ-1.csv": "Customer,Parent SKU,Ship Date,Rep Notes,S,M,QTY L\nYves,a,,,1,,\n",
        "master/m.csv": "SKU (Parent),Size Abbreviation,SKU,UPC,Collection,Season,FAHO24 Status\n"
        "A,S,a-s,1,,,\nA,LXL,a-lxl,,,,\nB,L,b-l,,,,\nB,M,b-m,,,EXCLUSIVE,\n",
        "export/e.csv": "ID,Internal Reference\nE1,A-S\n,A-LXL\nE3,b-l\n",
        "contacts/c.csv": "Name,ID,Is a Company\nxavier!,7,True\nYves & Co,8,False\n",
    }
    for name, text in files.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
    folders = [str(tmp_path / f) for f in ("sheets", "master", "export", "contacts")]
    jobs.order_sheet_import(spark, *folders, str(tmp_path / "out"), AS_OF, {"JC": "Robin North"})
    rows = stored(spark, tmp_path / "out", "order_import").orderBy("file", "row_no", "size_pos").collect()
    assert [(r["file"], r["name"], r["id"], r["sku"], r["quantity"], r["external_id"]) for r in rows] == [
        ("JC-3.csv", "Xavier", "7", "A-S", 2, "E1"),
        ("JC-3.csv", "", "", "A-LXL", 1, ""),
        ("JC-3.csv", "", "", "B-L", 4, "E3"),
        ("JC-3.csv", "Yves", "8", "B-L", 5, "E3"),
        ("ZZ-1.csv", "Yves", "8", "A-S", 1, "E1"),
    ]
    assert rows[0]["rep_notes"] == (
        "SHIP DATE: 03/15/2002 | CUSTOMER MATCH: (Xavier --> 7) Normalized match, company | hello"
    )
    csv = spark.read.csv(str(tmp_path / "out" / "order_import_csv"), header=True)
    assert csv.columns[0] == "Salesperson" and csv.count() == 5
    assert {r["file"]: r["count"] for r in csv.groupBy("file").count().collect()} == {"JC-3.csv": 4, "ZZ-1.csv": 1}
    assert stored(spark, tmp_path / "out", "master_duplicates").count() == 0
    assert stored(spark, tmp_path / "out", "unknown_rep_files").collect() == [("ZZ-1.csv", "ZZ")]
    assert stored(spark, tmp_path / "out", "missing_ext_ids").count() == 1
    assert stored(spark, tmp_path / "out", "defaulted_ship_dates").count() == 2


def test_maintenance(spark, tables, source, tmp_path):
    top = jobs.best_sellers(spark, tables.order_lines, source, str(tmp_path), AS_OF)
    assert 0 < top.count() <= 100
    plan = jobs.clear_stale_badges(spark, source, str(tmp_path), AS_OF, dry_run=False)
    before = {r["product_id"]: r for r in stored(spark, source, "shopify_listings").collect()}
    after = {r["product_id"]: r for r in stored(spark, tmp_path, "shopify_listings_after").collect()}
    assert before.keys() == after.keys()
    changed = {i for i in before if before[i] != after[i]}
    assert len(changed) == plan.count() > 0 and all(after[i]["badge"] is None for i in changed)
