"""The import table: what is stored or moved on the way takes no more disk than needed."""

import os

import pytest
from pyspark.sql import functions as F

from storelens.catalog import CATALOG
from storelens.operators.reshape import pack_sizes, unpack_sizes, unpivot_sizes
from storelens.plans import order_sheets as o
from storelens.session import CLEAN_SHUFFLES, shared_dir, stage, stored_inside
from tests.conftest import SMALL
from tests.test_chains import NOW
from tests.test_plans import plan_of

SIZES = {"s": "S", "QTY m": "M", "l": "L", "again": "S"}
CELLS = "file string, row_no bigint, start_row bigint, parent_sku string, s string, `QTY m` string, l string, again string"
ROWS = [
    ("f", 1, 1, "A", "1", "2", "", "0"), ("f", 2, 1, "A", "", "0", "x", "4"), ("f", 2, 1, "B", "0.5", "", "-3", "nan"),
    ("f", 3, 1, "", "1", "1", "1", "1"), ("f", 4, 1, None, "1", "", "", ""), ("f", 5, None, "B", None, "7", None, None),
    ("f", 5, None, "B", None, "7", None, None), ("f", 6, 6, "Z", "1", "1", "1", "1"), ("f", 7, 6, "A", "", "", "", ""),
]
LOOKUP = [
    ("A", "S", "A-S", "b", "e1", 0), ("A", "M", "A-M", "", "", 0), ("A", "L", "A-LXL", "", "e2", 2),
    ("B", "M", "B-M", "", "e3", 0), ("B", "L", "B-L", None, None, 0), ("B", "S", "B-SM", "", "e4", 1),
    ("B", "XL", "B-XL", "", "e5", 0), ("Z", "S", None, "", "", 0), (None, "S", "N", "", "", 0), ("A", None, "N", "", "", 0),
]
FOUND = "parent string, size string, sku string, barcode string, ext_id string, pass_no int"


def both(spark, rows=ROWS, schema=CELLS):
    groups = spark.createDataFrame(rows, schema)
    lookup = spark.createDataFrame(LOOKUP, FOUND)
    long = o.order_items_enriched(o.order_items(groups, SIZES), lookup)
    return long, o.order_items_enriched(o.order_items(groups, SIZES, packed=True), lookup, SIZES)


def listed(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_packed_items_are_those_of_the_long_form(spark):
    long, packed = both(spark)
    assert packed.drop("leads").schema.simpleString() == long.schema.simpleString()
    assert listed(packed.drop("leads")) == listed(long) and long.count() == 7


def test_packed_items_have_the_places_of_their_own_file(spark):
    rows = [(*r, ["l", "other", "s"] if i % 2 else ["again", "QTY m", "s", "l"]) for i, r in enumerate(ROWS)]
    long, packed = both(spark, rows, CELLS + ", header array<string>")
    assert listed(packed.drop("leads")) == listed(long)
    assert len({r["size_pos"] for r in long.collect()}) > 3


def test_leading_items_come_first_in_their_row(spark):
    leading = {(r["row_no"], r["parent"]): (r["pass_no"], r["size_pos"]) for r in both(spark)[1].filter("leads").collect()}
    # the size that is stocked under another one comes after, wherever it is in the sheet
    assert leading == {(1, "A"): (0, 0), (2, "A"): (0, 3), (2, "B"): (0, 2), (5, "B"): (0, 1)}


def test_rows_without_a_place_do_not_lead(spark):
    packed = spark.createDataFrame(
        [([1.0, 2.0], [None, 4], {"S": (0, "x"), "M": (1, "y")})],
        "amounts array<double>, places array<int>, answers map<string, struct<turn: int, sku: string>>",
    )
    found = unpack_sizes(packed, {"s": "S", "m": "M"}, ["turn", "sku"], ["turn", "size_pos"]).collect()
    assert {r["sku"]: r["leads"] for r in found} == {"x": False, "y": True}


def test_rows_without_quantities_are_not_moved(spark):
    sheet = spark.createDataFrame(ROWS, CELLS)
    packed = pack_sizes(sheet, ["row_no"], SIZES)
    assert {r["row_no"] for r in packed.collect()} == {1, 2, 5, 6}
    assert {r["row_no"] for r in unpivot_sizes(sheet, ["row_no"], SIZES).collect()} == {1, 2, 5, 6}


def test_the_table_is_the_same_from_both(spark):
    sheet = spark.createDataFrame(
        [(*r[:2], "c" if r[1] in (2, 6) else "", "3/15", f"n{i}", *r[3:]) for i, r in enumerate(ROWS)],
        "file string, row_no bigint, customer string, ship_date string, rep_notes string, parent_sku string, s string, "
        "`QTY m` string, l string, again string",
    ).fillna("")
    groups = o.order_groups(sheet)
    lookup = spark.createDataFrame(LOOKUP, FOUND)
    people = spark.createDataFrame([(1, "c", "c1", "True")], "row_no int, name string, id string, is_a_company string")
    long = o.order_items_enriched(o.order_items(groups, SIZES), lookup)
    packed = o.order_items_enriched(o.order_items(groups, SIZES, packed=True), lookup, SIZES)
    tables = [o.order_import(items, groups, people, NOW, {}) for items in (long, packed)]
    assert listed(tables[0]) == listed(tables[1])
    # row 2 is there twice
    assert [r["name"] for r in tables[0].orderBy("row_no").collect() if r["name"]] == ["c", "c"]


def shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_storing_leaves_nothing_of_what_it_shuffled(spark):
    before = shuffled(spark)
    assert stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts").count() == 7
    # the count of the stored rows is a shuffle of its own, of one row
    moved = {n.split("_")[1] for n in shuffled(spark) - before}
    assert len(moved) <= 1 and spark.conf.get(CLEAN_SHUFFLES, None) is None


def test_noted_folders_are_removed(spark):
    with stored_inside() as outer:
        one = stage(spark.range(3), "one")
        with stored_inside() as inner:
            two = stage(spark.range(4), "two")
    paths = [path for _, path in outer.folders]
    assert [path for _, path in inner.folders] == paths[1:]
    inner.remove()
    assert not os.path.exists(paths[1]) and one.count() == 3
    outer.remove()
    assert not os.path.exists(paths[0]) and two.columns == ["id"]


@pytest.mark.parametrize("name, left", [("order_import", {"order_items", "order-heads"}), ("import_files", {"import-rows"})])
def test_what_the_result_does_not_read_is_gone(spark, name, left):
    base = os.path.dirname(shared_dir(spark, "any"))
    before = set(os.listdir(base))
    found = CATALOG.queries[name].run(spark, SMALL)
    assert {f.rsplit("-", 1)[0] for f in set(os.listdir(base)) - before} == left
    assert found.count() > 0


def test_sheets_are_built_without_prices(spark, tables):
    plan = plan_of(type(tables)(spark, SMALL).order_sheet)
    assert "l_linenumber" in plan and "l_extendedprice" not in plan


def test_import_files_keep_details_and_nulls(spark):
    names = ["file", *o.ITEM_PLACE, *o.IMPORT_COLUMNS]
    rows = [("f", i, 0, 0, *[None if i == 1 else "" if i == 2 else "x"] * 4, f"s{i}", i, "e", "", "" if i < 4 else "n") for i in range(1, 6)]
    rows += [("f", 6, 0, 0, "", None, "", "", None, None, None, "", "")]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n in (*o.ITEM_PLACE, 'quantity') else 'string'}" for n in names))
    found = o.import_files(df)
    assert found.columns == ["file", *o.IMPORT_COLUMNS.values()]
    assert [tuple(r) for r in found.collect()] == [(r[0], *r[4:]) for r in rows]
    # details are one value while rows are dealt
    moved = next(line for line in plan_of(found).splitlines() if "Exchange rangepartitioning" in line)
    below = plan_of(found).split(moved)[1].splitlines()[1]
    assert "details" in below
