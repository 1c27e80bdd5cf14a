"""Order sheets against row-by-row brute force on small fixtures."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from storelens.operators.ordering import carry_forward, keep_first
from storelens.operators.reshape import size_columns
from storelens.plans import order_sheets as o

NOW = datetime(2026, 1, 10, 12)
SHEET = (
    "file string, row_no bigint, customer string, parent_sku string, ship_date string, "
    "rep_notes string, S string, M string, L string"
)
SIZES = {"S": "S", "M": "M", "L": "L"}


def master(spark, rows):
    columns = "row_no int, sku_parent string, size_abbreviation string, sku string, upc string, ext_id string"
    return spark.createDataFrame(rows, columns)


def sheet(spark, rows):
    return o.clean_sheet(spark.createDataFrame(rows, SHEET))


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_carry_forward_does_not_depend_on_chunks(spark, chunk):
    rng = random.Random(7)
    rows, expected = [], {}
    for file, size in (("one", 60), ("two", 9), ("none", 4)):
        last = None
        for number in range(5, 5 + size):
            start = file != "none" and rng.random() < 0.2
            last = number if start else last
            rows.append((file, number, start))
            expected[(file, number)] = last
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, row_no bigint, start boolean").repartition(5)
    found = carry_forward(df, ["file"], "row_no", F.col("start"), "start_row", chunk).collect()
    assert {(r["file"], r["row_no"]): r["start_row"] for r in found} == expected


def test_quantities(spark):
    cells = ["2", " 3 ", "0", "", "1,000", "2.9", "-1", "0.5"]
    rows = [("AK-1.csv", i, "c", " par-1 ", "", "", c, "", "") for i, c in enumerate(cells)]
    rows.append(("AK-1.csv", 99, "c", " ", "", "", "5", "", ""))
    items = o.order_items(o.order_groups(sheet(spark, rows)), SIZES)
    found = {r["row_no"]: (r["parent"], r["qty"]) for r in items.collect()}
    assert found == {0: ("PAR-1", 2), 1: ("PAR-1", 3), 5: ("PAR-1", 2), 6: ("PAR-1", -1), 7: ("PAR-1", 0)}


def test_size_columns(spark):
    m = master(spark, [(1, "P", "PET-S", "x", "", ""), (2, "P", "M", "y", "", "")])
    columns = ["Customer", "PET-S", "QTY M", "S", "OSFM", "M/L"]
    assert size_columns(columns, m, "size_abbreviation") == {
        "PET-S": "PET-S", "QTY M": "M", "OSFM": "OSFM", "M/L": "M",
    }
    with pytest.raises(ValueError):
        size_columns(["Customer"], m, "size_abbreviation")


def test_size_fallback(spark):
    m = master(spark, [
        (1, "A", "SM", "A-SM", "", "1"), (2, "A", "LXL", "A-LXL", "", ""),
        (3, "B", "S", "B-S", "", "2"), (4, "B", "SM", "B-SM", "", "3"), (5, "B", "M", "B-M", "", "4"),
    ])
    rows = [("f", 1, "c", "A", "", "", "1", "2", "3"), ("f", 2, "", "B", "", "", "4", "5", "6")]
    items = o.order_items(o.order_groups(sheet(spark, rows)), SIZES)
    lookup = o.orderable(m)
    found = o.order_items_enriched(items, lookup).collect()
    assert {(r["row_no"], r["size"]): (r["sku"], r["pass_no"]) for r in found} == {
        (1, "S"): ("A-SM", 1), (1, "L"): ("A-LXL", 2), (2, "S"): ("B-S", 0), (2, "M"): ("B-M", 0),
    }
    assert o.order_items_unmatched(items, lookup).collect() == [("A", "M"), ("B", "L")]


def test_master_rules(spark):
    columns = (
        "row_no int, sku_parent string, size_abbreviation string, sku string, upc string, "
        "ext_id string, collection string, season string, spsu25_status string"
    )
    rows = [
        (1, "p1", "m", "a", "", "", "core", "", ""),
        (2, "P1", "M ", "b", "9", "", "core", "", ""),
        (3, "p1", "M", "c", "", "7", "core", "", ""),
        (4, "p1", "M", "d", "", "8", "core", "", ""),
        (5, "p2", "M", "e", "", "", "harem pants", "", ""),
        (6, "p3", "M", "xhicx", "", "", "", "", ""),
        (7, "p4", "n/a", "f", "", "", "", "", ""),
        (8, "p5", "M", "g", "", "", "", "exclusive", ""),
        (9, "p6", "M", "h", "", "", "", "", " EXCLUSIVE"),
        (10, "p7", "L", "i", "", "", None, None, None),
    ]
    kept = o.master_filtered(spark.createDataFrame(rows, columns))
    assert sorted(r["row_no"] for r in kept.collect()) == [1, 2, 3, 4, 10]
    assert sorted(r["sku"] for r in o.master_unique(kept).collect()) == ["C", "I"]
    duplicates = o.master_duplicates(spark.createDataFrame(rows, columns)).collect()
    assert sorted(r["row_no"] for r in duplicates) == [1, 2, 3, 4]


def test_variant_export_prefers_a_filled_id(spark):
    rows = [(1, " ref ", ""), (2, "REF", "7"), (3, "ref", "8"), (4, "other", None)]
    export = spark.createDataFrame(rows, "row_no int, internal_reference string, id string")
    assert Counter(tuple(r) for r in o.variant_export_dedup(export).collect()) == Counter(
        [("REF", "7"), ("OTHER", "")]
    )


def test_keep_first_with_copies(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"k{i % 20}", i, f"v{i}") for i in range(400)]
    expected = {}
    for key, order, value in sorted(rows, key=lambda r: r[1]):
        expected.setdefault(key, value)
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(6)
    assert {r["k"]: r["v"] for r in keep_first(df, ["k"], [F.col("o")]).collect()} == expected


REPS = {"JC": "Robin North"}


def best_contact(name, contacts):
    """Expected id and text for one name. Every contact that matches at all gets a
    grade; the best grade decides, then what its rule prefers.
    Contacts are (row, name, id, company)."""
    import re

    def plain(x):
        return " ".join(re.sub(r"[^\w\s]", "", x.lower()).split())

    def grade(other):
        grades = (other == name, plain(other) == plain(name), plain(name) in plain(other))
        return grades.index(True) if True in grades else None

    graded = [(grade(c[1]), c) for c in contacts]
    found = min((g for g, _ in graded if g is not None), default=None)
    if found is None:
        return "", "[No match]"
    hits = [c for g, c in graded if g == found]
    firms = [c for c in hits if c[3]]
    pool = firms or hits
    if found < 2:
        tier = ("Exact", "Normalized")[found]
        return pool[0][2], f"[{tier} match{', company' if firms else ''}]"
    chosen = min(firms, key=lambda c: (len(c[1]), c[0])) if firms else hits[0]
    texts = {
        (1, True): "company", (1, False): "individual",
    }
    if len(hits) == 1:
        note = texts[1, bool(firms)]
    elif len(firms) == 1:
        note = "company, 1 of many"
    else:
        note = f"{'company, ' if firms else ''}1 of {len(pool)}"
    return chosen[2], f"[Contains match, {note}]"


def test_contact_match_against_brute_force(spark):
    rng = random.Random(11)
    words = ["Blue", "Moon", "Shop", "The", "sun", "co", "Moon-Park", "B", "o'Neil", "blue moon"]
    contacts = [
        (i, " ".join(rng.choices(words, k=rng.randint(1, 4))), f"id{i}", rng.random() < 0.4)
        for i in range(150)
    ]
    # one name held by a third of all contacts
    contacts += [(150 + i, "Blue Moon Shop", f"hot{i}", i == 40) for i in range(75)]
    names = sorted({" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(80)})
    names += ["Nobody", "!!", "u", "BLUE  moon shop."]
    people = spark.createDataFrame(
        [(i, n, d, "True" if c else "no") for i, n, d, c in contacts],
        "row_no int, name string, id string, is_a_company string",
    ).repartition(5)
    asked = spark.createDataFrame([(n,) for n in names + names[:5] + [""]], "customer string")
    found = {r["customer"]: (r["id"], r["match_info"]) for r in o.contact_match(asked, people).collect()}
    assert found.pop("") == ("", "[No name]")
    assert found == {n: best_contact(n, contacts) for n in names}
    tiers = {info.split()[0].strip("[") for _, info in found.values()}
    assert {"Exact", "Normalized", "Contains", "No"} <= tiers


def test_import_table(spark):
    m = master(spark, [
        (1, "A", "M", "A-M", "", "E1"), (2, "A", "SM", "A-SM", "", ""), (3, "B", "L", "B-L", "", "E3"),
    ])
    contacts = spark.createDataFrame(
        [(1, "Xavier", "c1", "True")], "row_no int, name string, id string, is_a_company string"
    )
    rows = [
        ("JC-3.csv", 1, "", "A", "", "lost note", "", "1", ""),
        ("JC-3.csv", 2, "Xavier", "A", "3/15", "first", "2", "3", ""),
        ("JC-3.csv", 3, "", "B", "", "second", "", "", "4"),
        ("JC-3.csv", 4, "Yvonne", "", "ASAP", "also lost", "", "", ""),
        ("JC-3.csv", 5, "Zoe", "B", "", "", "", "", "5"),
        ("XX-1.csv", 1, "Xavier", "B", "1/5", "", "", "", "6"),
    ]
    groups = o.order_groups(sheet(spark, rows))
    items = o.order_items_enriched(o.order_items(groups, SIZES), o.orderable(m))
    table = o.order_import(items, groups, contacts, NOW, REPS)
    keyed = {
        (r["file"], r["row_no"], r["sku"]): r for r in table.collect()
    }
    assert len(keyed) == 6
    above = keyed[("JC-3.csv", 1, "A-M")]
    assert (above["name"], above["salesperson"], above["rep_notes"], above["tags"]) == ("", "", "", "")
    head = keyed[("JC-3.csv", 2, "A-M")]
    assert (head["name"], head["id"], head["salesperson"], head["tags"]) == (
        "Xavier", "c1", REPS["JC"], o.ORDER_TAG,
    )
    assert head["rep_notes"] == (
        "SHIP DATE: 03/15/2026 | CUSTOMER MATCH: (Xavier --> c1) Exact match, company | first --- second"
    )
    assert keyed[("JC-3.csv", 2, "A-SM")]["name"] == ""
    assert keyed[("JC-3.csv", 5, "B-L")]["rep_notes"] == (
        "SHIP DATE: 01/11/2026 | CUSTOMER MATCH: (Zoe) No match"
    )
    assert keyed[("XX-1.csv", 1, "B-L")]["salesperson"] == o.UNKNOWN_REP
    written = o.import_file(table)
    assert written.columns == [
        "Salesperson", "Sales Team", "Name", "ID", "SKU", "Quantity", "External ID", "Tags", "Rep Notes",
    ]
    assert [r["SKU"] for r in written.collect()] == ["A-M", "A-M", "A-SM", "B-L", "B-L", "B-L"]
    assert [tuple(r) for r in o.missing_ext_ids(items).collect()] == [("JC-3.csv", 2, "A-SM")]
    late = o.defaulted_ship_dates(groups, NOW).collect()
    assert sorted((r["customer"], r["raw_ship_date"]) for r in late) == [
        ("Yvonne", "ASAP"), ("Zoe", "(blank)"),
    ]
    assert [tuple(r) for r in o.unknown_rep_files(groups, REPS).collect()] == [("XX-1.csv", "XX")]


def test_notes_of_a_long_order_stay_in_row_order(spark):
    rows = [("f", i, "c" if i == 0 else "", "A", "", f"n{i}", "", "", "") for i in range(0, 20000, 7)]
    groups = o.order_groups(sheet(spark, rows).repartition(6))
    notes = o.order_notes(groups).collect()
    assert [r["notes"] for r in notes] == [" --- ".join(f"n{i}" for i in range(0, 20000, 7))]
