"""Groups of any size: ranks, notes, contained names, pulls with holes."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from storelens.operators.ordering import average_rank, range_rank
from storelens.plans import jobs
from storelens.plans import order_sheets as o
from storelens.sources import pages
from tests.test_plans import plan_of


def test_ranks_over_ranges_are_those_of_a_window(spark):
    rng = random.Random(2)
    values = [None, 0.0, -0.0, 1.5, float("nan"), *[rng.randrange(300) / 4 for _ in range(200)]]
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), rng.choice(values)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("id", F.monotonically_increasing_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = range_rank(df, ["g"], "v", "r").select("id", F.round("r", 9).alias("r"))
        found = {r["id"]: r["r"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = df.select("id", F.round(average_rank(F.col("v"), ["g"]), 9).alias("r")).collect()
    assert found == {r["id"]: r["r"] for r in expected} and len(found) == 5000
    assert range_rank(df.limit(0), ["g"], "v", "r").count() == 0


def test_a_group_is_ranked_by_many_tasks(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 4001).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = plan_of(range_rank(df, ["g"], "v", "r"))
        assert "windowspecdefinition(g" in plan and "__part" in plan
        # the only window over a whole group is over one row a range
        for terms in re.findall(r"windowspecdefinition\(g#\d+, (v|__part)", plan):
            assert terms == "__part"
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def sheet(spark, rows):
    return spark.createDataFrame(rows, "file string, row_no bigint, start_row bigint, rep_notes string")


def test_notes_of_one_huge_order(spark):
    rows = [("a.csv", i, 1, f"note {i}") for i in range(1, 30_000)] + [("a.csv", 40_000, 40_000, "small"), ("b.csv", 1, None, "lost")]
    df = sheet(spark, rows)
    with pytest.raises(ValueError, match=r"a.csv: the notes of the order in row 1 have \d{6} bytes"):
        o.order_notes(df, max_bytes=100_000)
    whole = {r["start_row"]: r["notes"] for r in o.order_notes(df).collect()}
    assert whole == {1: " --- ".join(f"note {i}" for i in range(1, 30_000)), 40_000: "small"}
    parts = o.order_notes(df, max_bytes=100_000, too_long="split").orderBy("start_row", "part").collect()
    big = [r for r in parts if r["start_row"] == 1]
    assert [r["part"] for r in big] == list(range(len(big))) and len(big) >= 3
    assert " --- ".join(r["notes"] for r in big) == whole[1]
    longest_stretch = 4096 * len("note 29999 --- ")
    assert max(len(r["notes"]) for r in big) <= 100_000 + longest_stretch
    with pytest.raises(ValueError, match="too_long"):
        o.order_notes(df, too_long="drop")


def contained_by_hand(names, contacts):
    return {n: sum(n in c for c in contacts) for n in names}


def test_contained_names_of_every_length(spark):
    rng = random.Random(11)
    letters = "ab é"
    contacts = ["".join(rng.choices(letters, k=rng.randrange(1, 40))).strip() or "a" for _ in range(300)] + ["aaaaaaaaaaaaaaaaaaaa", "a"]
    names = {c[i : i + n] for c in contacts[:60] for n in (1, 2, 3, 4, 5, 6, 7, 11, 12, 13, 25) for i in (0, 1, 5) if len(c[i : i + n]) == n}
    names |= {"zz", "abz", "abababababababababababababababababababababab"}
    by_name = spark.createDataFrame([(c,) for c in contacts], "normalized string").groupBy("normalized").agg(
        F.count("*").alias("hits"), F.lit(0).cast("bigint").alias("companies"),
        *[F.min(F.struct("normalized")).alias(c) for c in ("first", "first_company", "shortest_company")],
    )
    found = o._containing(by_name, spark.createDataFrame([(n,) for n in names], "normalized string")).collect()
    expected = {n: k for n, k in contained_by_hand(names, contacts).items() if k}
    assert {r["normalized"]: r["hits"] for r in found} == expected
    assert len(found) == len(expected) > 200


def test_contacts_are_summed_up_before_they_move(spark):
    """Most contacts contain a searched name of one letter."""
    by_name = spark.range(20_000).select(
        F.concat(F.lit("a"), F.col("id").cast("string")).alias("normalized"), F.lit(1).alias("hits"), F.lit(0).alias("companies"),
        *[F.struct("id").alias(c) for c in ("first", "first_company", "shortest_company")],
    )
    found = o._containing(by_name, spark.createDataFrame([("a",), ("19",)], "normalized string"))
    plan = plan_of(found)
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert "part" in moved and "normalized" not in moved[:1] and "partial_sum(hits" in plan
    assert {r["normalized"]: r["hits"] for r in found.collect()} == {"a": 20_000, "19": sum("19" in str(i) for i in range(20_000))}


def page(n, more, items=("x",)):
    return (n, json.dumps({"data": [{"id": i} for i in items], "links": {"next": "u" if more else None}}))


def problems(spark, rows, schema="page int, body string", kind=pages.SEGMENT_PAGES):
    found = pages.page_problems(spark.createDataFrame(rows, schema), kind).collect()
    return sorted((r["page"] or 0, r["problem"]) for r in found)


def test_complete_pulls_have_no_problems(spark):
    assert problems(spark, [page(1, True), page(2, True), page(3, False, [])]) == []
    assert problems(spark, [page(1, False)]) == []
    assert problems(spark, []) == []


def test_what_is_wrong_with_a_pull(spark):
    cut = (3, page(3, True)[1][:-4])
    rows = [page(2, True), cut, page(5, True), page(5, True), page(6, False), page(7, True), (9, '{"errors": []}'), (None, page(1, True)[1]), (8, None)]
    assert problems(spark, rows) == [
        (0, "no number"), (1, "gap"), (3, "unreadable"), (4, "gap"), (5, "repeated"), (6, "early end"), (8, "unreadable"), (9, "no items"),
    ]
    assert problems(spark, [page(1, True), page(2, True)]) == [(2, "cut")]
    readable = pages.readable_pages(spark.createDataFrame(rows, "page int, body string"), pages.SEGMENT_PAGES)
    assert sorted(r["page"] for r in readable.collect()) == [2, 5, 5, 6, 7]
    assert readable.columns == ["page", "body"]


def test_pulls_are_told_apart_by_their_keys(spark):
    rows = [("s1", *page(1, False)), ("s2", *page(1, True)), ("s2", *page(3, False))]
    assert problems(spark, rows, "segment_id string, page int, body string", pages.PROFILE_PAGES) == [(2, "gap")]


def test_an_extract_ends_or_stores_what_is_wrong(spark, tables, tmp_path):
    landed = str(tmp_path / "landed")
    spark.createDataFrame([page(1, True), page(2, True)], "page int, body string").write.json(str(tmp_path / "pages"))
    with pytest.raises(ValueError, match="incomplete pull.*'problem': 'cut'"):
        jobs._whole_pull(spark, str(tmp_path / "pages"), pages.SEGMENT_PAGES, landed, "fail")
    kept = jobs._whole_pull(spark, str(tmp_path / "pages"), pages.SEGMENT_PAGES, landed, "store")
    assert kept.count() == 2
    stored = spark.read.parquet(f"{landed}/bad_pages/data").collect()
    assert [tuple(r) for r in stored] == [(2, "cut")]
    with pytest.raises(ValueError, match="bad_pages"):
        jobs._whole_pull(spark, str(tmp_path / "pages"), pages.SEGMENT_PAGES, landed, "ignore")
