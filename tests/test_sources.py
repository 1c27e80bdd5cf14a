"""Readers, writers, landed pages, incremental pulls."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from storelens import schemas, session
from storelens.sources import files, pages, warehouse
from storelens.sources.extract import run_extracts
from storelens.streaming.incremental import extract_new_files


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base)
    staged = session.stage(spark.range(5), "five")
    assert staged.count() == 5 and "LogicalRDD" not in staged._jdf.queryExecution().toString()


def test_csv_folder_with_three_encodings(spark, tmp_path):
    header = "Customer,Notes\n"
    (tmp_path / "AK-1.csv").write_bytes(("\ufeff" + header + 'Zoë,"two\nlines"\n,\n').encode("utf-8"))
    (tmp_path / "JC-1.csv").write_bytes((header + "Zoë €,x\n").encode("cp1252"))
    (tmp_path / "CF-1.csv").write_bytes((header + "Zoë,").encode("latin-1") + b"\x81 y\n")
    encodings = {r["file"]: r["encoding"] for r in files.csv_encodings(spark, str(tmp_path)).collect()}
    assert encodings == {"AK-1.csv": "UTF-8", "JC-1.csv": "windows-1252", "CF-1.csv": "ISO-8859-1"}
    rows = files.read_text_csvs(spark, str(tmp_path)).orderBy("file", "row_no").collect()
    assert rows[0].asDict().keys() == {"file", "row_no", "Customer", "Notes"}
    assert [(r["file"], r["Customer"], r["Notes"]) for r in rows] == [
        ("AK-1.csv", "Zoë", "two\nlines"), ("AK-1.csv", "", ""),
        ("CF-1.csv", "Zoë", "\x81 y"), ("JC-1.csv", "Zoë €", "x"),
    ]


def test_rows_keep_their_file_order(spark, tmp_path):
    for name in ("AK-1.csv", "AG-2.csv"):
        lines = [f"{name}-{i},{i}" for i in range(3000)]
        (tmp_path / name).write_text("Customer,Notes\n" + "\n".join(lines))
    df = files.read_text_csvs(spark, str(tmp_path))
    for name in ("AK-1.csv", "AG-2.csv"):
        ordered = df.filter(F.col("file") == name).orderBy("row_no").collect()
        assert [int(r["Notes"]) for r in ordered] == list(range(3000))


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_text_csvs(spark, str(tmp_path))


def test_csv_report(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "rank int, title string").orderBy("rank")
    files.write_csv(df, str(tmp_path / "report"))
    back = spark.read.csv(str(tmp_path / "report"), header=True)
    assert [tuple(r) for r in back.collect()] == [("1", "a"), ("2", "b")]


def test_segment_pages(spark):
    def item(i, created):
        return {"id": f"s{i}", "attributes": {"name": f"n{i}", "created": created, "updated": created}}

    bodies = [
        (1, json.dumps({"data": [item(1, "2024-01-01T00:00:00+00:00"), item(2, "2024-02-01T00:00:00+00:00")]})),
        (2, json.dumps({"data": [item(3, "2024-03-01T00:00:00+00:00")]})),
        (3, json.dumps({"data": []})),
    ]
    df = spark.createDataFrame(bodies, "page int, body string")
    ids = lambda **kw: sorted(r["segment_id"] for r in pages.segments_from_pages(df, **kw).collect())
    assert ids() == ["s1", "s2", "s3"]
    assert ids(created_after=datetime(2024, 1, 1)) == ["s2", "s3"]
    assert ids(created_before=datetime(2024, 3, 1), updated_after=datetime(2024, 1, 15)) == ["s2"]


def test_profile_pages_first_wins(spark):
    def body(*items):
        return json.dumps({"data": [{"id": i, "attributes": {"email": e}} for i, e in items]})

    rows = [
        ("s1", 1, body(("p1", "first"), ("p2", "a"))), ("s1", 2, body(("p1", "later"))),
        ("s2", 1, body(("p1", "other"), ("p3", None))),
    ]
    df = spark.createDataFrame(rows, "segment_id string, page int, body string").repartition(3)
    profiles = {r["profile_id"]: r["email"] for r in pages.profiles_from_pages(df).collect()}
    assert profiles == {"p1": "first", "p2": "a", "p3": None}
    assert pages.membership_from_pages(df).count() == 5


def test_collection_positions_run_over_pages(spark):
    def body(names):
        return json.dumps({"results": [{"name": n, "price": 1.5, "msrp": "2"} for n in names]})

    rows = [("c", 2, body("de")), ("c", 1, body("abc")), ("c", 10, body("f")), ("k", 1, body("x")), ("c", 3, "{}")]
    df = spark.createDataFrame(rows, "collection string, page int, body string")
    found = pages.collection_positions(df).collect()
    assert sorted((r["collection"], r["position"], r["name"]) for r in found) == [
        ("c", 1, "a"), ("c", 2, "b"), ("c", 3, "c"), ("c", 4, "d"), ("c", 5, "e"), ("c", 6, "f"), ("k", 1, "x"),
    ]
    assert found[0]["compare_at_price"] == 2.0


def test_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame(
        [("1", datetime(2025, 1, 1), "3"), ("2", datetime(2025, 1, 2), "4")],
        "order_id string, created_at timestamp_ntz, quantity string",
    ).write.parquet(path)
    df = warehouse.scan_table(warehouse.read_landed(spark, path), "order_lines", datetime(2025, 1, 2))
    assert [tuple(r) for r in df.collect()] == [("2", 4)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in plan


def test_extracts_count_what_they_write(spark, tmp_path):
    counts = run_extracts(
        spark,
        {"a": lambda: spark.range(7), "b": lambda: spark.range(4).withColumn("collection", F.lit("x"))},
        str(tmp_path),
        {"b": "collection"},
    )
    assert {tuple(r) for r in counts.collect()} == {("a", 7), ("b", 4)}
    assert files.read_table(spark, str(tmp_path / "a")).count() == 7
    assert (tmp_path / "b" / "collection=x").is_dir()


def test_register_keeps_an_existing_table(spark, tmp_path):
    for name, n in (("one", 1), ("two", 2)):
        files.write_table(spark.range(n), str(tmp_path / name))
    files.register(spark, "numbers_view", str(tmp_path / "one"))
    files.register(spark, "numbers_view", str(tmp_path / "two"))
    assert spark.sql("select count(*) from numbers_view").first()[0] == 1
    spark.catalog.dropTempView("numbers_view")


def test_incremental_extract_takes_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    raw = spark.createDataFrame([(" p1 ", "A@x")], "`Profile ID` string, Email string")
    raw.write.parquet(source)

    def run():
        query = extract_new_files(spark, source, raw.schema, "profiles", target, checkpoint)
        query.awaitTermination()
        return sorted(r["profile_id"] for r in spark.read.parquet(target).collect())

    assert run() == ["p1"]
    spark.createDataFrame([("p2", None)], raw.schema).write.mode("append").parquet(source)
    assert run() == ["p1", "p2"]
    assert run() == ["p1", "p2"]
    assert spark.read.parquet(target).columns == list(schemas.TABLES["profiles"])
