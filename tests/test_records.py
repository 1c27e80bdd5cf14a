"""CSV files read in many splits against the plain reader, which takes one task a file."""

import csv
import io
import random
import time

import pytest
from pyspark.sql import functions as F

from storelens.sources import files, records

OPTIONS = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8"}


@pytest.fixture
def splits(spark):
    """Splits of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}

    def set_to(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")
        spark.conf.set(keys[2], "1")

    yield set_to
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cell(rng):
    return "".join(rng.choices(["a", "bc", "é", "中", " ", ",", '"', "\n", "\r\n", "\n\n", "'", "\t", ""], k=rng.randrange(6)))


def quoted_file(rng, rows, end="\n", width=3):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    writer.writerow([f"col {i}" for i in range(width)])
    for _ in range(rows):
        writer.writerow([cell(rng) for _ in range(width)])
    return out.getvalue()


def ordered(df):
    return [tuple(r[c] for c in df.columns if c not in ("file", "row_no")) for r in df.orderBy("file", "row_no").collect()]


def plain(spark, path):
    raw = spark.read.csv(path, **OPTIONS)
    return [tuple(v or "" for v in r) for r in raw.collect()]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_lines_in_one_and_many_splits(spark, tmp_path, splits, end):
    rng = random.Random(len(end))
    text = quoted_file(rng, 200, end)
    (tmp_path / "one.csv").write_bytes(text.encode())
    rows = list(csv.reader(io.StringIO(text, newline="")))[1:]
    expected = [tuple(r) for r in rows if r]
    assert len(expected) > 150
    if end == "\n":  # of other line ends the plain reader also changes those in cells
        assert expected == plain(spark, str(tmp_path))
    for size in (1 << 20, 300, 29):
        splits(size)
        df = files.read_text_csvs(spark, str(tmp_path))
        assert ordered(df) == expected, size
        lines = [r["row_no"] for r in df.select("row_no").collect()]
        assert len(set(lines)) == len(lines) and min(lines) > 1


def test_many_files_in_many_splits(spark, tmp_path, splits):
    rng = random.Random(4)
    for i in range(6):
        (tmp_path / f"f{i}.csv").write_bytes(quoted_file(rng, 60).encode())
    expected = {i: plain(spark, str(tmp_path / f"f{i}.csv")) for i in range(6)}
    splits(101)
    df = files.read_text_csvs(spark, str(tmp_path))
    for i in range(6):
        assert ordered(df.filter(F.col("file") == f"f{i}.csv")) == expected[i]


def test_stray_quotes_open_nothing(spark, tmp_path, splits):
    text = 'size,note\n5" heel,x\n"6"" heel",a "b" c\n"a,\nb",5"\n7,"x"y\n ,""\n\n8\n9,1,2,3\n'
    (tmp_path / "a.csv").write_text(text)
    expected = plain(spark, str(tmp_path))
    assert ('5" heel', "x") in expected and ("a,\nb", '5"') in expected
    for size in (1 << 20, 5):
        splits(size)
        assert ordered(files.read_text_csvs(spark, str(tmp_path))) == expected


def test_names_of_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿"A, b",,x,X,\n1,2,3,4,5\n')
    (tmp_path / "b.csv").write_text("z,x,\"two\nlines\"\n6,7,8\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("only\n")
    df = files.read_text_csvs(spark, str(tmp_path), own_headers=True)
    assert df.columns == ["file", "header", "row_no", "A, b", "_c1", "x2", "X3", "_c4", "z", "x", "two\nlines"]
    assert spark.read.csv(str(tmp_path / "a.csv"), **OPTIONS).columns == ["A, b", "_c1", "x2", "X3", "_c4"]
    rows = {r["file"]: r for r in df.collect()}
    assert rows.keys() == {"a.csv", "b.csv"}
    assert tuple(rows["b.csv"])[1:] == (["z", "x", "two\nlines"], 3, "", "", "", "", "", "6", "7", "8")
    # columns of files without rows are not known to be missing
    assert "only" not in df.columns


def test_an_unclosed_quote_is_named(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n3,\"open\n" + "x,y\n" * 500)
    with pytest.raises(ValueError, match=r"bad.csv: the record in line 3 has 20\d\d bytes"):
        records.read_records(spark, str(tmp_path), max_bytes=1000)
    assert records.read_records(spark, str(tmp_path)).count() == 3


def test_two_thousand_headers_go_through_one_plan(spark, tmp_path):
    for i in range(2000):
        (tmp_path / f"s{i}.csv").write_text(f"Customer,Parent SKU,Size {i}\nc{i},P{i},{i}\n")
    start = time.time()
    cells = records.read_cells(spark, str(tmp_path))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 6
    found = cells.select("cells").collect()
    assert len(found) == 2000 and all(len(r["cells"]) == 3 for r in found)
    assert time.time() - start < 120
    keys = cells.select(F.explode("cells").alias("name", "value")).filter("name like 'Size%'")
    assert keys.filter("name = concat('Size ', value)").count() == 2000


def test_master_file_in_splits(spark, tmp_path, splits):
    (tmp_path / "m.csv").write_bytes("SKU,EC,Category-Group\n\"x\n1\",$5,Café\nx-2,,\n".encode("latin-1"))
    splits(7)
    rows = files.read_master_csv(spark, str(tmp_path)).orderBy("sku").collect()
    assert [(r["sku"], r["ec"], r["category_group"]) for r in rows] == [("x\n1", 5.0, "Café"), ("x-2", None, None)]
