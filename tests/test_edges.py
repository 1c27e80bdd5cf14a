"""Hand-made rows for every parsing and metric rule."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from storelens import schemas
from storelens.functions import buckets, casts, dates, ratios, text
from storelens.operators.cleaning import clean_header, normalize_headers, process_table
from storelens.operators.ordering import average_rank, top_per_group
from storelens.plans import merchandising as m
from storelens.plans import order_sheets as o

NOW = datetime(2026, 1, 10, 12)


def test_string_cast(values):
    raw = [" a ", "", "NULL", "N/A", "None", " NULL ", "  ", None, "\t b "]
    assert values(raw, casts.to_string) == ["a", None, None, None, None, "NULL", "", None, "b"]


def test_number_casts(values):
    ints = ["1,234", "12%", "-3.9", "1e3", "x", "1d", "nan", "inf", "1_000", "1e300"]
    assert values(ints, casts.to_int) == [1234, 12, -3, 1000] + [None] * 6
    assert values(["$1,234.50", "n/a", "-$5", "."], casts.to_float) == [1234.5, None, -5.0, None]
    assert values(["12.5%", "0.05", "None"], casts.to_percent) == pytest.approx(
        [0.125, 0.0005, None]
    )


def test_datetime_cast(values):
    raw = ["2024-02-03", "2024-02-03 04:05:06", "2/3/2024", "2/30/2024", "soon", "NULL",
           "2024-02-03T04:05:06Z", "Feb 3, 2024"]
    day, moment = datetime(2024, 2, 3), datetime(2024, 2, 3, 4, 5, 6)
    assert values(raw, casts.to_datetime) == [day, moment, day, None, None, None, moment, day]


def test_headers(spark):
    assert [clean_header(h) for h in ("Open Rate (%)", "  $ Sales/Qty # ", "A - B?")] == [
        "open_rate_%",
        "sales_qty",
        "a_b",
    ]
    with pytest.raises(ValueError, match="collide"):
        normalize_headers(spark.createDataFrame([(1, 2)], ["a b", "A-B"]))


def test_process_table_keeps_declared_columns_in_order(spark):
    raw = spark.createDataFrame([("7", "x", "$2.50", "3.0")], ["Quantity", "Other", "Variant Price", "Order ID"])
    df = process_table(raw, "order_lines")
    assert df.columns == ["order_id", "quantity", "variant_price"]
    assert df.collect() == [("3.0", 7, 2.5)]


def test_registry():
    assert len(schemas.TABLES) == 12
    assert len(schemas.TABLES["master_sku"]) == 60
    assert [f.name for f in schemas.struct_type("profiles")] == ["profile_id", "email"]


def test_rounding(values):
    assert values([0.5, 1.5, 2.5], lambda c: F.bround(c).cast("int"), "double") == [0, 2, 2]


def test_ratios(spark):
    rows = [(8.0, 0.0), (0.0, 0.0), (14.0, 1.0), (None, 1.0), (3.0, None)]
    df = spark.createDataFrame(rows, "q double, r double")
    weeks = df.select(ratios.weeks_of_sale(F.col("q"), F.col("r"))).collect()
    assert [w[0] for w in weeks] == [9999.0, 0.0, 2.0, 0.0, 0.0]
    prices = spark.createDataFrame([(0.0, 5.0), (10.0, None), (10.0, 4.0)], "p double, c double")
    margins = prices.select(ratios.relative_drop(F.col("p"), F.col("c"), F.col("p"))).collect()
    assert [x[0] for x in margins] == [0.0, 0.0, 0.6]


def test_low_stock_counts_null_as_false(values):
    flag = lambda c: ratios.is_true(c < m.LOW_STOCK_WEEKS).cast("int")
    assert values([None, 0.5, 1.0], flag, "double") == [0, 1, 0]


def test_buckets(values):
    assert values([0.0, 0.2, 0.2001, 0.5, 0.51, None], buckets.markdown_bucket, "double") == [
        "0% (Full Price)", "1-20%", "21-50%", "21-50%", "50%+", "50%+",
    ]
    assert values([5, 6, 12, 18, 23, None], buckets.hour_bucket, "int") == [
        "night", "morning", "afternoon", "evening", "evening", None,
    ]
    assert values([" ca ", "TX", "California", None, "ZZ"], buckets.tz_cohort) == [
        "pacific", "central", None, None, None,
    ]


def test_cohorts_cover_every_state():
    codes = list(buckets.STATE_COHORTS)
    assert len(codes) == len(set(codes)) == 51


@pytest.mark.parametrize(
    "day, kind",
    [
        ("2024-07-04", "holiday"), ("2021-07-05", "holiday"), ("2021-12-24", "holiday"),
        ("2021-12-31", "holiday"), ("2022-12-26", "holiday"), ("2024-11-28", "holiday"),
        ("2024-11-29", "workday"), ("2024-01-15", "holiday"), ("2024-05-27", "holiday"),
        ("2020-06-19", "workday"), ("2023-06-19", "holiday"), ("2024-10-14", "holiday"),
        ("2024-09-02", "holiday"), ("2024-03-16", "holiday"), ("2024-03-18", "workday"),
        ("2021-06-18", "holiday"), ("2023-11-10", "holiday"), (None, None),
    ],
)
def test_day_type(values, day, kind):
    assert values([day], lambda c: dates.day_type(c.cast("timestamp_ntz"))) == [kind]


def test_holidays_outside_the_given_years_do_not_count(values):
    days = ["2019-12-25", "2020-12-25"]
    kinds = values(days, lambda c: dates.day_type(c.cast("timestamp_ntz"), (2020, 2025)))
    assert kinds == ["workday", "holiday"]


def test_window_end_is_the_moment(values):
    start, end = datetime(2024, 11, 24), datetime(2024, 12, 2)
    rows = [datetime(2024, 12, 2), datetime(2024, 12, 2, 10), None]
    assert values(rows, lambda c: dates.within(c, start, end), "timestamp_ntz") == [True, False, False]


def test_ship_dates(spark):
    expected = {
        "ASAP": ("01/11/2026", True),
        "": ("01/11/2026", True),
        None: ("01/11/2026", True),
        "3/15": ("03/15/2026", False),
        "1/10": ("01/10/2027", False),
        "1/11": ("01/11/2026", False),
        "1/5": ("01/05/2027", False),
        "4/1 apparel": ("04/01/2026", False),
        "2/30": ("01/11/2026", True),
        "2/29": ("01/11/2026", True),
        "13/1": ("01/11/2026", True),
        "3/0": ("01/11/2026", True),
        "3-15-26": ("03/15/2026", False),
        "3/15/72": ("03/15/1972", False),
        "by 2/29/2028!": ("02/29/2028", False),
        "when ready": ("01/11/2026", True),
    }
    df = spark.createDataFrame([(k,) for k in expected], "raw string")
    found = dates.with_ship_date(df, "raw", NOW, "day", "late").collect()
    assert {r["raw"]: (r["day"], r["late"]) for r in found} == expected


def test_text(values):
    assert values(["123", " gid://shopify/Product/9 "], text.product_gid) == [
        "gid://shopify/Product/123",
        "gid://shopify/Product/9",
    ]
    assert values(["  Béla's  Shop, Inc. ", "!!"], text.match_name) == ["bélas shop inc", ""]
    assert values([" User@X.com\t"], text.email_key) == ["user@x.com"]


def test_rep_prefix(values):
    files = ["JC-3.csv", "JC1-2.csv", "zz-1.csv", "ak.csv"]
    assert values(files, o.rep_prefix) == ["JC", "JC", "ZZ", "AK"]
    assert values(files, lambda c: o.salesperson(c, {"JC": "Robin North"}))[2] == o.UNKNOWN_REP


def test_percentile_rank(spark):
    rows = list(enumerate([10, 20, 20, None, 5, None]))
    df = spark.createDataFrame(rows, "i int, v int").withColumn("g", F.lit("x"))
    ranks = df.select("i", average_rank(F.col("v"), ["g"]).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in ranks] == pytest.approx([1 / 3, 7 / 12, 7 / 12, 11 / 12, 1 / 6, 11 / 12])


def test_top_rows_put_null_last_and_keep_the_earlier_tie(spark):
    rows = [("a", 1, 5.0), ("a", 2, None), ("a", 3, 5.0), ("a", 4, 7.0)]
    df = spark.createDataFrame(rows, "g string, pos int, revenue double")
    top = top_per_group(df, ["g"], [F.desc_nulls_last("revenue"), F.asc("pos")], 4)
    assert [r["pos"] for r in top.orderBy("rank_no").collect()] == [4, 1, 3, 2]


def test_heat(values):
    assert values([0.0, 0.5, 1.0], buckets.heat_band, "double") == [-1, 0, 1]
    assert values([0.0, 0.5, 1.0], buckets.heat_alpha, "double") == pytest.approx([0.8, None, 0.8])
    inverted = lambda c: buckets.heat_band(c, invert=True)
    assert values([0.0, 0.5, 1.0], inverted, "double") == [1, 0, -1]


def test_buried_rank_formula(spark):
    cases = [
        (None, 1.0, 2.0, 0.5), (0.5, 1.0, 2.0, 0.075), (0.0, 0.0, 2.0, 0.0), (3.0, 1.0, 2.0, 1.0),
        (2.5, 1.0, 2.0, 0.85), (1.5, 1.0, 2.0, 0.5), (1.0, -1.0, 0.0, 1.0),
    ]
    df = spark.createDataFrame(cases, "v double, lo double, hi double, expected double")
    found = df.select("expected", m._relative_rank(F.col("v"), F.col("lo"), F.col("hi")).alias("r"))
    for row in found.collect():
        assert row["r"] == pytest.approx(row["expected"])
