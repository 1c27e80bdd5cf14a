"""Sheets: nothing is parsed, decoded or moved again that was so before, and what is
spared gives the same cells."""

from pyspark.sql import functions as F

from storelens.catalog import CATALOG
from storelens.functions.text import WHITESPACE, nonempty, strip_cell
from storelens.operators.reshape import unpivot_sizes
from storelens.sources import records
from tests.conftest import SMALL
from tests.test_plans import plan_of

CELLS = [
    "a,b,c", "a", ",", ",,", " a , b", "a,b,c,d,e", 'x"y,b', '"a,b",c', '"a""b",,c', '"a\nb",c', "a\rb,c",
    "é,ü,ß", "a,\"b", "   ", "\t,x", "#a,b", "a,null,NaN", "\0a,b", "a\0,b",
]


def test_cells_are_those_of_the_parser(spark):
    df = spark.createDataFrame(list(enumerate(CELLS)), "i int, text string")
    names = ["c0", "c1", "c2"]
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    parsed = F.from_csv("text", ", ".join(f"{n} string" for n in names), options)
    wanted = df.select("i", F.array(*[F.coalesce(parsed[n], F.lit("")) for n in names]).alias("own"))
    found = records._with_cells(df, "text", 3, "cut").select("i", F.slice("cut", 1, 3).alias("own"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_cells_are_stripped_as_before(spark):
    texts = [None, "", "a", "ab", " a", "a ", "a ", "　a", "é", " é ", "aé", "~", "!", "\x7f", "a\x00"]
    texts += [w + "x" + w for w in WHITESPACE]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for row in df.select("x", strip_cell("x").alias("a"), nonempty(F.col("x")).alias("b")).collect():
        assert row["a"] == row["b"], repr(row["x"])


def test_long_form_is_no_lambda(spark):
    rows = [("P", ["S", "other", "M"], "1", "x"), ("P", ["M", "S"], "0", "2.9"), ("", ["S"], "3", "1")]
    sheet = spark.createDataFrame(rows, "parent_sku string, header array<string>, S string, M string")
    long = unpivot_sizes(sheet, [], {"S": "S", "M": "M"})
    assert sorted(map(tuple, long.collect())) == [("P", 0, "M", 2), ("P", 0, "S", 1)]
    assert "lambda" not in plan_of(long)


def test_records_are_parsed_before_filters(spark):
    plan = plan_of(CATALOG.queries["sheet_folder_items"].run(spark, SMALL))
    # the one parser left reads the header of each file
    assert plan.count("csv-rows") == 1 and "csv-lines" not in plan and "decode" not in plan


def test_import_rows_are_stored_before_they_are_dealt(spark):
    assert "Join" not in plan_of(CATALOG.queries["import_files"].run(spark, SMALL))


def test_lines_are_not_moved_to_customers(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = type(tables)(spark, SMALL).order_sheet._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    customers = next(line for line in plan.splitlines() if "o_custkey" in line and "Join" in line)
    lines = next(line for line in plan.splitlines() if "l_orderkey" in line and "Join" in line)
    assert plan.index(lines) < plan.index(customers)
