import pytest

from storelens.catalog.views import RetailTables
from storelens.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return RetailTables(spark, SMALL)


@pytest.fixture(scope="session")
def values(spark):
    """Rows of one column mapped by an expression, in input order."""
    from pyspark.sql import functions as F

    def run(rows, expression, kind="string"):
        df = spark.createDataFrame(list(enumerate(rows)), f"i int, x {kind}")
        mapped = df.select("i", expression(F.col("x")).alias("y")).collect()
        return [row["y"] for row in sorted(mapped, key=lambda r: r["i"])]

    return run
