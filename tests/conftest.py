import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from finmart import build_session

    session = build_session("tests", "local[8]", **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bank(spark):
    """The warehouse over the smallest given tables."""
    from finmart.plans.warehouse import demo_warehouse

    return demo_warehouse(spark, SMALL)


@pytest.fixture
def evaluate(spark):
    """evaluate(function, values, type): the function over a column of values."""

    def run(function, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", function("v").alias("r"))
        return [r["r"] for r in df.orderBy("i").collect()]

    return run
