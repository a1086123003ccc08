import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from cardrail.functions.tokens import TokenKey  # noqa: E402
from cardrail.plans.catalog import SAMPLE_KEY  # noqa: E402
from cardrail.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def key(spark):
    return TokenKey(spark, SAMPLE_KEY)


@pytest.fixture
def apply(spark):
    """Values of a column function over a list of texts."""

    def run(function, values):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r.out for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
