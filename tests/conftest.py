import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from litpulse.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not TESTDATA.exists():
        pytest.skip("no test tables")
    return str(TESTDATA)


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and DDL."""

    def build(data, ddl):
        return spark.createDataFrame(data, ddl)

    return build


@pytest.fixture
def one(spark):
    """Evaluate a column expression over one text value."""
    from pyspark.sql import functions as F

    def value(fn, text, kind="string"):
        df = spark.createDataFrame([(text,)], f"x {kind}")
        return df.select(fn(F.col("x")).alias("y")).first()[0]

    return value
