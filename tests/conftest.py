import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="vitrine-warehouse-"),
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="vitrine-test-")


@pytest.fixture
def one(spark):
    """Value of an expression over one row of named inputs."""
    from pyspark.sql import functions as F

    def run(build, dtype="string", *values):
        names = [f"a{i}" for i in range(len(values))]
        df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} {dtype}" for n in names))
        return df.select(build(*[F.col(n) for n in names]).alias("r")).first()["r"]

    return run
