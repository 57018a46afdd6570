import os
import shutil
import sys
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from platterwatch import schema  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="platterwatch-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", base)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    shutil.rmtree(base, ignore_errors=True)


@pytest.fixture(scope="session")
def folder():
    return DATA


@pytest.fixture
def telemetry(spark):
    """Rows as (time text, vault, failure, temperature, model, serial) to a telemetry table."""

    def make(rows):
        full = [
            (datetime.fromisoformat(at), serial, model, int(failure), vault, float(temp), None)
            for at, vault, failure, temp, model, serial in rows
        ]
        return spark.createDataFrame(full, schema.TELEMETRY).withColumn(
            "ingest_ts", F.col("event_ts")
        )

    return make


@pytest.fixture
def line():
    """One wire line."""

    def make(at, serial="s", model="m", failure="0", vault="1000", temp="20.5"):
        fields = [at, serial, model, failure, vault] + [""] * 20 + [temp] + [""] * 13
        return ",".join(fields)

    return make
