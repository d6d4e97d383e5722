import os

import pytest
from pyspark.sql import SparkSession

from candlewick.workspace import clean_up

TESTDATA = os.environ.get("CANDLEWICK_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("candlewick-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "2000")
        # A zone with daylight saving, far from UTC: results must not depend on it.
        .config("spark.sql.session.timeZone", "Australia/Lord_Howe")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clean_up(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.01"
