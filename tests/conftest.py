import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("loamsift-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_of(spark):
    """RAW rows from (text, domain[, quality]) tuples; the position is the id."""
    from loamsift.schemas import RAW

    def make(rows):
        data = []
        for i, row in enumerate(rows):
            text, domain = row[0], row[1]
            quality = row[2] if len(row) > 2 else None
            data.append((i, text, domain, quality, "s", (len(text), len(text.split()), "s", None, None)))
        return spark.createDataFrame(data, RAW)

    return make


@pytest.fixture
def texts_of(spark):
    def make(texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    return make
