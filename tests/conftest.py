import os

import pytest
from pyspark.sql import SparkSession

from haulrate import Limits

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Every table too large to broadcast, every card too large for literals, every key hot.
FORCED = Limits(broadcast_rows=0, literal_rows=0, keyword_rows=0, hot_rows=1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("haulrate-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


# Tables small enough to broadcast, no card small enough for literals.
BROADCAST = Limits(literal_rows=0, keyword_rows=0)


@pytest.fixture(params=["small", "broadcast", "forced"])
def limits(request):
    return {"small": Limits(), "broadcast": BROADCAST, "forced": FORCED}[request.param]
