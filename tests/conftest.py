import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    own = tempfile.mkdtemp(prefix="spark-")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.checkpoint.dir": f"{own}/checkpoints", "spark.local.dir": own, "spark.driver.memory": "4g"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return DATA
