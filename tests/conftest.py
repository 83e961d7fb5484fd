import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="auric-tests-")


@pytest.fixture(scope="session")
def spark(scratch):
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .appName("auric-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from auric.context import configure_session
    configure_session(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lakehouse(spark):
    from auric.plans.lakehouse import Lakehouse
    return Lakehouse.from_testdata(spark, SF_SMALL)
