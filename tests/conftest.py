import os
import sys
import tempfile

import pytest

os.environ["PYTHONPATH"] = ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.local.dir": tempfile.mkdtemp(prefix="spark-"), "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-")}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SF = "/root/testdata/sf0.001"
