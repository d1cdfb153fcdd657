import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    at = tempfile.mkdtemp(prefix="spark-")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": f"{at}/warehouse", "spark.checkpoint.dir": f"{at}/shared", "spark.local.dir": f"{at}/local",
    }
    s = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
