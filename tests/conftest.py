import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("tests")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.driver.memory": "4g",
    }
    s = builder.config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
