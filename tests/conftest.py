import tempfile

import pytest
from pyspark.sql import SparkSession

from crivo.session import tuned


@pytest.fixture(scope="session")
def spark():
    session = tuned(
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
    ).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
