import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))

from hirelake.session import SESSION_DEFAULTS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "4g"))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
