import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    found = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="footlights-test-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="footlights-wh-"))
        .getOrCreate()
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
