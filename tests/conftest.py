import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.log.structuredLogging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyfold-"))
    yield session
    session.stop()


@pytest.fixture
def shuffle_only(monkeypatch):
    """Treat every side as too large for a broadcast."""
    from tallyfold.operators import sizing
    monkeypatch.setattr(sizing, "PINNED_ROWS", -1)
    monkeypatch.setattr(sizing.small_side, "__defaults__", (-1,))
