import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tidegauge.session import configure, remove_written  # noqa: E402
from tidegauge.sources.dictionary import default_device_types, snapshot  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    remove_written(session)
    session.stop()


@pytest.fixture(scope="session")
def device_types(spark):
    return snapshot(default_device_types(spark))


def message(**changes):
    """The documented sample event, with fields replaced by raw JSON text, or left out when None."""
    fields = {
        "device_id": '"device_001"',
        "device_type_id": "3",
        "event_time": '"2026-06-02T16:54:10.123456+00:00"',
        "temperature": "25.31",
        "humidity": "60.57",
        **changes,
    }
    return "{" + ",".join(f'"{k}":{v}' for k, v in fields.items() if v is not None) + "}"


def messages_frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")
