import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gustline.session import build_session  # noqa: E402

SENSOR_SCHEMA = (
    "turbine_id string, ts timestamp_ntz, wind_speed double, temperature double, power double, frequency double")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def stamp(i, start=dt.datetime(2024, 1, 1)):
    return start + dt.timedelta(minutes=10 * i)


@pytest.fixture
def scada(spark):
    """Build a frame from per-slot values; absent sensors are null."""
    def build(turbine="TB01", n=None, skip=(), **values):
        n = n or len(next(iter(values.values())))
        rows = [
            (turbine, stamp(i), *[values[s][i] if s in values else None
                                  for s in ("wind_speed", "temperature", "power", "frequency")])
            for i in range(n) if i not in skip]
        return spark.createDataFrame(rows, SENSOR_SCHEMA)
    return build
