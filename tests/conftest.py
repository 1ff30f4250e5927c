import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from coldhaul.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("coldhaul-tests", "local[4]", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.log.level": "ERROR"})
    yield session
    session.stop()


def t(text):
    """``HH:MM[:SS]`` on the test day, or a full timestamp."""
    if len(text) <= 8:
        text = f"2024-03-01 {text}"
    return datetime.fromisoformat(text)


TRIPS = ("trip_id bigint, vehicle_id bigint, driver_id bigint, actual_start_time timestamp_ntz, "
         "actual_end_time timestamp_ntz")


def trips(spark, rows):
    return spark.createDataFrame([(i, v, 100 + i, t(s), t(e)) for i, v, s, e in rows], TRIPS)


def values(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
