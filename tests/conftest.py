import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stagetrace.model import EVENT_SCHEMA  # noqa: E402
from stagetrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


T0 = datetime(2020, 1, 1, 12)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture
def make_events(spark):
    """Events from ``(id, type, entity, seconds)`` rows; a type is given without its prefix."""

    def make(rows):
        data = [
            (i, None if kind is None else f"Event::{kind}", entity, at(sec), "u")
            for i, kind, entity, sec in rows]
        return spark.createDataFrame(data, EVENT_SCHEMA)

    return make


def plain(df, *columns):
    """Rows as sorted tuples."""
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in rows), key=repr)
