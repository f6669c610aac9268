from datetime import datetime, timedelta

import pytest
from conftest import T0
from pyspark.sql import functions as F

from stagetrace.functions import scalar as s


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, want", [
    ("2019-12-12 00:00:01", datetime(2019, 12, 12, 0, 0, 1)),
    ("2020-02-07 00:21:17.242125", datetime(2020, 2, 7, 0, 21, 17, 242125)),
    ("not a time", None),
])
def test_parse_time(spark, text, want):
    assert one(spark, s.parse_time(F.lit(text))) == want


def test_format_truncates(spark):
    assert one(spark, s.format_seconds(s.ntz(datetime(2020, 1, 1, 5, 6, 7, 999999)))) == "2020-01-01 05:06:07"


@pytest.mark.parametrize("delta", [
    timedelta(0), timedelta(seconds=59, microseconds=999999), timedelta(days=3, seconds=5),
    timedelta(seconds=-1), timedelta(microseconds=-1), timedelta(days=-2, microseconds=1)])
def test_whole_seconds(spark, delta):
    a, b = s.ntz(T0), s.ntz(T0 + delta)
    assert one(spark, s.whole_seconds(a, b, True)) == delta.seconds
    assert one(spark, s.whole_seconds(a, b)) == delta // timedelta(seconds=1)
    assert one(spark, s.seconds_between(a, b)) == delta.total_seconds()


@pytest.mark.parametrize("value", [-7, -1, 0, 1, 5, 9, 10, 11, 2 ** 52 + 3])
def test_integer_division(spark, value):
    v = F.lit(value).cast("long")
    assert one(spark, s.floor_div(v, 5)) == value // 5
    assert one(spark, s.ceil_div(v, 5)) == -(-value // 5)


@pytest.mark.parametrize("wait, bucket", [
    (-5, 1), (0, 1), (60, 1), (60.5, 2), (61, 2), (120, 2), (900, 15), (900.5, 16), (901, 16), (1e6, 16),
    (None, None)])
def test_wait_bucket(spark, wait, bucket):
    us = F.lit(None if wait is None else int(wait * 1e6)).cast("long")
    assert one(spark, s.wait_bucket(us, timedelta(minutes=1), 15)) == bucket


def test_colour_key(spark):
    assert one(spark, s.colour_key(F.lit(15905113))) == "#C55479"
    assert one(spark, s.colour_key(F.lit(7))) == "#000037"


def test_local_time(spark):
    t = s.ntz(datetime(2020, 7, 1, 12))
    assert one(spark, s.local_time(t, "America/Chicago")) == "2020-07-01 07:00:00"


def test_time_grid(spark):
    grid = one(spark, s.time_grid(T0, T0 + timedelta(seconds=3), timedelta(seconds=1)))
    assert grid == [T0 + timedelta(seconds=k) for k in range(4)]


def test_event_state(spark):
    assert one(spark, s.event_state(F.lit("Event::LaunchEnd"))) == "TESTING"
    assert one(spark, s.event_state(F.lit("Event::Else"))) == "UNKNOWN"
    assert one(spark, s.event_state(F.lit(None).cast("string"))) == "UNKNOWN"


def test_minutes(spark):
    assert one(spark, s.to_minutes(F.lit(90.0))) == 1.5


def test_division_is_exact_for_every_long(spark):
    values = [0, 1, -1, 63, -64, 2**53 + 1, -(2**53) - 1, 2**63 - 1, -(2**63), 2**62 + 7]
    for by in (1, 7, 64, 1000, 10**6):
        rows = spark.createDataFrame([(v,) for v in values], "v long").select(
            "v", s.floor_div("v", by).alias("down"), s.ceil_div("v", by).alias("up")).collect()
        assert [(r.down, r.up) for r in rows] == [(v // by, -(-v // by)) for v in values]
