"""Scalar functions: columns in, column out, all evaluated in the JVM."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagetrace.model import MESSAGE_SCHEMA, TYPE_STATE, UNKNOWN

# Text formats of times.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
SECONDS_PATTERN = "yyyy-MM-dd HH:mm:ss"
DAY_SECONDS = 86_400
MICROS = 1_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(value: timedelta) -> int:
    return value // timedelta(microseconds=1)


def ntz(value) -> Column:
    """A fixed point in time as a zone-free timestamp."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def event_state(event_type) -> Column:
    """State an event type triggers; UNKNOWN for all others."""
    out = None
    for t, s in TYPE_STATE.items():
        test = _col(event_type) == t
        out = F.when(test, s) if out is None else out.when(test, s)
    return out.otherwise(UNKNOWN)


def parse_time(text) -> Column:
    """Zone-free time from text with or without a fraction; NULL when it is not a time."""
    return F.try_to_timestamp(_col(text), F.lit(TIME_PATTERN)).cast("timestamp_ntz")


def format_seconds(t) -> Column:
    return F.date_format(_col(t), SECONDS_PATTERN)


def micros_between(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def floor_div(value, by: int) -> Column:
    """Whole ``value / by`` rounded down, exact for every long; ``by`` is positive."""
    v, d = _col(value), F.lit(by).cast("long")
    return F.call_function("div", v, d) - F.when(v % d < 0, 1).otherwise(0)


def ceil_div(value, by: int) -> Column:
    """Whole ``value / by`` rounded up, exact for every long; ``by`` is positive."""
    v, d = _col(value), F.lit(by).cast("long")
    return F.call_function("div", v, d) + F.when(v % d > 0, 1).otherwise(0)


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds with the fraction, as a double."""
    return micros_between(start, end) / F.lit(float(MICROS))


def whole_seconds(start, end, wrap_days: bool = False) -> Column:
    """``end - start`` rounded down to seconds; ``wrap_days`` drops whole days."""
    secs = floor_div(micros_between(start, end), MICROS)
    return F.pmod(secs, F.lit(DAY_SECONDS).cast("long")) if wrap_days else secs


def to_minutes(seconds) -> Column:
    return _col(seconds) / F.lit(60.0)


def encode_message(columns=MESSAGE_SCHEMA.fieldNames()) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def decode_message(value) -> Column:
    return F.from_json(_col(value).cast("string"), MESSAGE_SCHEMA)


def legacy_field(value, index: int) -> Column:
    return F.get(F.split(_col(value).cast("string"), " "), index)


def colour_key(key) -> Column:
    """Stable ``#RRGGBB`` for an id: base-31 hash of its characters, low 24 bits."""
    codes = F.transform(F.split(_col(key).cast("string"), ""), F.ascii)
    low24 = F.aggregate(
        codes,
        F.lit(0).cast("long"),
        lambda h, c: (h * 31 + c).bitwiseAND(F.lit(0xFFFFFF).cast("long")),
    )
    return F.concat(F.lit("#"), F.lpad(F.hex(low24), 6, "0"))


def local_time(t, zone: str, pattern: str = SECONDS_PATTERN) -> Column:
    """Text of a zone-free UTC time as seen in ``zone``."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(t).cast("timestamp_ntz")), pattern)


def time_grid(start, end, step: timedelta) -> Column:
    """Array ``start, start + step, ...`` up to ``end`` at most."""
    return F.sequence(ntz(start), ntz(end), F.expr(f"interval {micros(step)} microseconds"))


def wait_bucket(wait_micros, width: timedelta, n: int) -> Column:
    """1-based bucket ``(lo, hi]`` of a wait; ``n + 1`` above the last, 1 for all up to ``width``."""
    w = _col(wait_micros)
    bucket = F.least(F.lit(n + 1).cast("long"), ceil_div(w, micros(width)))
    return F.when(w.isNotNull(), F.greatest(F.lit(1).cast("long"), bucket).cast("int"))


def counts_json(entries) -> Column:
    """JSON text of ``array<struct<state, n>>``."""
    return F.to_json(F.map_from_entries(_col(entries)))
