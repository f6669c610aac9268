"""Events cut into consecutive intervals of a replay."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrace.functions.scalar import ceil_div, floor_div, micros, micros_between, ntz
from stagetrace.model import TRACKED_TYPES
from stagetrace.operators.cleaning import scan_events


def interval_batches(events: DataFrame, start: datetime, end: datetime,
                     step: timedelta = timedelta(seconds=1), boundary: str = "half_open",
                     drop_tail: bool = False, types=TRACKED_TYPES) -> DataFrame:
    """Events with the number and bounds of their interval, row by row and without a shuffle.

    ``half_open`` puts an event on an edge into the interval that starts there. ``closed`` reads
    it in both intervals it touches. ``drop_tail`` leaves out intervals that do not finish before
    ``end``.
    """
    width, total = micros(step), micros(end - start)
    last = max(-(-total // width) - 1, 0)
    inside = scan_events(events, start, end, types, boundary)
    passed = micros_between(ntz(start), "created_at")
    slot = floor_div(passed, width)
    if boundary == "closed":
        first = F.greatest(F.lit(0).cast("long"), ceil_div(passed, width) - 1)
        upto = F.least(F.lit(last).cast("long"), slot)
        batched = inside.withColumn("slot", F.explode(F.sequence(first, upto)))
    else:
        batched = inside.withColumn("slot", slot)
    if drop_tail:
        batched = batched.filter((F.col("slot") + 1) * F.lit(width) < F.lit(total))
    at = lambda n: F.timestamp_add("MICROSECOND", n * F.lit(width), ntz(start))
    return batched.withColumns({
        "slot_start": at(F.col("slot")),
        "slot_end": at(F.col("slot") + 1),
    })


def batch_sizes(batches: DataFrame) -> DataFrame:
    return batches.groupBy("slot", "slot_start").agg(F.count("*").alias("n"))
