"""Contiguous chunks of a total order, balanced whatever the keys look like."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagetrace.functions.scalar import floor_div
from stagetrace.session import settle

CHUNK_ROWS = 20_000
# Range partitions at most: the sampler that finds the cuts has enough rows per cut up to here.
MAX_PARTS = 10_000
# Chunks whose totals one window frame sums.
SUM_ROWS = 1_000
_LOW_BITS = 33


def ordered_chunks(df: DataFrame, order: list[str], chunk_rows: int = CHUNK_ROWS,
                   max_parts: int = MAX_PARTS) -> tuple[DataFrame, int]:
    """``df`` with ``chunk`` (order of chunks) and ``pos`` (order inside one), and the chunk count.

    Rows are range partitioned by ``order``, and every partition is cut by position into chunks of
    ``chunk_rows`` rows at most, whatever the number of rows and however uneven the partitions.
    ``order`` must be unique per row, so partitions are even, even if all rows share their first
    columns. The cut points come from a sample, so the result is written once: all later reads
    agree on them. One row per partition goes through the driver.
    """
    parts = max(1, min(max_parts, math.ceil(df.count() / chunk_rows)))
    at = F.monotonically_increasing_id()
    placed = settle(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", at))
    part = F.shiftright("_at", _LOW_BITS).cast("int")
    place = F.col("_at").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())  # max_parts rows at most
    first, chunks = {}, 0
    for p, n in sizes:
        first[p] = chunks
        chunks += -(-n // chunk_rows)
    starts = F.broadcast(df.sparkSession.createDataFrame(list(first.items()) or [(0, 0)], "_part int, _first int"))
    chunked = (
        placed.withColumn("_part", part).join(starts, "_part")
        .withColumn("chunk", (F.col("_first") + floor_div(place, chunk_rows)).cast("int"))
        .withColumn("pos", F.pmod(place, F.lit(chunk_rows).cast("long")).cast("int"))
        .drop("_at", "_part", "_first")
    )
    return chunked, max(1, chunks)


def before_chunk(totals: DataFrame, by: list[str], columns: list[str],
                 sum_rows: int = SUM_ROWS) -> DataFrame:
    """Sums of ``columns`` over all earlier chunks. ``totals`` has one row per ``by`` and chunk.

    Summed in two levels, so that no window holds all chunks.
    """
    block = floor_div("chunk", sum_rows).alias("_block")
    none = F.lit(0).cast("long")

    def earlier(group: list[str], at: str):
        w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
        return w.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)

    rows = totals.select(*by, block, "chunk", *columns)
    inside = rows.select(*by, "_block", "chunk", *[
        F.coalesce(F.sum(c).over(earlier([*by, "_block"], "chunk")), none).alias(c) for c in columns])
    blocks = rows.groupBy(*by, "_block").agg(*[F.sum(c).alias(c) for c in columns])
    base = blocks.select(*by, "_block", *[
        F.coalesce(F.sum(c).over(earlier(by, "_block")), none).alias(f"_{c}") for c in columns])
    return inside.join(base, [*by, "_block"]).select(
        *by, "chunk", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in columns])
