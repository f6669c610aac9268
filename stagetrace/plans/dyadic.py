"""Intervals over a numbered grid as a few power-of-two blocks.

An interval that spans many grid points is cut into at most two blocks per block size, so an
aggregate that cannot be undone (max, min) over "all intervals containing point k" needs neither
one row per interval and point nor a range join: group by block, then look up the blocks above k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def height(n: int) -> int:
    """Number of block sizes above 1 needed for ``n`` points."""
    return max(n - 1, 0).bit_length()


def cover(df: DataFrame, low: str, high: str) -> DataFrame:
    """Explode ``[low, high)`` into blocks ``(blk_size, blk)``; empty intervals give no row.

    ``blk_size`` is the power of two, ``blk`` the number of the block of that size.
    """
    lo, hi = F.col(low).cast("long"), F.col(high).cast("long")
    spanned = df.filter(lo < hi)
    top = F.floor(F.log2((hi - lo).cast("double"))).cast("int") + 1
    sized = spanned.withColumn("blk_size", F.explode(F.sequence(F.lit(0), top)))
    ends = sized.selectExpr(
        "*",
        f"shiftright(CAST({low} AS BIGINT) + shiftleft(1L, blk_size) - 1, blk_size) AS _l",
        f"shiftright(CAST({high} AS BIGINT), blk_size) AS _r",
    )
    odd_left = F.when(F.col("_l") % 2 == 1, F.col("_l"))
    odd_right = F.when(F.col("_r") % 2 == 1, F.col("_r") - 1)
    return (
        ends.filter("_l < _r AND (_l % 2 = 1 OR _r % 2 = 1)")
        .withColumn("blk", F.explode(F.array_compact(F.array(odd_left, odd_right))))
        .drop("_l", "_r")
    )


def above(df: DataFrame, point: str, n: int) -> DataFrame:
    """One row per block that contains ``point``, for a grid of ``n`` points."""
    sized = df.withColumn("blk_size", F.explode(F.sequence(F.lit(0), F.lit(height(n)))))
    return sized.withColumn("blk", F.expr(f"shiftright(CAST({point} AS BIGINT), blk_size)"))
