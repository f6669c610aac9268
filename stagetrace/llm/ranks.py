"""Gapless ranks inside groups of any size, without one task per group."""

from __future__ import annotations

from math import ceil, isqrt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows that one window frame may hold, on average.
BIN_ROWS = 20_000


def running(sums: DataFrame, groups: list[str], index: str, value: str, name: str, wide: int) -> DataFrame:
    """``(groups, index, name)``: the sum of ``value`` over the smaller ``index`` of the group, in two levels of ``wide``."""
    inner = W.partitionBy(*groups, "_hi").orderBy(index).rowsBetween(W.unboundedPreceding, -1)
    outer = W.partitionBy(*groups).orderBy("_hi").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_hi", F.floor(F.col(index) / wide))
    low = sums.select(*groups, "_hi", index, F.coalesce(F.sum(value).over(inner), F.lit(0)).alias("_lo"))
    high = (sums.groupBy(*groups, "_hi").agg(F.sum(value).alias("_s"))
            .select(*groups, "_hi", F.coalesce(F.sum("_s").over(outer), F.lit(0)).alias("_up")))
    same = F.col("l._hi") == F.col("r._hi")
    for g in groups:
        same = same & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    return (low.alias("l").join(high.alias("r"), same)
            .select(*(F.col(f"l.{g}").alias(g) for g in groups), index, (F.col("_lo") + F.col("_up")).alias(name)))


def ranked(df: DataFrame, groups: list[str], order: list[str], name: str = "rank", bin_rows: int = BIN_ROWS) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... inside each group, in the order of a hash of ``order``, then ``order``.

    Rows are dealt into bins by ranges of the hash, ranked inside their bin, and moved up by the sizes of
    the bins before it. Bin sizes are summed in two levels, so no window holds more than ``bin_rows`` rows on
    average or the square root of the number of bins. ``df`` is read three times and must give the same rows each
    time (read it from a table). ``groups`` may hold NULLs; NULLs form a group. Rows equal in ``order`` get
    different ranks in any order.
    """
    bins = max(1, ceil(df.select(F.lit(1)).count() / bin_rows))
    wide = isqrt(bins - 1) + 1
    h = F.xxhash64(F.lit("rank"), *order)
    bin_ = F.floor((F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))) * bins)
    # NULL groups would not meet in a join: their text form does.
    key = F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}) if len(groups) != 1 else F.col(groups[0])
    rows = df.withColumns({"_g": key, "_h": F.shiftrightunsigned(h, 1), "_b": bin_.cast("long")})
    sizes = rows.groupBy("_g", "_b").agg(F.count("*").alias("_n"))
    base = running(sizes, ["_g"], "_b", "_n", "_base", wide).withColumnsRenamed({"_g": "_g2", "_b": "_b2"})
    one = W.partitionBy("_g", "_b").orderBy("_h", *order)
    inside = rows.withColumn("_r", F.row_number().over(one))
    return (inside.join(base, F.col("_g").eqNullSafe(F.col("_g2")) & (F.col("_b") == F.col("_b2")))
            .withColumn(name, (F.col("_base") + F.col("_r") - 1).cast("long"))
            .select(*df.columns, name))
