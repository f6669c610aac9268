"""Size checks: what may be broadcast, and which keys are too large for one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrace.session import settle

# Rows of one key that one task may hold. Keys above it are cut into chunks.
HOT_ROWS = 20_000
# Rows of a narrow table (key plus a few fixed-width values) that may be broadcast.
BROADCAST_ROWS = 1_000_000
# Slots that keys are hashed into before keys are counted; without hot keys no slot is full up to a thousand million rows.
HOT_SLOTS = 1 << 16


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                       derived: bool = False) -> tuple[DataFrame, bool]:
    """``df`` marked for broadcast when a count shows at most ``max_rows``; else ``df`` as it is.

    ``derived`` says that ``df`` is costly to work out: it is then written once and only counted.
    """
    if derived:
        df = settle(df)
    if df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df), True
    return df, False


@dataclass
class HotSplit:
    cold: DataFrame
    hot: DataFrame | None
    keys: DataFrame | None


def split_hot(df: DataFrame, key: str, hot_rows: int | None = HOT_ROWS) -> HotSplit:
    """Rows of ordinary keys, and rows of keys with more than ``hot_rows`` rows.

    The count is pre-aggregated before its shuffle and reads the key column only. A hot key makes its
    slot of a hash full, so keys are only counted when one of the few slots is. There are at most
    ``rows / hot_rows`` hot keys; they are broadcast when the count confirms they are few,
    and otherwise joined by a shuffle. Rows with a NULL key stay on the cold side.
    ``hot_rows=None`` means the caller knows that no key is large.
    """
    if hot_rows is None:
        return HotSplit(df, None, None)
    slots = df.filter(F.col(key).isNotNull()).groupBy(F.pmod(F.xxhash64(key), F.lit(HOT_SLOTS)).alias("_slot")).count()
    if not slots.filter(F.col("count") > hot_rows).take(1):
        return HotSplit(df, None, None)
    heavy = df.groupBy(key).count().filter(F.col(key).isNotNull() & (F.col("count") > hot_rows))
    keys, _ = broadcast_if_small(heavy.select(key), derived=True)
    if not keys.take(1):
        return HotSplit(df, None, None)
    return HotSplit(df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi"), keys)


def skewed_join(left: DataFrame, right: DataFrame, key: str, how: str,
                hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Join to a ``right`` with unique keys when a few keys may hold most rows of ``left``.

    Rows of hot keys stay where they are and meet the few matching right rows by broadcast;
    all others take the ordinary join. ``how`` is ``left_semi``, ``left_anti``, ``inner`` or ``left``.
    """
    split = split_hot(left, key, hot_rows)
    columns = left.columns
    if how in ("inner", "left"):
        columns = columns + [c for c in right.columns if c != key]
    out = split.cold.join(right, key, how)
    if split.hot is not None:
        few, _ = broadcast_if_small(right.join(split.keys, key, "left_semi"))
        out = out.unionByName(split.hot.join(few, key, how))
    return out.select(*columns)
