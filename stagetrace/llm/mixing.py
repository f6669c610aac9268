"""Mixing sources to target weights by subset sums.

A source's target is met in whole passes over it, then by a part of it: documents in the order of a seeded hash up to
a bin of that order in which the budget ends. Inside this bin, documents are counted by length, a bounded knapsack
over the counts finds the sum closest to what is left, and the documents of every length that it takes are the
first in the seeded order.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stagetrace.llm.ranks import running
from stagetrace.llm.store import keep
from stagetrace.plans.skew import broadcast_if_small

WEIGHTS = (5, 2, 1)
# Documents of a source in one bin of the seeded order, on average.
BIN_ROWS = 4000
# Words of a bin's budget that the knapsack fills at least, and how many times the bin's longest document it fills at
# least; what lies before is filled in the seeded order.
EXACT, LONGEST = 1 << 16, 2
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# --- targets


def targets(sizes: DataFrame, share: float, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """``(nul, src, n, source_size, target)`` of every source, from ``sizes (nul, src, n, source_size)``.

    Sources in the order of code points, NULL last, have ``weights`` in turn and share ``share`` times all sizes; no target
    exceeds ``cap`` times its source's size, what is over is shared again. That is the level at which
    ``min(cap * size, level * weight)`` adds up, found by going through the sources by the level that fills them.
    One row per source is all that is handled here, in one window.
    """
    order = W.orderBy("__nul", "__src")
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    total = F.sum("source_size").over(W.partitionBy())
    s = sizes.select("*", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("double").alias("w"),
                     (total * share).cast("double").alias("budget"), (F.col("source_size") * cap).cast("double").alias("most"))
    by = W.orderBy("full", "__nul", "__src")
    s = s.withColumn("full", F.col("most") / F.col("w"))
    s = s.withColumn("level", (F.col("budget") - F.coalesce(F.sum("most").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
                     / F.sum("w").over(by.rowsBetween(W.currentRow, W.unboundedFollowing)))
    # the first source that the level does not fill has the level of all after it
    level = F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "__nul", "__src", "level"))).over(W.partitionBy())["level"]
    s = s.withColumn("at", level)
    target = F.when(F.col("at").isNull(), F.col("most")).otherwise(F.least("most", F.col("at") * F.col("w")))
    return s.select("__nul", "__src", "n", "source_size", target.alias("target"))


# --- the knapsack


def closest_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> dict[int, int]:
    """How many of every length to take, ``counts`` at most, for the sum closest to ``budget`` (the smaller of two).

    A length's count is taken in powers of two. Every sum up to twice the budget keeps the first item that reached
    it: what is left of the sum without that item was reached by earlier ones.
    """
    if budget <= 0:
        return {}
    cap = 2 * budget
    items = []
    for length, count in zip(lengths.tolist(), counts.tolist(), strict=True):
        part = 1
        while count > 0 and length * part <= cap:
            k = min(part, count)
            if length * k <= cap:
                items.append((length, k))
            count -= k
            part *= 2
    first = np.full(cap + 1, -1, np.int32)
    first[0] = len(items)
    for i, (length, k) in enumerate(items):
        step = length * k
        new = (first[:-step] >= 0) & (first[step:] < 0)
        first[step:][new] = i
        if first[budget] >= 0:
            break
    reached = np.flatnonzero(first >= 0)
    at = int(reached[np.argmin(np.abs(reached - budget))])
    taken: dict[int, int] = {}
    while at:
        length, k = items[first[at]]
        taken[length] = taken.get(length, 0) + k
        at -= length * k
    return taken


def fill(items: pd.DataFrame, budget: float) -> np.ndarray:
    """Which rows of ``items (h, size)``, in the order of ``h``, come closest to ``budget`` together.

    Rows are taken in that order while what is left stays at ``EXACT`` words and ``LONGEST`` times the longest row or more; a row is
    no longer than that, so the knapsack's budget is at most one row above it. Its memory grows with the longest text, not with
    the bin.
    """
    items = items.sort_values("__h", kind="stable")
    size = items["size"].to_numpy()
    take = np.zeros(len(size), bool)
    least = max(EXACT, LONGEST * int(size.max(initial=0)))
    left = budget - np.cumsum(size)
    take[:int(np.searchsorted(-left, -least, side="right"))] = True
    free = np.flatnonzero(~take & (size > 0))
    lengths, counts = np.unique(size[free], return_counts=True)
    wanted = closest_sum(lengths, counts, int(round(budget - size[take].sum())))
    for i in free.tolist():
        if wanted.get(int(size[i]), 0) > 0:
            take[i] = True
            wanted[int(size[i])] -= 1
    return items["__h"].to_numpy()[take]


# --- the operator

ADDED = ("size", "source_size", "target", "times", "taken")


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 17,
        bin_rows: int = BIN_ROWS) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` (of its source), ``times`` and ``taken`` (``times * size``).

    ``docs`` has ``doc_id``, ``text`` and ``source``; columns by the added names are replaced. A NULL text has size 0, NULL sources are one
    source, the last. ``times`` is 0, 1 or 2. Rows of one source with equal id and size are taken together or not at all.
    The result is a function of the rows, ``seed`` and ``bin_rows``. Sources without a word have target 0.
    """
    docs = docs.drop(*ADDED)
    rows = docs.withColumn("size", n_words("text"))
    h = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    keyed = rows.withColumns({"__nul": F.col("source").isNull(), "__src": F.coalesce(F.col("source").cast("string"), F.lit("")), "__h": h})
    light = keep(keyed.select("__nul", "__src", "__h", "size"), "sizes")
    sizes = light.groupBy("__nul", "__src").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    plan = targets(sizes, share, cap, weights)
    plan = plan.withColumn("__passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumns({"__left": F.col("target") - F.col("__passes") * F.col("source_size"),
                             "__bins": F.ceil(F.col("n") / bin_rows)})
    plan, _ = broadcast_if_small(plan, derived=True)

    key = ["__nul", "__src"]
    bin_ = F.floor(F.shiftrightunsigned("__h", 11) / F.lit(float(1 << 53)) * F.col("__bins"))
    binned = light.join(plan.select(*key, "__bins", "__left"), key).withColumn("bin", bin_)
    sums = binned.groupBy(*key, "bin").agg(F.sum("size").alias("sum"), F.first("__left").alias("__left"))
    sums = keep(sums, "__bins")
    wide = isqrt(max(1, sums.agg(F.max("bin")).first()[0] or 1)) + 1
    ends = (running(sums, key, "bin", "sum", "before", wide).join(sums, [*key, "bin"])
            .filter(F.col("before") + F.col("sum") > F.col("__left"))
            .groupBy(*key).agg(F.min(F.struct("bin", (F.col("__left") - F.col("before")).alias("rest"))).alias("e"))
            .select(*key, F.col("e.bin").alias("__end"), F.col("e.rest").alias("rest")))
    ends, few = broadcast_if_small(ends, derived=True)
    last = (binned.join(ends, key).filter("bin = __end").groupBy(*key, "__h")
            .agg(F.sum("size").alias("size"), F.first("rest").alias("rest")))

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        chosen = fill(group[["__h", "size"]], float(group["rest"].iloc[0]))
        return pd.DataFrame({"__nul": group["__nul"].iloc[0], "__src": group["__src"].iloc[0], "__h": chosen})

    picked = last.groupBy(*key).applyInPandas(pick, "__nul boolean, __src string, __h long")
    picked, _ = broadcast_if_small(picked.withColumn("__picked", F.lit(1)), derived=True)

    out = keyed.join(plan.select(*key, "source_size", "target", "__passes", "__bins"), key)
    out = out.join(ends.select(*key, "__end"), key, "left").join(picked, [*key, "__h"], "left")
    part = F.when(F.col("__end").isNull(), 0).when(bin_ < F.col("__end"), 1).otherwise(F.coalesce("__picked", F.lit(0)))
    times = (F.col("__passes") + part).cast("int")
    return out.withColumn("times", times).select(*rows.columns, "source_size", "target", "times",
                                                 (F.col("times") * F.col("size")).cast("long").alias("taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The rows that the mix takes, with the columns of ``docs`` as they are; a document taken twice is there twice."""
    own = {c: f"__own_{c}" for c in docs.columns if c in ADDED}
    rows = mix(docs.withColumnsRenamed(own), **options).filter("times > 0")
    columns = [F.col(own.get(c, c)).alias(c) for c in docs.columns]
    return rows.select(*columns, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("__again")).drop("__again")
