"""Counts per state after every single event.

The events are laid out once in time order, cut into even chunks. Inside a chunk everything is
local; what a chunk needs from outside is one small row: counts at its start, and the latest
start among the stays that span it whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrace.functions.scalar import micros_between, ntz
from stagetrace.model import FORWARD, TransitionTable
from stagetrace.operators.lifecycle import KEY, _start, event_moves
from stagetrace.plans.chunks import CHUNK_ROWS, before_chunk, ordered_chunks
from stagetrace.plans.dyadic import above, cover
from stagetrace.plans.skew import broadcast_if_small
from stagetrace.session import settle

_EPOCH = "1970-01-01 00:00:00"
_NONE = -(2 ** 62)


def _moves(events: DataFrame, table: TransitionTable, anchor: str, chunk_rows: int,
           opts: dict) -> tuple[DataFrame, int]:
    """Every event in time order with the state it enters and leaves, if any.

    A visit is known by its entity, state and entering event, so event ids may repeat.

    The fold is written once, then cut by time: finding the cuts reads the times a second time.
    """
    moves = settle(event_moves(events, table, **opts))
    from_first = _start(anchor) == "first_seen"
    us = lambda c: micros_between(ntz(_EPOCH), c)
    entered = F.col("entered")
    visit = lambda start, id_, state: F.struct(
        F.col(KEY).alias("f_id"), F.col(start).alias("start"), F.col(id_).alias("id"), F.col(state).alias("state"))
    left = F.col("prev_id").isNotNull()
    return ordered_chunks(moves.select(
        "created_at", "id", KEY,
        F.when(entered, visit("created_at", "id", "state_after")).alias("visit"),
        F.when(left, visit("prev_start", "prev_id", "state_before")).alias("prev_visit"),
        F.when(entered, F.col("state_after")).alias("state"),
        F.when(entered, F.col("state_before")).alias("prev_state"), "prev_id",
        F.when(entered, us("first_seen" if from_first else "created_at")).alias("start_us"),
        F.when(entered, us("first_seen" if from_first else "prev_start")).alias("prev_us"),
    ), ["created_at", "id", KEY], chunk_rows)


def _change(i: int, state: str) -> Column:
    """What an event adds to the count of ``state``."""
    return (F.when(F.col("state") == state, 1).otherwise(0)
            - F.when(F.col("prev_state") == state, 1).otherwise(0)).cast("long").alias(f"n{i}")


def _opening_counts(rows: DataFrame, states) -> DataFrame:
    """Counts before each chunk, as ``b0 ... bk``."""
    names = [f"n{i}" for i in range(len(states))]
    changes = rows.select("chunk", *[_change(i, s) for i, s in enumerate(states)])
    totals = changes.groupBy("chunk").agg(*[F.sum(c).alias(c) for c in names])
    return before_chunk(totals, [], names).withColumnsRenamed({f"n{i}": f"b{i}" for i in range(len(states))})


def _by_chunk(rows: DataFrame, small: bool, run, schema: str) -> DataFrame:
    """``run`` on every chunk. ``rows`` still lie as they were laid out unless a join moved them:
    then a chunk lies whole in one partition, and nothing is shuffled."""
    if not small:
        return rows.groupBy("chunk").applyInPandas(run, schema)

    def parts(batches):
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if len(rest):
                last = rest["chunk"].iloc[-1]
                done = rest[rest["chunk"] != last]
                rest = rest[rest["chunk"] == last]
                for _, chunk in done.groupby("chunk"):
                    yield run(chunk)
        if rest is not None and len(rest):
            yield run(rest)

    return rows.mapInPandas(parts, schema)


def running_counts(events: DataFrame, table=FORWARD, chunk_rows: int = CHUNK_ROWS,
                   **opts) -> DataFrame:
    """After every event the number of entities per state, one column per state, 0 included."""
    table = TransitionTable.of(table)
    states, k = table.states, len(table.states)
    rows, _ = _moves(events, table, "state_start", chunk_rows, opts)
    base, small = broadcast_if_small(_opening_counts(rows, states), derived=True)
    ready = rows.join(base, "chunk").select(
        "chunk", "pos", "id", micros_between(ntz(_EPOCH), "created_at").alias("created_us"),
        *[_change(i, s) for i, s in enumerate(states)], *[f"b{i}" for i in range(k)])

    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("pos", ignore_index=True)
        out = chunk[["created_us", "id"]].copy()
        for i in range(k):
            out[f"n{i}"] = chunk[f"n{i}"].cumsum() + chunk[f"b{i}"]
        return out

    id_type = rows.schema["id"].dataType.simpleString()
    longs = ", ".join(f"n{i} bigint" for i in range(k))
    found = _by_chunk(ready, small, run, f"created_us bigint, id {id_type}, {longs}")
    return found.select(
        F.timestamp_add("MICROSECOND", F.col("created_us"), ntz(_EPOCH)).alias("created_at"), "id",
        *[F.col(f"n{i}").alias(s.lower()) for i, s in enumerate(states)])


def _spanning(rows: DataFrame, states, n: int) -> DataFrame:
    """Per chunk and state the latest start of stays that began before and end after the chunk."""
    chunks = rows.sparkSession.range(n).select(F.col("id").cast("int").alias("chunk"))
    enter = rows.filter(F.col("state").isin(list(states))).select("visit", "chunk", "state", "start_us")
    leave = rows.filter(F.col("prev_id").isNotNull() & F.col("prev_state").isin(list(states))).select(
        F.col("prev_visit").alias("visit"), F.col("chunk").alias("left_in"))
    spans = enter.join(leave, "visit", "left").select(
        "state", "start_us", (F.col("chunk") + 1).alias("lo"),
        F.coalesce("left_in", F.lit(n)).alias("hi"))
    blocks = cover(spans, "lo", "hi").groupBy("state", "blk_size", "blk").agg(
        F.max("start_us").alias("start_us"))
    blocks, _ = broadcast_if_small(blocks, derived=True)
    columns = [
        F.coalesce(F.max(F.when(F.col("state") == s, F.col("start_us"))), F.lit(_NONE)).alias(f"m{i}")
        for i, s in enumerate(states)]
    wide = above(chunks, "chunk", n).join(blocks, ["blk_size", "blk"], "left").groupBy("chunk")
    return wide.agg(*columns)


def _paint(n: int, lo, hi, value) -> np.ndarray:
    """Largest ``value`` among the intervals ``[lo, hi)`` over each of ``n`` points."""
    size = 1 << max(n - 1, 0).bit_length()
    tree = np.full(2 * size, _NONE, dtype=np.int64)
    left, right = lo + size, hi + size
    while (left < right).any():
        open_ = left < right
        take = open_ & (left % 2 == 1)
        np.maximum.at(tree, left[take], value[take])
        left = left + take
        take = open_ & (right % 2 == 1)
        right = right - take
        np.maximum.at(tree, right[take], value[take])
        left, right = left // 2, right // 2
    width = 1
    while width < size:
        parents = np.repeat(tree[width:2 * width], 2)
        np.maximum(tree[2 * width:4 * width], parents, out=tree[2 * width:4 * width])
        width *= 2
    return tree[size:size + n]


def _latest_starts(k: int):
    """Per chunk: latest start among the open stays of each state after every event."""

    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("pos", ignore_index=True)
        n = len(chunk)
        pos = np.arange(n)
        enters = chunk["state_ix"].to_numpy() >= 0
        entered_at = pd.Series(pos[enters], index=chunk["visit"][enters])
        leaves = chunk["prev_ix"].to_numpy() >= 0
        came = entered_at.reindex(chunk["prev_visit"]).to_numpy()
        local = leaves & ~np.isnan(came)
        until = np.full(n, n)
        until[came[local].astype(int)] = pos[local]
        state, prev = chunk["state_ix"].to_numpy(), chunk["prev_ix"].to_numpy()
        start, prev_start = chunk["start_us"].to_numpy(), chunk["prev_us"].to_numpy()
        out = chunk[["created_us", "id"]].copy()
        for i in range(k):
            out[f"n{i}"] = chunk[f"n{i}"].cumsum() + chunk[f"b{i}"]
        for i in range(k):
            here = state == i
            older = leaves & ~local & (prev == i)
            found = _paint(
                n,
                np.concatenate([pos[here], np.zeros(older.sum(), dtype=int)]),
                np.concatenate([until[here], pos[older]]),
                np.concatenate([start[here], prev_start[older]]))
            out[f"m{i}"] = np.maximum(found, chunk[f"m{i}"].to_numpy())
        return out

    return run


def running_census(events: DataFrame, table=FORWARD, anchor: str = "state_start",
                   chunk_rows: int = CHUNK_ROWS, states: tuple[str, ...] | None = None,
                   **opts) -> DataFrame:
    """After every event, per state that occurs: number of entities and latest start.

    ``(created_at, id, state, n, max_start)``; ``created_at, id`` name the event. ``states`` names
    the states wanted; all of the table by default.
    """
    table = TransitionTable.of(table)
    states = [s for s in table.states if states is None or s in states]
    k = len(states)
    rows, n = _moves(events, table, anchor, chunk_rows, opts)
    outer = _spanning(rows, states, n).join(_opening_counts(rows, states), "chunk")
    outer, small = broadcast_if_small(outer, derived=True)
    index = lambda c: F.coalesce(
        F.array_position(F.array(*[F.lit(s) for s in states]), F.col(c)) - 1, F.lit(-1)).cast("int")
    none = F.lit(_NONE)
    ready = rows.join(outer, "chunk").select(
        "chunk", "pos", "id", micros_between(ntz(_EPOCH), "created_at").alias("created_us"),
        index("state").alias("state_ix"), index("prev_state").alias("prev_ix"),
        F.coalesce("start_us", none).alias("start_us"), F.coalesce("prev_us", none).alias("prev_us"),
        # hashes: only events of one chunk are compared
        F.xxhash64("visit").alias("visit"), F.xxhash64("prev_visit").alias("prev_visit"),
        *[_change(i, s) for i, s in enumerate(states)],
        *[F.col(f"{c}{i}") for c in "bm" for i in range(k)])
    id_type = rows.schema["id"].dataType.simpleString()
    longs = ", ".join(f"{c}{i} bigint" for c in "nm" for i in range(k))
    found = _by_chunk(ready, small, _latest_starts(k), f"created_us bigint, id {id_type}, {longs}")
    time = lambda c: F.timestamp_add("MICROSECOND", c, ntz(_EPOCH))
    per_state = F.array(*[
        F.struct(F.lit(s).alias("state"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("m"))
        for i, s in enumerate(states)])
    return (
        found.select(time(F.col("created_us")).alias("created_at"), "id", F.inline(per_state))
        .filter("n > 0")
        .select("created_at", "id", "state", "n", time(F.col("m")).alias("max_start")))


def peak_waiting(census: DataFrame, state: str = "WAITING") -> DataFrame:
    """Highest count of ``state`` and every start time at which it was reached.

    Counts are kept per latest start time; a later event with the same start time replaces the
    count. ``census`` has the columns of ``running_census``.
    """
    per_start = settle(census.filter(F.col("state") == state).groupBy("max_start").agg(
        F.max_by("n", F.struct("created_at", "id")).alias("n")))
    top = F.broadcast(per_start.agg(F.max("n").alias("n")))
    return per_start.join(top, "n").select("max_start", "n")
