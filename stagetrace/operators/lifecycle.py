"""Per-entity state over time, from events and a transition table.

Everything here rests on ``state_visits``: one row per stay of an entity in a state. Changes,
history, intervals, durations and the current state are projections or filters of it.

An ordinary entity is one group of one shuffle: its events are sorted inside the group and folded
by the transition table. An entity with more events than one task should hold is cut into
contiguous chunks. A chunk alone gives a function from incoming to outgoing state; a scan over the
chunks' functions yields each chunk's incoming state, after which all chunks fold in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagetrace.functions.scalar import floor_div, whole_seconds
from stagetrace.model import FORWARD, LAST_WINS, TransitionTable
from stagetrace.operators.cleaning import usable
from stagetrace.plans.chunks import CHUNK_ROWS, ordered_chunks
from stagetrace.plans.skew import HOT_ROWS, broadcast_if_small, split_hot
from stagetrace.session import settle

KEY = "fulfillment_id"
ANCHORS = ("state_start", "first_seen")
FOLD_BLOCK = 64
# Functions of neighbouring chunks that one task composes.
SCAN_BLOCK = 64


def _coded(events: DataFrame, table: TransitionTable, on_unknown: str,
           on_bad: str = "reject") -> DataFrame:
    return events.filter(usable(on_bad)).select(
        KEY, "created_at", "id", table.code(F.col("type"), on_unknown).alias("code"), "type")


def _history(with_type: bool) -> Column:
    fields = ["created_at", "id", "code"] + (["type"] if with_type else [])
    return F.sort_array(F.collect_list(F.struct(*fields))).alias("history")


def _types(df: DataFrame) -> tuple[str, str]:
    return tuple(df.schema[c].dataType.simpleString() for c in ("created_at", "id"))


def _fold(carry: Column, record: str, step) -> Column:
    """Run ``step`` over ``history`` in order and give the records it adds.

    ``step(carry, event)`` gives the next carry, whether to add a record, and the record. Records
    are gathered per block and joined at the end: appending one by one to a long array would copy
    it each time.
    """

    def one(acc, event):
        after, adds, new = step(acc["carry"], event)
        more = F.concat(acc["found"], F.array(new))
        return F.struct(
            after.alias("carry"), F.when(adds, more).otherwise(acc["found"]).alias("found"),
            acc["parts"].alias("parts"))

    def block(acc, b):
        first = b * FOLD_BLOCK
        return F.aggregate(
            F.sequence(first, F.least(first + FOLD_BLOCK, F.size("history")) - 1),
            F.struct(
                acc["carry"].alias("carry"), F.array().cast(f"array<{record}>").alias("found"),
                acc["parts"].alias("parts")),
            lambda inner, i: one(inner, F.get("history", i)),
            lambda done: F.struct(
                done["carry"].alias("carry"),
                F.concat(done["parts"], F.array(done["found"])).alias("parts")))

    blocks = F.sequence(F.lit(0), floor_div(F.size("history") - 1, FOLD_BLOCK).cast("int"))
    start = F.struct(
        carry.alias("carry"), F.array().cast(f"array<array<{record}>>").alias("parts"))
    return F.aggregate(blocks, start, block, lambda acc: F.flatten(acc["parts"]))


def _entries(table: TransitionTable, types, state: Column, fresh: Column) -> Column:
    """The states entered; ``fresh`` makes the first event an entry of its own."""

    def step(c, x):
        after = table.step(c["state"], x["code"])
        pos = (c["pos"] + 1).alias("pos")
        new = F.struct(
            after.alias("state"), x["created_at"].alias("start_time"), x["id"].alias("start_id"), pos)
        carry = F.struct(after.alias("state"), F.lit(False).alias("fresh"), pos)
        return carry, c["fresh"] | (after != c["state"]), new

    carry = F.struct(state.cast("int").alias("state"), fresh.alias("fresh"), F.lit(0).alias("pos"))
    record = f"struct<state:int,start_time:{types[0]},start_id:{types[1]},pos:int>"
    return _fold(carry, record, step)


def _moves(table: TransitionTable, types, state: Column, fresh: Column,
           start_time: Column, start_id: Column) -> Column:
    """Every event with the states around it; the state before began with the given event."""

    def step(c, x):
        after = table.step(c["state"], x["code"])
        entered = c["fresh"] | (after != c["state"])
        move = F.struct(
            x["id"].alias("id"), x["type"].alias("type"), x["created_at"].alias("created_at"),
            F.when(~c["fresh"], c["state"]).alias("before"), after.alias("after"),
            entered.alias("entered"), F.when(entered, c["start_time"]).alias("prev_start"),
            F.when(entered, c["start_id"]).alias("prev_id"))
        carry = F.struct(
            after.alias("state"), F.lit(False).alias("fresh"),
            F.when(entered, x["created_at"]).otherwise(c["start_time"]).alias("start_time"),
            F.when(entered, x["id"]).otherwise(c["start_id"]).alias("start_id"))
        return carry, F.lit(True), move

    time, key = types
    carry = F.struct(
        state.cast("int").alias("state"), fresh.alias("fresh"),
        start_time.cast(time).alias("start_time"), start_id.cast(key).alias("start_id"))
    record = (f"struct<id:{key},type:string,created_at:{time},before:int,after:int,entered:boolean,"
              f"prev_start:{time},prev_id:{key}>")
    return _fold(carry, record, step)


def _cold_groups(coded: DataFrame, with_type: bool = False) -> DataFrame:
    # The explicit partitioning keeps the raw rows, not half-built arrays, in the one exchange.
    return coded.repartition(KEY).groupBy(KEY).agg(_history(with_type))


def _incoming(chunks: DataFrame, table: TransitionTable) -> DataFrame:
    """State before each chunk of each chunked entity, from the chunks' functions: ``(KEY, chunk, incoming, fresh)``.

    A scan over function composition, as a tree: ``SCAN_BLOCK`` neighbouring functions compose to one, these again, until an
    entity has one left; then, from the top, each block passes the state that it starts from on to its members. No task
    holds more than a block of an entity, however many chunks it has.
    """
    identity = F.sequence(F.lit(0), F.lit(len(table.states) - 1)).cast("array<int>")
    moved = F.aggregate("history", identity, lambda f, x: F.transform(f, lambda s: table.step(s, x["code"])))
    level = settle(chunks.select(KEY, F.col("chunk").cast("long").alias("at"), moved.alias("moved")))
    levels = []
    while True:
        block = floor_div("at", SCAN_BLOCK).alias("block")
        blocks = settle(level.groupBy(KEY, block).agg(F.sort_array(F.collect_list(F.struct("at", "moved"))).alias("parts")))
        levels.append(blocks)
        several = blocks.groupBy(KEY).count().filter("count > 1").take(1)
        if not several:
            break
        through = F.aggregate("parts", identity, lambda f, p: F.transform(f, lambda s: F.get(p["moved"], s)))
        level = blocks.select(KEY, F.col("block").alias("at"), through.alias("moved"))
    start = levels[-1].select(KEY, F.col("block").alias("at"), F.lit(table.seed).alias("incoming"), F.lit(True).alias("fresh"))
    for blocks in reversed(levels):
        start = _passed_on(blocks, start)
    return start.select(KEY, F.col("at").cast("int").alias("chunk"), "incoming", "fresh")


def _passed_on(blocks: DataFrame, start: DataFrame) -> DataFrame:
    """``(KEY, at, incoming, fresh)`` of the members of ``blocks``, whose own are ``start``."""
    start, _ = broadcast_if_small(start.withColumnRenamed("at", "block"))
    met = blocks.join(start, [KEY, "block"])
    before = F.aggregate(
        "parts", F.struct(F.col("incoming").alias("state"), F.array().cast("array<int>").alias("seen")),
        lambda acc, p: F.struct(F.get(p["moved"], acc["state"]).alias("state"), F.concat(acc["seen"], F.array(acc["state"])).alias("seen")),
        lambda acc: acc["seen"])
    rows = met.select(KEY, "parts", "fresh", before.alias("seen")).select(KEY, "parts", "fresh", F.posexplode("seen").alias("i", "incoming"))
    return rows.select(KEY, F.get("parts", F.col("i"))["at"].alias("at"), "incoming", (F.col("fresh") & (F.col("i") == 0)).alias("fresh"))


def _hot_groups(coded: DataFrame, table: TransitionTable, chunk_rows: int,
                with_type: bool = False) -> DataFrame:
    """Chunked entities: ``history`` per chunk with the state and freshness it starts from."""
    placed, _ = ordered_chunks(coded, [KEY, "created_at", "id"], chunk_rows)
    chunks = placed.groupBy(KEY, "chunk").agg(_history(with_type))
    incoming, _ = broadcast_if_small(_incoming(chunks, table), derived=True)
    return chunks.join(incoming, [KEY, "chunk"])


def _split(events, table, on_unknown, on_bad, hot_rows):
    table = TransitionTable.of(table)
    return table, split_hot(_coded(events, table, on_unknown, on_bad), KEY, hot_rows)


def _visit(entries: Column, before: Column | None = None, after: Column | None = None,
           first: Column | None = None) -> Column:
    """Entries of one group as visits; ``before`` and ``after`` are its outer neighbours."""

    def one(e, i):
        prev, nxt = F.get(entries, i - 1), F.get(entries, i + 1)
        if before is not None:
            prev, nxt = F.coalesce(prev, before), F.coalesce(nxt, after)
        return F.struct(
            e["state"].alias("state"), e["start_time"].alias("start_time"),
            e["start_id"].alias("start_id"),
            nxt["start_time"].alias("end_time"), nxt["start_id"].alias("end_id"),
            nxt["state"].alias("next_state"),
            prev["state"].alias("prev_state"), prev["start_time"].alias("prev_start"),
            prev["start_id"].alias("prev_id"),
            (F.get(entries, F.lit(0))["start_time"] if first is None else first).alias("first_seen"))

    return F.inline(F.transform(entries, one))


def _cold_visits(cold: DataFrame, table: TransitionTable) -> DataFrame:
    entries = _entries(table, _types(cold), F.lit(table.seed), F.lit(True))
    folded = _cold_groups(cold.drop("type")).select(KEY, entries.alias("entries"))
    return folded.select(KEY, _visit(F.col("entries")))


def _hot_folded(hot: DataFrame, table: TransitionTable, chunk_rows: int,
                with_type: bool = False) -> DataFrame:
    """Chunked entities with their entries and, per chunk, the entries next to it outside."""
    groups = _hot_groups(hot, table, chunk_rows, with_type)
    entries = _entries(table, _types(hot), F.col("incoming"), F.col("fresh"))
    folded = settle(groups.withColumn("entries", entries))
    outer, _ = broadcast_if_small(_neighbours(folded), derived=True)
    return folded.join(outer, [KEY, "chunk"])


def _neighbours(folded: DataFrame) -> DataFrame:
    """``(KEY, chunk, before, after, first)``: the last entry in an earlier chunk, the first in a later one, and the entity's first start.

    Worked out inside blocks of ``SCAN_BLOCK ** 2`` chunks, and between them from one row per block.
    """
    head, tail = F.get("entries", F.lit(0)), F.try_element_at("entries", F.lit(-1))
    rows = folded.select(KEY, "chunk", floor_div("chunk", SCAN_BLOCK * SCAN_BLOCK).alias("block"), head.alias("head"), tail.alias("tail"))

    def near(df: DataFrame, by: list[str], at: str, head: str, tail: str) -> tuple[Column, Column]:
        w = Window.partitionBy(*by).orderBy(at)
        return (F.last(tail, True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                F.first(head, True).over(w.rowsBetween(1, Window.unboundedFollowing)))

    before, after = near(rows, [KEY, "block"], "chunk", "head", "tail")
    inside = rows.select(KEY, "block", "chunk", before.alias("before"), after.alias("after"))
    order = lambda c: F.when(F.col(c).isNotNull(), F.struct("chunk", c))
    blocks = rows.groupBy(KEY, "block").agg(F.min(order("head")).alias("h"), F.max(order("tail")).alias("t"))
    blocks = blocks.select(KEY, "block", F.col("h.head").alias("head"), F.col("t.tail").alias("tail"))
    up, down = near(blocks, [KEY], "block", "head", "tail")
    first = F.first("head", True).over(Window.partitionBy(KEY).orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    outside = blocks.select(KEY, "block", up.alias("up"), down.alias("down"), first["start_time"].alias("first"))
    return inside.join(outside, [KEY, "block"]).select(
        KEY, "chunk", F.coalesce("before", "up").alias("before"), F.coalesce("after", "down").alias("after"), "first")


def _hot_visits(hot: DataFrame, table: TransitionTable, chunk_rows: int) -> DataFrame:
    return _hot_folded(hot.drop("type"), table, chunk_rows).select(
        KEY, _visit(F.col("entries"), F.col("before"), F.col("after"), F.col("first")))


def _visits_of(split, table, chunk_rows) -> DataFrame:
    out = _cold_visits(split.cold, table)
    if split.hot is not None:
        out = out.unionByName(_hot_visits(split.hot, table, chunk_rows))
    named = {c: table.name(F.col(c)) for c in ("state", "next_state", "prev_state")}
    return out.withColumns(named)


def state_visits(events: DataFrame, table=FORWARD, on_unknown: str = "ignore",
                 on_bad: str = "reject", hot_rows: int | None = HOT_ROWS,
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per stay of an entity in a state.

    ``state, start_time, start_id`` and, unless still open, ``end_time, end_id, next_state``; the
    stay before as ``prev_state, prev_start, prev_id``; ``first_seen`` of the entity. Events are
    taken in order of ``(created_at, id)``. Events without id, entity or time change nothing; see
    ``cleaning.rejected_events``. ``on_bad="error"`` raises instead.
    """
    table, split = _split(events, table, on_unknown, on_bad, hot_rows)
    return _visits_of(split, table, chunk_rows)


def _cold_moves(cold: DataFrame, table: TransitionTable) -> DataFrame:
    """Events of ordinary entities: the history is cut where the state changes, then exploded."""
    found = _entries(table, _types(cold), F.lit(table.seed), F.lit(True))
    groups = _cold_groups(cold, True).withColumn("entries", found)
    entries = F.col("entries")

    def run(e, i):
        prev = F.get(entries, i - 1)
        until = F.coalesce(F.get(entries, i + 1)["pos"], F.size("history") + 1)
        return F.struct(
            prev["state"].alias("prev"), e["state"].alias("after"),
            prev["start_time"].alias("prev_start"), prev["start_id"].alias("prev_id"),
            F.get(entries, F.lit(0))["start_time"].alias("first_seen"),
            F.slice("history", e["pos"], until - e["pos"]).alias("part"))

    runs = groups.select(KEY, F.inline(F.transform(entries, run)))
    rows = runs.select("*", F.posexplode("part").alias("at", "e"))
    entered = F.col("at") == 0
    return rows.select(
        KEY, "first_seen", "e.id", "e.type", "e.created_at",
        F.when(entered, F.col("prev")).otherwise(F.col("after")).alias("before"), "after",
        entered.alias("entered"), F.when(entered, F.col("prev_start")).alias("prev_start"),
        F.when(entered, F.col("prev_id")).alias("prev_id"))


def event_moves(events: DataFrame, table=FORWARD, on_unknown: str = "ignore",
                on_bad: str = "reject", hot_rows: int | None = HOT_ROWS,
                chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Every event with the state before and after it.

    ``entered`` marks events that bring a new state, the entity's first event included;
    ``prev_start`` and ``prev_id`` then name the event that had brought the state before.
    """
    table, split = _split(events, table, on_unknown, on_bad, hot_rows)
    rows = _cold_moves(split.cold, table)
    if split.hot is not None:
        moves = _moves(table, _types(split.hot), F.col("incoming"), F.col("fresh"),
                       F.col("before.start_time"), F.col("before.start_id"))
        hot = _hot_folded(split.hot, table, chunk_rows, True)
        folded = hot.select(KEY, F.col("first").alias("first_seen"), moves.alias("moves"))
        rows = rows.unionByName(folded.select(KEY, "first_seen", F.inline("moves")))
    return rows.select(
        "id", KEY, "type", "created_at", table.name(F.col("before")).alias("state_before"),
        table.name(F.col("after")).alias("state_after"), "entered", "prev_start", "prev_id",
        "first_seen")


def fsm_states(events: DataFrame, table=FORWARD, **opts) -> DataFrame:
    """State before and after every event; ``state_before`` is NULL on an entity's first event."""
    return event_moves(events, table, **opts).select(
        "id", KEY, "type", "created_at", "state_before", "state_after")


def _start(anchor: str) -> str:
    if anchor not in ANCHORS:
        raise ValueError(f"anchor must be one of {ANCHORS}, not {anchor!r}")
    return "start_time" if anchor == "state_start" else "first_seen"


def changes_of(visits: DataFrame, anchor: str = "state_start", wrap_days: bool = False) -> DataFrame:
    """Transition log of visits that ended."""
    spent = whole_seconds(_start(anchor), "end_time", wrap_days)
    return visits.filter(F.col("end_id").isNotNull()).select(
        F.col(KEY).alias("f_id"), F.col("state").alias("old_state"),
        F.col("next_state").alias("new_state"), spent.alias("time_in_state"),
        F.col("end_time").alias("change_time"), F.col("end_id").alias("event_id"))


def state_changes(events: DataFrame, table=FORWARD, anchor: str = "state_start",
                  wrap_days: bool = False, **opts) -> DataFrame:
    """``(f_id, old_state, new_state, time_in_state, change_time, event_id)`` per state change.

    ``anchor`` is what the time in state counts from: the start of that state, or the entity's
    first event. ``wrap_days`` drops whole days from it.
    """
    return changes_of(state_visits(events, table, **opts), anchor, wrap_days)


def history(changes: DataFrame) -> DataFrame:
    """Closed stays as ``(f_id, state, time_in_state)``."""
    return changes.select("f_id", F.col("old_state").alias("state"), "time_in_state")


def last_event_states(events: DataFrame, **opts) -> DataFrame:
    """State per event when every known event sets its own state; unknown ones change nothing."""
    return fsm_states(events, LAST_WINS, **opts)


def last_event_history(events: DataFrame, **opts) -> DataFrame:
    return history(state_changes(events, LAST_WINS, **opts))


def state_intervals(visits: DataFrame) -> DataFrame:
    """Stays as intervals; the last one of each entity is open."""
    return visits.select(
        F.col(KEY).alias("f_id"), "state", F.col("start_time").alias("valid_from"),
        F.col("end_time").alias("valid_to"))


def time_per_state(changes: DataFrame) -> DataFrame:
    return changes.groupBy("f_id", F.col("old_state").alias("state")).agg(
        F.sum("time_in_state").alias("time_in_state"))


def current_of(visits: DataFrame, anchor: str = "state_start") -> DataFrame:
    """Current state per entity: the stay that has not ended."""
    return visits.filter(F.col("end_id").isNull()).select(
        F.col(KEY).alias("f_id"), "state", F.col(_start(anchor)).alias("state_start_time"))


