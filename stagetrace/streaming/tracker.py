"""Live tracking: every micro-batch goes on from the stored current states.

A batch is folded by the batch operator itself: an entity's stored state is put before its new
events as one event that sets this state. So the stream needs no state of its own, large entities
are cut into chunks as in a batch, and nothing runs in Python. States, ids and board are kept in
tables in buckets; a batch reads and writes the buckets that it touches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrace.functions.scalar import floor_div, ntz
from stagetrace.model import FORWARD, STATES, TransitionTable, resume_type
from stagetrace.operators.cleaning import entity_sketches, rejected_events, usable
from stagetrace.operators.current import PAGE_IDS, state_counts
from stagetrace.operators.lifecycle import KEY, _start, changes_of, state_visits
from stagetrace.operators.snapshot import (
    FIRST_EVENTS,
    LOOKBACK,
    _with_dimensions,
    active_fulfillments,
    first_event_times,
    level_snapshot,
    snapshot_state,
)
from stagetrace.plans.skew import broadcast_if_small
from stagetrace.session import settle
from stagetrace.sources.buckets import BucketStore, delete, id_store, versions
from stagetrace.sources.writers import (
    _write_batch,
    append_changes,
    append_snapshot,
    append_unique,
    compact_current,
    current_rows,
    current_store,
    upsert_current,
)

COMPACT_EVERY = 20


def dedup_events(events: DataFrame, within: str | None = None) -> DataFrame:
    """Each event id once; events without an id are all kept. ``within`` bounds the ids remembered
    on a stream, for example ``"1 hour"`` of event time; without it all ids are remembered."""
    # events without an id differ in a random key, so none takes the place of another
    key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("-"), F.expr("uuid()")))
    keyed = events.withColumn("_key", key)
    if within is None:
        return keyed.dropDuplicates(["_key"]).drop("_key")
    watermarked = keyed.withColumn("_wm", F.col("created_at").cast("timestamp"))
    return watermarked.withWatermark("_wm", within).dropDuplicatesWithinWatermark(["_key"]).drop("_wm", "_key")


def first_of_ids(events: DataFrame) -> DataFrame:
    """Each event id once inside a batch: its usable event of the earliest time. Events without an id are all kept."""
    rest = [c for c in events.columns if c not in ("id", "created_at")]
    bad = (~usable()).alias("_bad")
    first = events.filter("id IS NOT NULL").groupBy("id").agg(F.min(F.struct(bad, "created_at", *rest)).alias("e"))
    return first.select("id", "e.created_at", *(f"e.{c}" for c in rest)).select(*events.columns).unionByName(events.filter("id IS NULL"))


def new_events(batch: DataFrame, seen: BucketStore, batch_id: int) -> DataFrame:
    """The events of a batch whose id neither the batch nor an earlier one has brought; their ids are then known.

    However late a repeated id comes it is found, in the one bucket of neighbouring ids that it falls into. A batch that
    runs again asks for the ids as of the batch before it.
    """
    fresh = settle(first_of_ids(batch))
    ids = lambda df: df.filter("id IS NOT NULL").select(F.col("id").cast("long").alias("id"))
    if seen.parts(batch_id):
        known, _ = broadcast_if_small(seen.get(ids(fresh), batch_id), derived=True)
        fresh = fresh.join(known, "id", "left_anti").select(*batch.columns)
    seen.put(ids(fresh), batch_id)
    return fresh


def log_raw_events(events: DataFrame, path: str, checkpoint: str, **trigger):
    """Append the raw events of a stream by day; each id lands once, however late it is repeated.

    ``path/events`` is the log and ``path/ids`` the ids that it holds.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        append_unique(new_events(batch, id_store(batch.sparkSession, f"{path}/ids"), batch_id), f"{path}/events", batch_id)

    return (events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def track_batch(events: DataFrame, known: DataFrame, table=FORWARD, anchor: str = "state_start",
                wrap_days: bool = False, exact: bool = False, **opts) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Changes, current rows and late events of new ``events`` given the ``known`` current rows.

    ``known`` and the current rows have the columns of ``CURRENT``; only touched entities give one. ``exact`` says that
    ``known`` is a table that holds these only.
    Events are applied in order of ``(created_at, id)``; one older than its entity's last applied
    event is late and not applied. ``opts`` are those of ``state_visits``.
    """
    table = TransitionTable.of(table).resuming()
    good = events.filter(usable()).select(F.col("id").cast("long").alias("id"), "type", F.col(KEY).cast("long").alias(KEY), "created_at")
    touched = good.select(F.col(KEY).alias("f_id")).distinct()
    prior = known if exact else settle(known.join(touched, "f_id", "left_semi"))
    placed = good.join(
        prior.select(F.col("f_id").alias(KEY), "as_of_time", "as_of_id"), KEY, "left")
    is_late = F.coalesce(F.struct("created_at", "id") < F.struct("as_of_time", "as_of_id"), F.lit(False))
    is_late = F.when(F.col("as_of_time").isNull(), False).otherwise(is_late)
    placed = settle(placed.withColumn("_late", is_late))
    late = placed.filter("_late").select(
        F.col(KEY).alias("f_id"), F.col("id").alias("event_id"), F.col("created_at").alias("event_time"))
    new = placed.filter("NOT _late").select("id", "type", KEY, "created_at")
    fresh = new.select(F.col(KEY).alias("f_id")).distinct()
    resumed = prior.join(fresh, "f_id", "left_semi").select(
        F.col("state_start_id").alias("id"),
        F.element_at(F.create_map(*[F.lit(x) for s in table.states for x in (s, resume_type(s))]), F.col("state")).alias("type"),
        F.col("f_id").alias(KEY), F.col("state_start_time").alias("created_at"))
    visits = state_visits(resumed.unionByName(new), table, **opts)
    seen = prior.select(F.col("f_id").alias(KEY), F.col("first_seen").alias("_seen"))
    visits = settle(visits.join(seen, KEY, "left")
                    .withColumn("first_seen", F.coalesce("_seen", "first_seen")).drop("_seen"))
    last = new.groupBy(F.col(KEY).alias("f_id")).agg(F.max(F.struct("created_at", "id")).alias("x"))
    current = visits.filter(F.col("end_id").isNull()).select(
        F.col(KEY).alias("f_id"), "state", F.col("start_time").alias("state_start_time"),
        F.col("start_id").alias("state_start_id"), "first_seen")
    current = current.join(last, "f_id").select(
        "*", F.col("x.created_at").alias("as_of_time"), F.col("x.id").alias("as_of_id")).drop("x")
    return changes_of(visits, anchor, wrap_days), current, late


@dataclass(frozen=True)
class Batch:
    """What one micro-batch has changed: its new usable events, and the current rows of the entities they touch before and after.

    ``current()`` gives the rows of all entities as of this batch. Rows are ``(f_id, state, state_start_time)``.
    """

    batch_id: int
    events: DataFrame
    before: DataFrame
    after: DataFrame
    current: Callable[[], DataFrame]


def run_tracking(events: DataFrame, out: str, table=FORWARD, anchor: str = "state_start",
                 wrap_days: bool = False, compact_every: int | None = COMPACT_EVERY,
                 on_batch: Callable[[DataFrame, int], None] | None = None,
                 opts: dict | None = None, unique_ids: bool = True, cold_after: timedelta | None = None, **trigger):
    """Start the query that keeps ``out/changes``, ``out/current``, ``out/late``, ``out/rejected``
    up to date with a stream of events, and ``out/sketches``, one mergeable sketch of entities per batch.

    A batch reads and writes the buckets of states of the entities that it touches. A batch that runs again reads the
    states as of the batch before it and replaces its own rows, so the query may be stopped or fail anywhere.
    With ``unique_ids`` an event whose id an earlier one had is left out, after any delay; the ids are in ``out/ids``.
    Every ``compact_every`` batches buckets of several versions are folded; then entities in a state that no event leaves, and
    without events for ``cold_after``, move to the cold tier, which only an event of theirs opens.

    ``on_batch(current, batch_id)`` is called after each batch with the current states, whose times count
    from ``anchor``; if it has a method ``apply``, that is called with the ``Batch`` instead.
    """
    table = TransitionTable.of(table)
    shown = F.col("state_start_time" if _start(anchor) == "start_time" else "first_seen").alias("state_start_time")

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states, seen = f"{out}/current", id_store(spark, f"{out}/ids")
        batch = new_events(batch, seen, batch_id) if unique_ids else settle(batch)
        touched = settle(batch.filter(usable()).select(F.col(KEY).cast("long").alias("f_id")).distinct())
        known = settle(current_store(spark, states).get(touched, batch_id))
        changes, current, late = track_batch(batch, known, table, anchor, wrap_days, True, **(opts or {}))
        current = settle(current)
        append_changes(changes, f"{out}/changes", batch_id)
        _write_batch(late, f"{out}/late", batch_id, [])
        _write_batch(rejected_events(batch), f"{out}/rejected", batch_id, [])
        _write_batch(entity_sketches(batch, []), f"{out}/sketches", batch_id, [])
        upsert_current(current, states, batch_id, True)
        if compact_every and batch_id and batch_id % compact_every == 0:
            since = None
            if cold_after is not None:
                newest = batch.agg(F.max("created_at")).first()[0]
                since = newest - cold_after if newest else datetime.min
            compact_current(spark, states, batch_id, table.absorbing() if cold_after is not None else (), since)
            if unique_ids:
                seen.compact(batch_id)
        row = lambda df: df.select("f_id", "state", shown)
        everything = lambda: row(current_rows(spark, states, batch_id + 1))
        if hasattr(on_batch, "apply"):
            on_batch.apply(Batch(batch_id, batch.filter(usable()), row(known.join(current, "f_id", "left_semi")), row(current), everything))
        elif on_batch is not None:
            on_batch(everything(), batch_id)

    return (
        events.writeStream.foreachBatch(store).option("checkpointLocation", f"{out}/_checkpoint")
        .trigger(**(trigger or {"availableNow": True})).start())


# --- the board


@dataclass(frozen=True)
class Board:
    """The board at ``path`` kept by differences: counts take -1 and +1 per entity that moves, lists are written anew for the
    pages it leaves and enters. A version counts when both are finished, and the one before it stays for its readers.
    """

    path: str
    page_ids: int = PAGE_IDS

    def lists(self, spark) -> BucketStore:
        return BucketStore(spark, f"{self.path}/lists", "page long, state string, items array<struct<f_id: long, state_start_time: timestamp_ntz>>", ("page", "state"), strict=True)

    def apply(self, batch: Batch) -> None:
        spark = batch.after.sparkSession
        last = [v for v in versions(spark, f"{self.path}/counts", "version", True) if v < batch.batch_id]
        if last:
            counted = spark.read.parquet(f"{self.path}/counts/version={last[-1]}")
            before, after = batch.before, batch.after
        else:  # a new board begins with everything that is there
            before, after = batch.before.limit(0), settle(batch.current())
            counted = state_counts(before)
        sign = lambda df, n: df.groupBy("state").agg((F.count("*") * n).alias("n"))
        counts = counted.unionByName(sign(before, -1)).unionByName(sign(after, 1)).groupBy("state").agg(F.sum("n").alias("n"))
        self._turn(before, after, batch.batch_id)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counts/version={batch.batch_id}")
        for old in last[:-1]:
            delete(spark, f"{self.path}/counts/version={old}")

    def _turn(self, before: DataFrame, after: DataFrame, batch_id: int) -> None:
        store = self.lists(before.sparkSession)
        at = floor_div("f_id", self.page_ids).alias("page")
        places = settle(before.select(at, "state").unionByName(after.select(at, "state")).distinct())
        old = store.get(places.select("page").distinct(), batch_id).join(places, ["page", "state"], "left_semi")
        stay = old.select("page", "state", F.explode("items").alias("i"), F.lit(False).alias("new"))
        come = after.select(at, "state", F.struct("f_id", "state_start_time").alias("i"), F.lit(True).alias("new"))
        # a page that is left by all is written as an empty one
        none = places.select("page", "state", F.lit(None).cast(come.schema["i"].dataType).alias("i"), F.lit(False).alias("new"))
        # an entity stays in its page, so one shuffle brings together what it had and has, and then its page
        rows = stay.unionByName(come).unionByName(none).repartition("page")
        own = [F.col("i.f_id").alias("f_id"), F.when(F.col("i").isNull(), F.col("state")).alias("none")]
        last = rows.groupBy("page", *own).agg(F.max(F.struct("new", "state", "i")).alias("x"))
        pages = last.groupBy("page", F.col("x.state").alias("state")).agg(F.sort_array(F.collect_list("x.i")).alias("items"))
        store.put(pages, batch_id)
        if batch_id and batch_id % COMPACT_EVERY == 0:
            store.compact(batch_id)


def board_writer(path: str, page_ids: int = PAGE_IDS) -> Board:
    """``on_batch`` that keeps the board at ``path``; see ``read_board``."""
    return Board(path, page_ids)


def read_board(spark, path: str, name: str, states=STATES) -> DataFrame:
    """``counts`` or ``lists`` of the newest version of which both are finished."""
    lists = Board(path).lists(spark)
    version = max(set(versions(spark, f"{path}/counts", "version", True)) & set(lists.batches()))
    counts = spark.read.parquet(f"{path}/counts/version={version}").filter(F.col("state").isin(list(states)))
    if name == "counts":
        return counts
    pages = lists.all(version + 1).filter(F.size("items") > 0).select("state", "page", "items")
    none = F.array().cast(pages.schema["items"].dataType).alias("items")
    return pages.unionByName(counts.filter("n = 0").select("state", F.lit(0).cast("long").alias("page"), none))


# --- metrics


def snapshot_writer(snapshot: Callable[[], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """``on_batch`` that appends the metric columns of a snapshot taken then.

    ``snapshot()`` gives the rows of ``level_snapshot``. With the trigger ``processingTime="5 seconds"``
    a row per level is appended every five seconds; a batch that runs again replaces its rows.
    """

    def write(current: DataFrame, batch_id: int) -> None:
        append_snapshot(snapshot(), path, batch_id)

    return write


def next_multiple(step: timedelta, origin: datetime) -> Callable[[Batch], datetime | None]:
    """``tick`` of ``LiveSnapshot`` on the events' clock: the first multiple of ``step`` from ``origin`` not before a batch's newest event."""

    def tick(batch: Batch) -> datetime | None:
        newest = batch.events.agg(F.max("created_at")).first()[0]
        return None if newest is None else origin + -(-(newest - origin) // step) * step

    return tick


@dataclass(frozen=True)
class LiveSnapshot:
    """What snapshots need, kept up with the stream: per entity its first-event times, start, end and level.

    A batch changes the entities that it touches; only then are the tables asked, for these entities: ``fulfillments`` every
    time, the tables beyond it when an entity is new. ``take`` reads nothing but what is kept. ``tick(batch)`` names the
    moment at which a batch's metrics are taken, NULL events' batches excepted; moments must not go back, for entities
    that no later snapshot can show are dropped.
    """

    path: str
    tables: dict[str, DataFrame]
    tick: Callable[[Batch], datetime | None]
    lookback: timedelta = LOOKBACK
    compact_every: int = COMPACT_EVERY

    def store(self, spark) -> BucketStore:
        times = ", ".join(f"{c} timestamp_ntz" for c in ("actual_started_at", "actual_ended_at", *FIRST_EVENTS))
        return BucketStore(spark, f"{self.path}/entities", f"f_id long, proctor_level string, {times}", ("f_id",))

    def apply(self, batch: Batch) -> None:
        spark = batch.events.sparkSession
        store = self.store(spark)
        self.update(batch.events, batch.batch_id)
        at = self.tick(batch)
        if at is None:
            return
        append_snapshot(self.take(spark, at, batch.batch_id + 1), f"{self.path}/metrics", batch.batch_id)
        if batch.batch_id and batch.batch_id % self.compact_every == 0:
            over = (F.col("actual_ended_at") <= ntz(at)) | (F.col("actual_started_at") <= ntz(at - self.lookback))
            store.compact(batch.batch_id, drop=over)

    def update(self, events: DataFrame, batch_id: int) -> None:
        """Bring the entities of ``events`` up to date."""
        store = self.store(events.sparkSession)
        firsts = first_event_times(events.select(F.col(KEY).cast("long").alias(KEY), "type", "created_at")).withColumnRenamed(KEY, "f_id")
        ids = settle(events.select(F.col(KEY).cast("long").alias("f_id")).distinct())
        few, small = broadcast_if_small(ids)
        known = settle(store.get(ids, batch_id))
        own = self.tables["fulfillments"].withColumnRenamed("id", "f_id").join(few, "f_id", "left_semi")
        own = settle(own.select("f_id", "reservation_id", "actual_started_at", "actual_ended_at"))
        fresh = own.join(known, "f_id", "left_anti").select("f_id", "reservation_id")
        levels = _with_dimensions(fresh, self.tables, small).select("f_id", "proctor_level")
        levels = levels.unionByName(known.select("f_id", "proctor_level"))
        seen = known.select("f_id", *FIRST_EVENTS).unionByName(firsts.select("f_id", *FIRST_EVENTS))
        times = seen.groupBy("f_id").agg(*(F.min(c).alias(c) for c in FIRST_EVENTS))
        rows = own.drop("reservation_id").join(levels, "f_id", "left").join(times, "f_id", "left")
        store.put(rows, batch_id)

    def take(self, spark, as_of: datetime, before: int | None = None) -> DataFrame:
        """The rows of ``level_snapshot`` at ``as_of``, from what is kept."""
        active = active_fulfillments(self.store(spark).all(before), as_of, self.lookback)
        known = {c: F.when(F.col(c) <= ntz(as_of), F.col(c)) for c in FIRST_EVENTS}
        return level_snapshot(active.withColumns(known).withColumn("state", snapshot_state()), as_of)

    def read(self, spark) -> DataFrame:
        """The metric rows of all ticks."""
        return spark.read.parquet(f"{self.path}/metrics").drop("day", "batch_id")
