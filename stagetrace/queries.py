"""The registered queries: each takes a session and a data folder and gives a DataFrame."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrace import fixtures as fx
from stagetrace import model as m
from stagetrace.operators import active, batches, census, cleaning, current, lifecycle, snapshot
from stagetrace.session import scratch_path
from stagetrace.sources import readers, writers
from stagetrace.streaming import tracker

DAY = datetime(2024, 1, 1)
RANGE = (DAY + timedelta(hours=2), DAY + timedelta(hours=8))
CUTOFF = DAY + timedelta(hours=7, minutes=21, seconds=17, microseconds=242125)
AS_OF = DAY + timedelta(hours=6)
# The event on a whole second of the compressed clock shows what closed intervals do.
STEP = timedelta(seconds=1)
SERIES = (DAY, DAY + timedelta(hours=12), timedelta(minutes=1))
ZONE = "America/Chicago"
LOOKUP_ID = 801

# Labels and terminal type of the active set in the spelling of the fixture's events.
MILESTONES = {
    m.WELCOME: "welcome",
    m.LMI_CONNECTED: "connected",
    m.GET_HELP: "help",
    m.LAUNCH_START: "launch_start",
}

_MICROS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_just_after = timedelta(microseconds=1)


def _events(spark, d, **bounds) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return fx.events(spark, d, **bounds)


def _tables(spark, d) -> dict[str, DataFrame]:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return fx.tables(spark, d)


# --- cleaning, scans, messages


def clean_lifecycles(spark, d):
    return cleaning.complete_lifecycles(_events(spark, d))


def clean_csv_round_trip(spark, d):
    path = scratch_path(spark, "cleaned")
    writers.write_csv(clean_lifecycles(spark, d), path)
    return readers.read_events_csv(spark, path)


def entity_counts(spark, d):
    return cleaning.entity_counts(_events(spark, d))


def distinct_entities(spark, d):
    return cleaning.distinct_entities(_events(spark, d))


def scan_range(spark, d):
    start, end = RANGE
    return cleaning.scan_events(_events(spark, d, start=start, end=end), start, end, ordered=True)


def scan_range_closed(spark, d):
    start, end = RANGE
    events = _events(spark, d, start=start, end=end + _just_after)
    return cleaning.scan_events(events, start, end, boundary="closed")


def range_count(spark, d):
    start, end = RANGE
    return cleaning.range_count(_events(spark, d, start=start, end=end + _just_after), start, end)


def until_cutoff(spark, d):
    return cleaning.until(_events(spark, d, end=CUTOFF + _just_after), CUTOFF)


def event_rows(spark, d):
    return cleaning.event_rows(_events(spark, d))


def event_messages(spark, d):
    return cleaning.to_messages(_events(spark, d))


def decoded_messages(spark, d):
    return readers.parse_messages(event_messages(spark, d))


def legacy_messages(spark, d):
    text = F.concat_ws(" ", F.lit("[x]"), "type", F.lit("for"), "fulfillment_id")
    return readers.parse_legacy(_events(spark, d).select(text.alias("value")))


def interval_batches(spark, d):
    return batches.interval_batches(_events(spark, d, start=RANGE[0], end=RANGE[1]), *RANGE, STEP)


def interval_batches_closed(spark, d):
    start, end = RANGE
    events = _events(spark, d, start=start, end=end + _just_after)
    return batches.interval_batches(events, start, end, STEP, boundary="closed", drop_tail=True)


def batch_sizes(spark, d):
    return batches.batch_sizes(
        batches.interval_batches(_events(spark, d, start=RANGE[0], end=RANGE[1]), *RANGE,
                                 timedelta(minutes=1)))


# --- states over time


def fsm_states(spark, d):
    return lifecycle.fsm_states(_events(spark, d))


def state_changes(spark, d):
    return lifecycle.state_changes(cleaning.of_types(_events(spark, d)))


def state_changes_all_types(spark, d):
    return lifecycle.state_changes(_events(spark, d))


def state_changes_first_seen(spark, d):
    return lifecycle.state_changes(_events(spark, d), anchor="first_seen")


def state_changes_long(spark, d):
    """Month-long entities, total seconds."""
    return lifecycle.state_changes(fx.events_raw(spark, d), m.LAST_WINS)


def state_changes_wrapped(spark, d):
    """The same with whole days dropped."""
    return lifecycle.state_changes(
        fx.events_raw(spark, d), m.LAST_WINS, anchor="first_seen", wrap_days=True)


def custom_table_states(spark, d):
    """A transition table that is a DataFrame: what the data's own types trigger, backwards too."""
    events = _events(spark, d)
    kinds = events.select("type").filter(F.col("type").isNotNull()).distinct()
    table = kinds.crossJoin(kinds.select(F.col("type").alias("state"))).select(
        "state", F.col("type").alias("event_type"), F.col("type").alias("next_state"))
    first = kinds.select(F.lit(m.UNKNOWN).alias("state"), F.col("type").alias("event_type"), F.col("type").alias("next_state"))
    return lifecycle.fsm_states(events, table.unionByName(first))


def last_event_states(spark, d):
    return lifecycle.last_event_states(_events(spark, d))


def last_event_history(spark, d):
    return lifecycle.last_event_history(_events(spark, d))


def fulfillment_history(spark, d):
    return lifecycle.history(state_changes(spark, d))


def state_intervals(spark, d):
    return lifecycle.state_intervals(lifecycle.state_visits(_events(spark, d)))


def time_per_state(spark, d):
    return lifecycle.time_per_state(state_changes(spark, d))


def active_milestones(spark, d):
    return active.active_milestones(_events(spark, d), MILESTONES, m.LAUNCH_END)


# --- current state and board


def current_state(spark, d):
    return lifecycle.current_of(lifecycle.state_visits(_events(spark, d)))


def current_state_first_seen(spark, d):
    return lifecycle.current_of(lifecycle.state_visits(_events(spark, d)), "first_seen")


def entity_lookup(spark, d):
    # one entity's events are all that its state needs
    events = _events(spark, d).filter(F.col("fulfillment_id") == LOOKUP_ID)
    return current.entity_row(lifecycle.current_of(lifecycle.state_visits(events)), LOOKUP_ID)


def state_census(spark, d):
    return current.state_census(current_state(spark, d))


def state_counts(spark, d):
    return current.state_counts(current_state(spark, d))


def state_counts_json(spark, d):
    return current.state_counts_json(current_state(spark, d))


def state_lists(spark, d):
    return _pages_text(current.state_lists(current_state(spark, d), page_ids=1000))


def _pages_text(pages):
    text = F.transform("items", lambda i: F.concat_ws(
        "|", i["f_id"], F.date_format(i["state_start_time"], _MICROS_TEXT)))
    return pages.select("state", "page", F.array_join(text, ",").alias("items"))


def state_pairs(spark, d):
    return current.state_pairs(current_state(spark, d))


def board_items(spark, d):
    return current.board_items(current_state(spark, d), ZONE)


# --- snapshot


def first_event_times(spark, d):
    return snapshot.first_event_times(_events(spark, d))


def service_types(spark, d):
    return snapshot.service_types(_tables(spark, d))


def _skills_text(column):
    each = F.transform(column, lambda s: F.concat(
        F.coalesce(s["name"], F.lit("<null>")), F.lit("*"), s["n"]))
    return F.array_join(each, ",")


def entity_skills(spark, d):
    skills = snapshot.entity_skills(_tables(spark, d))
    return skills.select("institution_id", _skills_text("skills").alias("skills"))


def entity_skill_names(spark, d):
    """The plain list of names, repeats included."""
    skills = snapshot.entity_skills(_tables(spark, d))
    names = F.transform(snapshot.expand_skills("skills"), lambda s: F.coalesce(s, F.lit("<null>")))
    return skills.select("institution_id", F.array_join(names, ",").alias("skills"))


def in_progress(spark, d):
    rows = snapshot.in_progress(_tables(spark, d), AS_OF)
    return rows.withColumn("proctor_skills", _skills_text("proctor_skills"))


def level_snapshot(spark, d):
    return snapshot.level_snapshot(snapshot.in_progress(_tables(spark, d), AS_OF), AS_OF)


def loaded_snapshot(spark, d):
    """The snapshot from nine tables in files of their own."""
    folder = scratch_path(spark, "tables")
    for name, df in _tables(spark, d).items():
        df.write.parquet(f"{folder}/{name}")
    return snapshot.level_snapshot(snapshot.in_progress(readers.load_tables(spark, folder), AS_OF), AS_OF)


def metric_rows(spark, d):
    return snapshot.metric_rows(level_snapshot(spark, d))


def wait_histogram(spark, d):
    return snapshot.wait_histogram(snapshot.in_progress(_tables(spark, d), AS_OF), AS_OF)


def wait_summary(spark, d):
    return snapshot.wait_summary(snapshot.in_progress(_tables(spark, d), AS_OF), AS_OF)


def snapshot_series(spark, d):
    return snapshot.snapshot_series(_tables(spark, d), *SERIES)


# --- running census


def running_counts(spark, d):
    return census.running_counts(_events(spark, d))


def running_census(spark, d):
    return census.running_census(_events(spark, d))


def running_census_first_seen(spark, d):
    return census.running_census(_events(spark, d), anchor="first_seen")


def peak_waiting(spark, d):
    return census.peak_waiting(census.running_census(_events(spark, d), states=("WAITING",)))


# --- streams


def _event_source(spark, d) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # As a pattern the path may name a single file as well as a folder.
    return readers.read_table_stream(spark, f"{d}/event[s].parquet", fx.SCHEMAS["events"])


def _track(spark, events: DataFrame, out: str | None = None, **opts) -> str:
    """Run a stream of events through the live tracker to the end; gives the output folder."""
    out = out or scratch_path(spark, "tracked")
    tracker.run_tracking(events, out, **opts).awaitTermination()
    return out


# The fixture's day in batches of four hours, the last moment of each included.
SLICE = timedelta(hours=4)
SLICES = [DAY + SLICE * (k + 1) for k in range(3)]


def _track_slices(spark, d, repeats: bool = False, **opts) -> str:
    """The fixture's events, one batch per slice of time, each brought by a run of the stream that goes on from the one before.

    With ``repeats`` a slice comes with every fifth event of all earlier ones once more.
    """
    folder, out, start = scratch_path(spark, "slices"), scratch_path(spark, "tracked"), None
    for k, end in enumerate(SLICES):
        events = fx.events(spark, d, start=start, end=end + _just_after if end < SLICES[-1] else None)
        if repeats and start:
            events = events.unionByName(fx.events(spark, d, end=start).filter("id % 5 = 0"))
        events.write.parquet(f"{folder}/slice={k}")
        _track(spark, readers.read_table_stream(spark, f"{folder}/slice=*", m.EVENT_SCHEMA), out, **opts)
        start = end + _just_after
    return out


_CHANGE = ("f_id", "old_state", "new_state", "time_in_state", "change_time", "event_id")


def stream_state_changes(spark, d):
    out = _track(spark, fx.map_events(_event_source(spark, d)))
    return spark.read.parquet(f"{out}/changes").select(*_CHANGE)


def stream_current_state(spark, d):
    out = _track(spark, fx.map_events(_event_source(spark, d)), table=m.LAST_WINS)
    return writers.read_current(spark, f"{out}/current")


def stream_current_compacted(spark, d):
    """Several batches, states folded together after each."""
    out = _track_slices(spark, d, table=m.LAST_WINS, compact_every=1)
    return writers.current_rows(spark, f"{out}/current").select("f_id", "state", "as_of_time", "as_of_id")


def stream_current_cold(spark, d):
    """Entities that are done move to the cold tier after each batch; events that they still get change nothing."""
    out = _track_slices(spark, d, compact_every=1, cold_after=timedelta(0))
    return writers.read_current(spark, f"{out}/current")


def stream_entity_lookup(spark, d):
    """One entity from the live table: only its bucket is read."""
    out = _track_slices(spark, d, compact_every=2)
    return writers.lookup_current(spark, f"{out}/current", LOOKUP_ID)


def stream_repeated_events(spark, d):
    """Changes when events are brought again hours later."""
    out = _track_slices(spark, d, repeats=True)
    return spark.read.parquet(f"{out}/changes").select(*_CHANGE)


def stream_entity_estimate(spark, d):
    """Entities by the sketches that every batch leaves, against the exact number: within five standard errors."""
    out = _track_slices(spark, d)
    none = F.lit(None).cast("long")
    found = cleaning.merged_entities(spark.read.parquet(f"{out}/sketches")).select(none.alias("found"), F.col("found").alias("estimate"))
    exact = writers.current_rows(spark, f"{out}/current").agg(F.count("*").alias("found")).withColumn("estimate", none)
    both = exact.unionByName(found).agg(F.max("found").alias("found"), F.max("estimate").alias("estimate"))
    return both.select("found", (F.abs(F.col("estimate") - F.col("found")) <= 5 * 0.8 / 64 * F.col("found")).alias("close"))


def stream_board_counts(spark, d):
    board = scratch_path(spark, "board")
    _track_slices(spark, d, on_batch=tracker.board_writer(board))
    return tracker.read_board(spark, board, "counts")


def stream_board_lists(spark, d):
    board = scratch_path(spark, "board")
    _track_slices(spark, d, on_batch=tracker.board_writer(board))
    return _pages_text(tracker.read_board(spark, board, "lists"))


def stream_from_messages(spark, d):
    """Messages as files, parsed, tracked: the states of all entities, on whole seconds as messages tell them."""
    folder = scratch_path(spark, "messages")
    writers.write_messages(_events(spark, d), folder)
    out = _track(spark, readers.read_event_stream(spark, folder))
    return writers.read_current(spark, f"{out}/current")


def stream_metric_rows(spark, d):
    path, tables = scratch_path(spark, "metrics"), _tables(spark, d)
    take = lambda: snapshot.level_snapshot(snapshot.in_progress(tables, AS_OF), AS_OF)
    _track(spark, fx.map_events(_event_source(spark, d)), on_batch=tracker.snapshot_writer(take, path))
    return spark.read.parquet(path).drop("day", "batch_id")


def stream_metric_series(spark, d):
    """Metrics after every batch, from states that the stream keeps; a tick reads none of the nine tables."""
    live = tracker.LiveSnapshot(scratch_path(spark, "live"), _tables(spark, d), tracker.next_multiple(SLICE, DAY), compact_every=2)
    _track_slices(spark, d, on_batch=live)
    return live.read(spark)


def rejected_events(spark, d):
    """What the tracker sets aside when every seventh time, eleventh entity and thirteenth id is missing."""
    source = fx.map_events(_event_source(spark, d))
    spoil = lambda c, k: F.when(F.col("id") % k != 0, F.col(c)).alias(c)
    events = source.select(spoil("id", 13), "type", spoil("fulfillment_id", 11), spoil("created_at", 7), "created_by_id")
    out = _track(spark, events)
    return spark.read.parquet(f"{out}/rejected").select("id", "type", "fulfillment_id", "created_at", "missing")


def stream_raw_events(spark, d):
    out = scratch_path(spark, "raw")
    tracker.log_raw_events(fx.map_events(_event_source(spark, d)), out, f"{out}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/events").drop("day", "batch_id")


# --- records that cannot be read


def _spoiled_csv(spark, d) -> str:
    """The events as CSV; of fifty ids one has letters, one a time that is none, and one row ends too early."""
    path = scratch_path(spark, "spoiled")
    kind = F.col("id") % 50
    fields = [
        F.concat(F.when(kind == 0, "x").otherwise(""), F.col("id").cast("string")), F.col("type"), F.col("fulfillment_id").cast("string"),
        F.when(kind == 1, "yesterday").otherwise(F.date_format("created_at", _MICROS_TEXT))]
    line = F.concat_ws(",", *fields, F.when(kind != 2, F.col("created_by_id")))
    writers.write_lines(_events(spark, d).select(line.alias("line")), path, "id,type,fulfillment_id,created_at,created_by_id")
    return path


def csv_good_rows(spark, d):
    return readers.split_events_csv(spark, _spoiled_csv(spark, d))[0]


def csv_rejected_rows(spark, d):
    return readers.split_events_csv(spark, _spoiled_csv(spark, d))[1]


QUERIES = {
    f.__name__: f
    for f in [
        clean_lifecycles, clean_csv_round_trip, entity_counts, distinct_entities, scan_range,
        scan_range_closed, range_count, until_cutoff, event_rows, event_messages, decoded_messages,
        legacy_messages, interval_batches, interval_batches_closed, batch_sizes, fsm_states,
        state_changes, state_changes_all_types, state_changes_first_seen, state_changes_long,
        state_changes_wrapped, custom_table_states, last_event_states, last_event_history, fulfillment_history,
        state_intervals, time_per_state, active_milestones, current_state,
        current_state_first_seen, entity_lookup, state_census, state_counts, state_counts_json,
        state_lists, state_pairs, board_items, first_event_times, service_types, entity_skills,
        entity_skill_names,
        in_progress, level_snapshot, metric_rows, wait_histogram, wait_summary, snapshot_series,
        running_counts, running_census, running_census_first_seen, peak_waiting,
        stream_state_changes, stream_current_state, stream_board_counts, stream_raw_events,
        stream_current_compacted, stream_board_lists, stream_from_messages, stream_metric_rows,
        rejected_events, stream_metric_series, stream_current_cold, stream_entity_lookup, stream_repeated_events,
        csv_good_rows, csv_rejected_rows, stream_entity_estimate, loaded_snapshot,
    ]
}
