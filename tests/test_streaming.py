import time

import pytest
from conftest import at, plain
from pyspark.sql import functions as F
from test_lifecycle import random_rows

from stagetrace.model import EVENT_SCHEMA, FORWARD, LAST_WINS
from stagetrace.operators import cleaning, current
from stagetrace.operators import lifecycle as lc
from stagetrace.sources import readers, writers
from stagetrace.streaming import tracker

CHANGE = ("f_id", "old_state", "new_state", "time_in_state", "change_time", "event_id")


def write_parts(spark, make_events, rows, folder, parts):
    """Files in time order, one micro-batch each."""
    size = -(-len(rows) // parts)
    for k in range(parts):
        events = make_events(rows[k * size:(k + 1) * size])
        events.coalesce(1).write.mode("append").parquet(folder)
        if parts > 1:
            time.sleep(0.05)


def follow(spark, folder, out, table=FORWARD, **opts):
    source = readers.read_table_stream(spark, folder, EVENT_SCHEMA, maxFilesPerTrigger=1)
    tracker.run_tracking(tracker.dedup_events(source), out, table, **opts).awaitTermination()


@pytest.mark.parametrize("parts, hot", [(1, None), (3, 5), (10, None)])
def test_stream_equals_batch(spark, make_events, tmp_path, parts, hot):
    rows = sorted(random_rows(9, 90, 8), key=lambda r: (r[3], r[0]))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_parts(spark, make_events, rows, source, parts)
    follow(spark, source, out, LAST_WINS, compact_every=2, opts={"hot_rows": hot, "chunk_rows": 3})
    events = make_events(rows)
    assert plain(spark.read.parquet(f"{out}/changes"), *CHANGE) == plain(
        lc.state_changes(events, LAST_WINS), *CHANGE)
    assert plain(writers.read_current(spark, f"{out}/current")) == plain(
        lc.current_of(lc.state_visits(events, LAST_WINS)))


def test_late_and_repeated_events(spark, make_events, tmp_path):
    source, out, board = (str(tmp_path / n) for n in ("in", "out", "board"))
    first = [(1, "Welcome", 1, 0), (2, "LmiConnected", 1, 100), (2, "LmiConnected", 1, 100)]
    second = [(3, "LaunchStart", 1, 50), (1, "Welcome", 1, 0), (4, "LaunchStart", 1, 130)]
    write_parts(spark, make_events, first + second, source, 2)
    follow(spark, source, out, on_batch=tracker.board_writer(board), anchor="first_seen")
    assert plain(spark.read.parquet(f"{out}/late"), "f_id", "event_id") == [(1, 3)]
    assert plain(spark.read.parquet(f"{out}/changes"), "old_state", "new_state", "time_in_state") == [
        ("ENTERING", "WAITING", 100), ("WAITING", "LAUNCHING", 130)]
    assert dict(plain(tracker.read_board(spark, board, "counts")))["LAUNCHING"] == 1
    assert tracker.read_board(spark, board, "lists").count() == 6


class Stop(Exception):
    pass


STEPS = ["append_changes", "_write_batch", "upsert_current", "compact_current", "on_batch"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_failing_anywhere_loses_nothing(spark, make_events, tmp_path, monkeypatch, step, after):
    """The query fails once around a step of its second batch, is started again, and ends as a batch does."""
    rows = sorted(random_rows(5, 60, 6), key=lambda r: (r[3], r[0]))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_parts(spark, make_events, rows, source, 3)
    calls = {"n": 0}

    def failing(real):
        def run(*args):
            batch_id = next(a for a in reversed(args) if isinstance(a, int) and not isinstance(a, bool))
            fail = batch_id == 1 and not calls["n"]
            calls["n"] += fail
            if fail and not after:
                raise Stop
            real(*args)
            if fail:
                raise Stop

        return run

    hook = failing(lambda current, batch_id: None) if step == "on_batch" else None
    if hook is None:
        monkeypatch.setattr(tracker, step, failing(getattr(tracker, step)))
    try:
        follow(spark, source, out, LAST_WINS, compact_every=1, on_batch=hook)
    except Exception:  # noqa: BLE001
        pass
    assert calls["n"] == 1
    follow(spark, source, out, LAST_WINS, compact_every=1, on_batch=hook)
    events = make_events(rows)
    assert plain(spark.read.parquet(f"{out}/changes"), *CHANGE) == plain(lc.state_changes(events, LAST_WINS), *CHANGE)
    assert plain(writers.read_current(spark, f"{out}/current")) == plain(
        lc.current_of(lc.state_visits(events, LAST_WINS)))


def test_unusable_events_are_set_aside(spark, make_events, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    good = [(1, "Welcome", 1, 0), (2, "LmiConnected", 1, 100)]
    bad = make_events([(None, "Welcome", 1, 5), (None, "Welcome", 2, 6), (3, "LaunchStart", None, 7), (4, "LaunchStart", 1, 8)])
    bad = bad.withColumn("created_at", F.when(F.col("id") == 4, None).otherwise(F.col("created_at")))
    # the first batch holds no usable row
    bad.coalesce(1).write.parquet(source)
    follow(spark, source, out)
    assert plain(writers.read_current(spark, f"{out}/current")) == []
    make_events(good).coalesce(1).write.mode("append").parquet(source)
    follow(spark, source, out)
    assert plain(writers.read_current(spark, f"{out}/current"), "f_id", "state") == [(1, "WAITING")]
    assert plain(spark.read.parquet(f"{out}/rejected"), "id", "missing") == [
        (3, "entity"), (4, "time"), (None, "id"), (None, "id")]
    both = make_events(good).unionByName(bad)
    assert plain(lc.state_changes(both), *CHANGE) == plain(spark.read.parquet(f"{out}/changes"), *CHANGE)
    assert cleaning.rejected_events(both).count() == 4
    with pytest.raises(Exception, match="event without id"):
        lc.state_changes(both, on_bad="error").collect()


def test_an_empty_store_is_empty(spark, tmp_path):
    store = str(tmp_path / "none")
    assert writers.read_current(spark, store).count() == 0
    writers.compact_current(spark, store, 5)


def test_tracking_runs_no_python(spark, make_events):
    events = make_events(random_rows(1, 40, 3))
    known = spark.createDataFrame([(1, "WAITING", at(0), 1, at(0), at(0), 1)], writers.CURRENT)
    for df in tracker.track_batch(events, known):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
        assert "InPandas" not in df._jdf.queryExecution().executedPlan().toString()


def test_snapshots_are_appended_once(spark, tmp_path):
    path, schema = str(tmp_path / "metrics"), "t timestamp_ntz, proctor_level string, precheck_count long, waiting_count long, launching_count long, max_wait double, avg_wait double"
    write = tracker.snapshot_writer(lambda: spark.createDataFrame([(at(0), "a", 1, 2, 3, 4.0, 5.0)], schema), path)
    for batch in (0, 1, 1):
        write(None, batch)
    assert spark.read.parquet(path).count() == 2


def test_messages_there_and_back(spark, make_events, tmp_path):
    folder, out = str(tmp_path / "messages"), str(tmp_path / "out")
    events = make_events([(1, "Welcome", 1, 0.75), (2, "LaunchEnd", 2, 3), (3, None, 1, 4)])
    writers.write_messages(events, folder)
    stream = readers.read_event_stream(spark, folder)
    writers.stream_raw_events(stream, f"{out}/raw", f"{out}/_cp").awaitTermination()
    assert plain(spark.read.parquet(f"{out}/raw"), "id", "type", "fulfillment_id", "created_at") == [
        (1, "Event::Welcome", 1, at(0)), (2, "Event::LaunchEnd", 2, at(3)), (3, None, 1, at(4))]
    echo = readers.read_table_stream(spark, f"{out}/raw", EVENT_SCHEMA)
    writers.stream_messages(echo, f"{out}/echo", f"{out}/_cp2").awaitTermination()
    assert plain(spark.read.text(f"{out}/echo")) == plain(spark.read.text(folder))


def test_batch_run_twice_counts_once(spark, tmp_path):
    store = str(tmp_path / "current")
    row = lambda f, state, t, i: (f, state, at(t), i, at(0), at(t), i)
    one = spark.createDataFrame([row(1, "ENTERING", 0, 1), row(2, "DONE", 1, 2)], writers.CURRENT)
    two = spark.createDataFrame([row(1, "WAITING", 5, 3), row(1, "LAUNCHING", 6, 4)], writers.CURRENT)
    for batch, df in [(0, one), (1, two), (1, two)]:
        writers.upsert_current(df, store, batch)
    want = [(1, "LAUNCHING", at(6)), (2, "DONE", at(1))]
    assert plain(writers.read_current(spark, store)) == want
    # a batch that may run again stays out of the base, and out of what it reads itself
    writers.compact_current(spark, store, 1)
    assert plain(writers.read_current(spark, store, 1)) == [(1, "ENTERING", at(0)), (2, "DONE", at(1))]
    writers.upsert_current(two, store, 1)
    assert plain(writers.read_current(spark, store)) == want
    for batch in (2, 3, 4):
        writers.upsert_current(two.limit(0), store, batch)
        writers.compact_current(spark, store, batch + 1)
        assert plain(writers.read_current(spark, store)) == want


def test_change_log_replaces_its_own_batch(spark, make_events, tmp_path):
    log = str(tmp_path / "log")
    changes = lc.state_changes(make_events([
        (1, "Welcome", 1, 0), (2, "LmiConnected", 1, 9), (3, "LaunchStart", 1, 90_000)]))
    for batch in (0, 1, 1):
        writers.append_changes(changes, log, batch)
    saved = spark.read.parquet(log)
    assert saved.count() == 4 and saved.select("day").distinct().count() == 2


def test_dedup_within_a_watermark(spark, make_events, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_parts(spark, make_events, [(1, "Welcome", 1, 0), (1, "Welcome", 1, 0), (2, "Welcome", 1, 1)], source, 1)
    events = tracker.dedup_events(readers.read_table_stream(spark, source, EVENT_SCHEMA), "1 hour")
    writers.stream_raw_events(events, f"{out}/raw", f"{out}/_cp").awaitTermination()
    assert plain(spark.read.parquet(f"{out}/raw"), "id") == [(1,), (2,)]


def test_csv_by_name_and_legacy(spark, make_events, tmp_path):
    path = str(tmp_path / "csv")
    events = make_events([(1, "Welcome", 1, 0.25), (2, None, 2, 1)])
    wide = events.selectExpr("'x' AS extra", "created_by_id", "created_at", "fulfillment_id", "type", "id")
    writers.write_csv(wide, path)
    want = plain(events)
    assert plain(readers.read_events_csv(spark, path)) == want
    inferred = readers.read_events_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["created_at"] == "timestamp_ntz"
    assert plain(inferred, "id", "created_at") == plain(events, "id", "created_at")
    text = spark.createDataFrame([("Sent Event::Welcome for 77 x",), ("bad",)], "value string")
    assert plain(readers.parse_legacy(text)) == [("Event::Welcome", 77), (None, None)]
    assert plain(readers.parse_messages(spark.createDataFrame([("{oops",)], "value string"))) == [(None,) * 5]


def test_load_tables(spark, make_events, tmp_path):
    make_events([(1, "Welcome", 1, 0)]).write.parquet(str(tmp_path / "events"))
    tables = readers.load_tables(spark, str(tmp_path), ["events"], views=True)
    assert tables["events"].count() == 1 == spark.sql("SELECT count(*) FROM events").first()[0]
    assert plain(current.latest(spark.createDataFrame(
        [(1, "A", 1, 1, 1), (1, "B", 2, 2, 2)],
        "f_id int, state string, state_start_time int, as_of_time int, as_of_id int")), "state") == [("B",)]
