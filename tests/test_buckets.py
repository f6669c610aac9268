"""Tables in buckets, and what live tracking keeps in them: states, ids, board, snapshots."""

import glob
from datetime import timedelta

import pytest
from conftest import at, plain
from pyspark.sql import functions as F
from test_lifecycle import random_rows
from test_snapshot import make_tables  # noqa: F401

from stagetrace import queries
from stagetrace.model import EVENT_SCHEMA, FORWARD, LAST_WINS
from stagetrace.operators import current, snapshot
from stagetrace.operators import lifecycle as lc
from stagetrace.sources import readers, writers
from stagetrace.sources.buckets import BucketStore, id_store
from stagetrace.streaming import tracker

ROW = "k long, v string"


def store_at(spark, path):
    return BucketStore(spark, str(path), ROW, ("k",))


def rows_of(spark, keys, value):
    return spark.range(max(keys) + 1).filter(F.col("id").isin(list(keys))).select(F.col("id").alias("k"), F.lit(value).alias("v"))


def folders(path, tier):
    return sorted(f.removeprefix(str(path)) for f in glob.glob(f"{path}/{tier}/version=*/bucket=*"))


def test_a_batch_reads_and_writes_the_buckets_it_touches(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.put(rows_of(spark, range(300), "a"), 0)
    assert len(folders(tmp_path, "rows")) == 16
    store.put(rows_of(spark, [7], "b"), 1)
    mine = {f.rsplit("/", 1)[1] for f in folders(tmp_path, "rows") if "version=1000/" in f}
    assert len(mine) == 1
    for df in (store.get(rows_of(spark, [7], "").select("k")), store.lookup(7)):
        assert plain(df) == [(7, "b")]
        files = [f for f in df.inputFiles() if str(tmp_path) in f]
        assert {f.rsplit("/", 2)[1] for f in files} == mine and len(files) == 2
    plan = store.lookup(7)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,7)" in plan
    assert store.lookup(5000).count() == 0 and store.get(rows_of(spark, [5000], "").select("k")).count() == 0
    assert dict(plain(store.all())) == {k: "b" if k == 7 else "a" for k in range(300)}
    assert dict(plain(store.all(1)))[7] == "a" and store.all(0).count() == 0


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.put(rows_of(spark, [1, 2], "a"), 0)
    for keys, value in (([2, 3], "wrong"), ([2, 4], "b")):
        store.put(rows_of(spark, keys, value), 1)
        store.compact(1)  # the first attempt may have got this far
    assert plain(store.all()) == [(1, "a"), (2, "b"), (4, "b")]
    assert plain(store.get(rows_of(spark, [1, 2, 3], "").select("k"), 1)) == [(1, "a"), (2, "a")]
    store.put(rows_of(spark, [5], "c").limit(0), 2)
    store.put(rows_of(spark, [5], "c"), 3)
    assert plain(store.all()) == [(1, "a"), (2, "b"), (4, "b"), (5, "c")]


def test_compaction_leaves_other_buckets_and_readers_alone(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.put(rows_of(spark, range(100), "a"), 0)
    for batch in range(1, 5):
        store.put(rows_of(spark, [7, 8], str(batch)), batch)
        assert len(store.batches()) <= 2
    before = store.all()
    store.compact()
    assert len({f.rsplit("/", 1)[1] for f in folders(tmp_path, "base")}) == len({f.rsplit("/", 1)[1] for f in folders(tmp_path, "rows") if "version=0/" not in f})
    want = sorted({k: "4" if k in (7, 8) else "a" for k in range(100)}.items(), key=repr)
    assert plain(before) == plain(store.all()) == want
    for batch in (5, 6, 7):
        store.put(rows_of(spark, [7], "z"), batch)
        store.compact()
    # what two batches don't name is gone, and no bucket has more versions than those
    assert plain(store.lookup(7)) == [(7, "z")] and plain(store.lookup(8)) == [(8, "4")]
    assert len([f for f in folders(tmp_path, "rows") if "version=0/" not in f]) <= 2


def test_done_rows_go_cold_and_come_back(spark, tmp_path):
    store = store_at(spark, tmp_path)
    rows = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") % 10 < 9, "DONE").otherwise("open").alias("v"))
    store.put(rows, 0)
    store.put(rows, 1)  # a second version, so that each bucket is folded
    store.compact(cold=F.col("v") == "DONE")
    want = {k: "DONE" if k % 10 < 9 else "open" for k in range(100)}
    assert sum(spark.read.parquet(store._folder(p)).count() for p in store.parts() if p[1] != "cold") == 10
    assert dict(plain(store.all())) == want and plain(store.lookup(3)) == [(3, "DONE")]
    store.put(rows_of(spark, [3, 500], "later"), 2)
    keys = rows_of(spark, [3, 4, 9, 500, 501], "").select("k")
    assert dict(plain(store.get(keys))) == {3: "later", 4: "DONE", 9: "open", 500: "later"}
    store.compact(cold=F.col("v") != "open")
    store.compact_cold()
    assert dict(plain(store.all())) == want | {3: "later", 500: "later"}
    assert len({b for b, t, _ in store.parts() if t == "cold"}) == len([1 for _, t, _ in store.parts() if t == "cold"])
    store.put(rows_of(spark, [9, 600], "gone"), 3)
    store.compact(drop=F.col("v") == "gone")
    assert store.lookup(600).count() == 0 and store.lookup(9).count() == 0


def test_hot_states_stay_flat_when_most_are_done(spark, make_events, tmp_path):
    hot = []
    rows = []
    for batch in range(3):
        events = [(1000 * batch + 4 * e + j, kind, 100 * batch + e, 1000 * batch + 10 * e + j) for e in range(20)
                  for j, kind in enumerate(["Welcome", "LmiConnected", "FulfillmentEnded"]) if j < 2 or e < 18]
        if batch:  # an entity that is cold gets one more event
            events.append((5000 + batch, "LaunchStart", 0, 900 + 1000 * batch))
        rows += events
        make_events(events).write.parquet(f"{tmp_path}/in/part={batch}")
        source = readers.read_table_stream(spark, f"{tmp_path}/in/part=*", EVENT_SCHEMA)
        tracker.run_tracking(source, f"{tmp_path}/out", compact_every=1, cold_after=timedelta(0)).awaitTermination()
        store = writers.current_store(spark, f"{tmp_path}/out/current")
        hot.append(sum(spark.read.parquet(store._folder(p)).count() for p in store.parts() if p[1] != "cold"))
    assert FORWARD.absorbing() == ("DONE",) and LAST_WINS.absorbing() == ()
    events = make_events(rows)
    assert plain(writers.read_current(spark, f"{tmp_path}/out/current")) == plain(lc.current_of(lc.state_visits(events)))
    assert spark.read.parquet(f"{tmp_path}/out/changes").count() == lc.state_changes(events).count()
    assert hot[2] < 0.5 * writers.current_rows(spark, f"{tmp_path}/out/current").count()


def test_repeated_ids_are_found_after_any_delay(spark, make_events, tmp_path):
    seen = id_store(spark, f"{tmp_path}/ids", width=100)
    first = make_events([(1, "Welcome", 1, 0), (1, "Welcome", 1, 0), (150, "LaunchEnd", 2, 1), (None, "Welcome", 1, 2), (None, "Welcome", 1, 2)])
    assert plain(tracker.new_events(first, seen, 0), "id") == [(1,), (150,), (None,), (None,)]
    for batch in range(1, 4):
        fresh = make_events([(1000 * batch, "Welcome", 3, batch)])
        assert tracker.new_events(fresh, seen, batch).count() == 1
    late = make_events([(1, "Welcome", 9, 99), (151, "Welcome", 9, 99), (3000, "Welcome", 3, 3)])
    for _ in range(2):  # the batch may run again
        assert plain(tracker.new_events(late, seen, 4), "id") == [(151,)]
    # ids near each other share a bucket: those of a batch open few
    touched = seen._touched(seen.parts(), ("rows", "base"), spark.createDataFrame([(3000,)], "id long"))
    assert {b for b, _, _ in touched} == {30}
    # of the events of one id in a batch the usable one counts
    both = make_events([(7, "Welcome", 1, 5), (7, "Welcome", None, 1)])
    assert plain(tracker.first_of_ids(both), "fulfillment_id") == [(1,)]


def states(spark, rows):
    return spark.createDataFrame([(f, s, at(t)) for f, s, t in rows], "f_id long, state string, state_start_time timestamp_ntz")


def test_board_by_differences_equals_a_board_from_all(spark, tmp_path):
    board, now = tracker.board_writer(str(tmp_path), page_ids=5), {}
    steps = [
        {1: ("ENTERING", 0), 2: ("ENTERING", 1), 12: ("WAITING", 2), 13: ("WAITING", 2)},
        {2: ("WAITING", 5), 40: ("ENTERING", 6)},
        {12: ("DONE", 9)},
        {},
        {1: ("DONE", 10), 40: ("DONE", 11), 41: ("DONE", 11)},
    ]
    for batch, step in enumerate(steps):
        before = states(spark, [(f, *now[f]) for f in step if f in now])
        now |= step
        after, everything = states(spark, [(f, *x) for f, x in step.items()]), states(spark, [(f, *x) for f, x in now.items()])
        for _ in range(2):  # the batch may run again
            board.apply(tracker.Batch(batch, after, before, after, lambda e=everything: e))
        assert plain(tracker.read_board(spark, str(tmp_path), "counts")) == plain(current.state_counts(everything))
        assert plain(tracker.read_board(spark, str(tmp_path), "lists")) == plain(current.state_lists(everything, page_ids=5))
        written = spark.read.parquet(*[f"{tmp_path}/lists/rows/version={1000 * batch}/{b}" for b in ("*",)]) if step else None
        if batch == 2:
            assert written.count() == 2  # the page it leaves and the one it enters
    fresh = tracker.board_writer(f"{tmp_path}/late")
    fresh.apply(tracker.Batch(9, after, before, after, lambda: everything))
    assert plain(tracker.read_board(spark, f"{tmp_path}/late", "counts")) == plain(current.state_counts(everything))


def test_live_snapshots_equal_snapshots_of_all_events(spark, make_events, make_tables, tmp_path):  # noqa: F811
    rows = sorted(random_rows(12, 80, 9), key=lambda r: (r[3], r[0]))
    entities = sorted({r[2] for r in rows})
    starts = {e: min(r[3] for r in rows if r[2] == e) for e in entities}
    ends = {e: min((r[3] for r in rows if r[2] == e and r[1] == "FulfillmentEnded"), default=None) for e in entities}
    tables = make_tables(rows, [(e, at(starts[e]), None if ends[e] is None else at(ends[e])) for e in entities])
    size, hour = -(-len(rows) // 3), timedelta(seconds=40)
    live = tracker.LiveSnapshot(str(tmp_path), tables, lambda batch: batch.events.agg(F.max("created_at")).first()[0], lookback=hour, compact_every=2)
    none = spark.range(0)
    ticks = []
    for batch in range(3):
        events = make_events(rows[batch * size:(batch + 1) * size])
        live.apply(tracker.Batch(batch, events, none, none, lambda: none))
        ticks.append(at(rows[min(len(rows), (batch + 1) * size) - 1][3]))
        known = {**tables, "events": make_events(rows[:(batch + 1) * size])}
        seen = known["events"].select(F.col("fulfillment_id").alias("id")).distinct()
        known["fulfillments"] = tables["fulfillments"].join(seen, "id", "left_semi")
        want = snapshot.level_snapshot(snapshot.in_progress(known, ticks[-1], hour), ticks[-1])
        got = live.take(spark, ticks[-1])
        assert plain(got) == plain(want)
        assert all(str(tmp_path) in f for f in got.inputFiles()) and got.inputFiles()
    assert {r.t for r in live.read(spark).select("t").distinct().collect()} <= set(ticks)
    # entities that no later snapshot can show are dropped
    assert live.store(spark).all().count() < len(entities) or all(starts[e] > rows[-1][3] - 40 for e in entities)


def test_raw_log_spreads_a_large_day(spark, make_events, tmp_path):
    log = str(tmp_path / "log")
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = [(i, "Welcome", i, 10) for i in range(20_000)] + [(50_000 + i, "Welcome", i, 86_400 * (2 + i % 3)) for i in range(9)]
        for _ in range(2):
            writers.append_unique(make_events(rows), log, 0)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    files = {d.rsplit("=", 1)[1]: len(glob.glob(f"{d}/batch_id=0/*.parquet")) for d in glob.glob(f"{log}/day=*")}
    assert spark.read.parquet(log).count() == len(rows)
    assert max(files.values()) > 2 and sorted(files.values())[:3] == [1, 1, 1]


def test_spoiled_csv_gives_its_good_rows(spark, tmp_path):
    lines = ["id,type,extra,fulfillment_id,created_at,created_by_id", "1,Event::Welcome,,7,2020-01-01 12:00:00.5,u", "x,Event::Welcome,,7,2020-01-01 12:00:00,u",
             "3,Event::Welcome,,7,soon,u", "4,Event::Welcome,", "5,Event::Welcome,,7,2020-01-01 12:00:00,u,more", ",Event::Welcome,,,,", "9,Event::Welcome,,seven,2020-01-01 12:00:00,u"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    good, rejected = readers.split_events_csv(spark, str(tmp_path / "a.csv"))
    assert plain(good) == [(1, "Event::Welcome", 7, at(0.5), "u"), (None, "Event::Welcome", None, None, None)]
    assert good.schema.simpleString() == EVENT_SCHEMA.simpleString()
    assert plain(rejected) == sorted([(lines[2], "id"), (lines[3], "created_at"), (lines[4], "record"), (lines[5], "record"), (lines[7], "fulfillment_id")])
    text = spark.createDataFrame([("a Event::Welcome b 7x",)], "value string")
    assert plain(readers.parse_legacy(text)) == [("Event::Welcome", None)]


def test_lines_are_written_by_every_task_with_a_header_each(spark, tmp_path):
    lines = [' 1,a"b,"q, x ', '"2",#,', '#3,\t"', "4,'", "", " ", "5,é\\,"]
    path, empty = str(tmp_path / "lines"), str(tmp_path / "empty")
    df = spark.createDataFrame([(x,) for x in lines], "line string").repartition(3)
    writers.write_lines(df, path, "a,b")
    files = [open(f, encoding="utf-8").read().split("\n") for f in glob.glob(f"{path}/part-*")]
    assert len(files) > 1 and {f[0] for f in files} == {"a,b"}
    assert sorted(x for f in files for x in f[1:-1]) == sorted(x for x in lines if x)
    writers.write_lines(df.limit(0), empty, "a,b")
    assert spark.read.option("header", True).csv(empty).columns == ["a", "b"]


def test_records_to_judge_are_not_gathered_in_one_file(spark, monkeypatch):
    events = spark.range(0, 400, 1, 4).select("id", F.lit("Event::Welcome").alias("type"), F.col("id").alias("fulfillment_id"), F.lit(at(0)).cast("timestamp_ntz").alias("created_at"), F.lit("u").alias("created_by_id"))
    monkeypatch.setattr(queries, "_events", lambda spark, d: events)
    good, rejected = queries.csv_good_rows(spark, ""), queries.csv_rejected_rows(spark, "")
    assert len(good.inputFiles()) == len(rejected.inputFiles()) == 4
    assert plain(good, "id") == sorted([(i,) for i in range(400) if i % 50 > 2], key=repr)
    assert [n for _, n in plain(rejected.groupBy("reason").count())] == [8, 8, 8]


@pytest.mark.parametrize("stop", [None, "read", "delete"])
def test_a_log_is_folded_day_by_day(spark, make_events, tmp_path, monkeypatch, stop):
    log = str(tmp_path / "log")
    rows = [(10 * b + i, "Welcome", i, 86_400 * (i % 3)) for b in range(4) for i in range(9)]
    for b in range(4):
        writers.append_unique(make_events(rows[9 * b:9 * b + 9]).withColumn("created_at", F.when(F.col("id") % 10 != 8, F.col("created_at"))), log, b)
    want = plain(spark.read.parquet(log), "id", "day", "created_at")
    untouched = sorted(glob.glob(f"{log}/day=*/batch_id=3/*.parquet"))
    if stop:
        real, calls = writers.delete, []

        def failing(spark, folder):
            calls.append(folder)
            if stop == "read" or len(calls) == 3:
                raise InterruptedError
            real(spark, folder)

        monkeypatch.setattr(writers, "delete", failing)
        with pytest.raises(InterruptedError):
            writers.compact_log(spark, log, 2)
        monkeypatch.undo()
    writers.compact_log(spark, log, 2)
    assert plain(spark.read.parquet(log), "id", "day", "created_at") == want
    assert {f.rsplit("=", 1)[1] for f in glob.glob(f"{log}/day=*/batch_id=*")} == {"2", "3"}
    assert sorted(glob.glob(f"{log}/day=*/batch_id=3/*.parquet")) == untouched
    writers.compact_log(spark, log, 2)
    assert plain(spark.read.parquet(log), "id", "day", "created_at") == want


def test_a_version_alone_is_read_as_it_lies(spark, tmp_path):
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    row = lambda k, state: spark.createDataFrame([(k, state, None, None, None, at(0), k)], writers.CURRENT)
    states = writers.current_store(spark, str(tmp_path / "states"))
    states.put(row(1, "A"), 0)
    assert shuffles(states.all()) == 0
    states.put(row(1, "B"), 1)
    assert plain(states.all(), "f_id", "state") == [(1, "B")]
    states.compact(1)
    assert shuffles(states.all()) == 0 and plain(states.all(), "f_id", "state") == [(1, "B")]
    loose = store_at(spark, tmp_path / "loose")
    loose.put(rows_of(spark, [1], "a").unionByName(rows_of(spark, [1], "a")), 0)
    assert plain(loose.all()) == [(1, "a")]


def test_ids_of_one_bucket_are_written_by_several_tasks(spark, tmp_path):
    store = id_store(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # the test's rows are few
    store.put(spark.range(0, 1 << 23, 1 << 10), 0)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(folders(tmp_path, "rows")) == 1
    assert store.all().count() == 1 << 13 and sum(1 for _ in store.all().inputFiles()) > 1


def test_pointers_are_read_without_a_job(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.put(rows_of(spark, range(40), "a"), 0)
    spark.sparkContext.setJobGroup("pointers", "")
    named = store.parts()
    assert len(named) == len(folders(tmp_path, "rows")) and not spark.sparkContext.statusTracker().getJobIdsForGroup("pointers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
