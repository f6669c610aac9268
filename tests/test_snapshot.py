from datetime import timedelta

import pytest
from conftest import at, plain

from stagetrace.operators import snapshot as sn
from stagetrace.plans import skew

NOW = at(3600)


@pytest.fixture
def make_tables(spark, make_events):
    def make(events, fulfillments=None, taggings=(), tags=(), levels=((1, "BRONZE"), (2, "GOLD"))):
        entities = fulfillments or [(e, at(0), None) for e in sorted({r[2] for r in events})]
        frame = spark.createDataFrame
        return {
            "events": make_events(events),
            "fulfillments": frame(
                [(i, f"u{i}", i, s, e) for i, s, e in entities],
                "id long, uuid string, reservation_id long, actual_started_at timestamp_ntz, "
                "actual_ended_at timestamp_ntz"),
            "reservations": frame([(i, i) for i in range(1, 40)], "id long, iteration_id long"),
            "iterations": frame([(i, "LIVE", i % 3) for i in range(1, 30)], "id long, type string, exam_id int"),
            "exams": frame([(0, 100), (1, 101), (2, None)], "id int, institution_id long"),
            "institutions": frame([(100, 1), (101, 2)], "id long, proctor_level_id int"),
            "proctor_levels": frame(list(levels), "id int, name string"),
            "taggings": frame(list(taggings), "taggable_id long, taggable_type string, tag_id long, context string"),
            "tags": frame(list(tags), "id long, name string"),
        }

    return make


def state_of(make_tables, *events, now=NOW):
    rows = [(i, k, 3, s) for i, (k, s) in enumerate(events)]
    return sn.in_progress(make_tables(rows, [(3, at(0), None)]), now).first()["state"]


@pytest.mark.parametrize("events, want", [
    ([("Welcome", 1)], "PRECHECK"),
    ([("Welcome", 1), ("LmiConnected", 2)], "WAITING"),
    ([("LmiConnected", 2)], "WAITING"),
    ([("LmiConnected", 2), ("LaunchStart", 3)], "LAUNCHING"),
    ([("LaunchStart", 3)], "LAUNCHING"),
    ([("LaunchStart", 3), ("LaunchEnd", 4)], None),
    ([("LmiConnected", 2), ("LaunchEnd", 4)], None),
    ([("LmiConnected", 5), ("HardDisconnection", 4)], "WAITING"),
    ([("LmiConnected", 5), ("HardDisconnection", 5)], None),
    ([("LmiConnected", 5), ("HardDisconnection", 6)], None),
    ([("Welcome", 5), ("HardDisconnection", 4)], "PRECHECK"),
    ([("Welcome", 5), ("HardDisconnection", 5)], None),
    ([("LaunchStart", 5), ("HardDisconnection", 6)], "LAUNCHING"),
    ([("GetHelp", 5)], None),
    ([("Welcome", 5), ("LmiConnected", 3601)], "PRECHECK"),
])
def test_snapshot_state(make_tables, events, want):
    assert state_of(make_tables, *events) == want


def test_who_is_active(make_tables):
    three = timedelta(hours=3)
    entities = [
        (1, NOW - three, None), (2, NOW - three + timedelta(seconds=1), None), (3, NOW, None),
        (4, NOW + timedelta(seconds=1), None), (5, at(0), at(10)), (6, at(0), NOW), (7, at(0), at(3601)),
        (8, None, None)]
    tables = make_tables([(1, "Welcome", 1, 0)], entities)
    assert plain(sn.active_fulfillments(tables["fulfillments"], NOW), "id") == [(2,), (3,), (7,)]


def rich(make_tables):
    events = [
        (1, "Welcome", 1, 10), (2, "LmiConnected", 1, 70.25), (3, "Welcome", 2, 0), (4, "LmiConnected", 3, 3000),
        (5, "LaunchStart", 3, 3100.5), (6, "LaunchEnd", 3, 3200), (7, "LmiConnected", 4, 3540),
        (8, "LmiConnected", 6, 2699), (9, "LmiConnected", 33, 100)]
    taggings = [
        (100, "Institution", 1, "skills"), (100, "Institution", 2, "skills"), (100, "Institution", 3, "skills"),
        (100, "Institution", 9, "skills"), (100, "Exam", 2, "skills"), (100, "Institution", 1, "service_types"),
        (100, "Institution", 2, "service_types"), (101, "Institution", 3, "service_types")]
    return make_tables(events, taggings=taggings, tags=[(1, "b"), (2, "a"), (3, "a")])


def test_in_progress_row(make_tables):
    tables = rich(make_tables)
    rows = {r["f_id"]: r.asDict() for r in sn.in_progress(tables, NOW).collect()}
    assert len(rows[3]) == 18
    assert rows[1]["precheck_time"] == 60.25 and rows[1]["current_wait"] == 3529.75
    assert rows[3]["wait_time"] == 100.5 and rows[3]["launch_time"] == 99.5
    assert (rows[3]["institution_id"], rows[3]["proctor_level"], rows[3]["service_type"]) == (100, "BRONZE", "b")
    assert (rows[4]["institution_id"], rows[4]["proctor_level"], rows[4]["service_type"]) == (101, "GOLD", "a")
    assert (rows[2]["iteration_id"], rows[2]["institution_id"], rows[2]["proctor_level"]) == (2, None, None)
    # No such iteration: the row stays, with nothing known.
    assert rows[33]["iteration_id"] is None and rows[33]["state"] == "WAITING"


def test_skills_keep_nulls_and_repeats(make_tables):
    progress = sn.in_progress(rich(make_tables), NOW)
    full = {r[0]: r[1] for r in progress.select("f_id", sn.expand_skills("proctor_skills")).collect()}
    assert full[3] == [None, "a", "a", "b"]
    assert full[4] == [None] and full[2] == [None]


def test_two_service_types(make_tables):
    tables = rich(make_tables)
    assert plain(sn.service_types(tables)) == [(100, "b"), (101, "a")]
    with pytest.raises(Exception, match="more than one service type"):
        sn.service_types(tables, strict=True).collect()


def test_level_snapshot(make_tables):
    snap = {r["proctor_level"]: r.asDict() for r in sn.level_snapshot(
        sn.in_progress(rich(make_tables), NOW), NOW).collect()}
    gold, bronze, none = snap["GOLD"], snap["BRONZE"], snap[None]
    assert (gold["waiting_count"], gold["wait_1_min"], gold["wait_gt_15_min"]) == (2, 1, 1)
    assert gold["max_wait"] == 3529.75 and gold["avg_wait"] == (3529.75 + 60) / 2
    assert (bronze["waiting_count"], bronze["wait_gt_15_min"], bronze["launching_count"]) == (1, 1, 0)
    assert none["precheck_count"] == 1 and none["waiting_count"] == 1
    assert plain(sn.metric_rows(sn.level_snapshot(sn.in_progress(rich(make_tables), NOW), NOW)))[0][0] == NOW


def test_histogram_and_summary(make_tables):
    progress = sn.in_progress(rich(make_tables), NOW)
    assert plain(sn.wait_histogram(progress, NOW)) == sorted(
        [("GOLD", 1, 1), ("GOLD", 16, 1), ("BRONZE", 16, 1), (None, 16, 1)], key=repr)
    summary = {r["csr_level"]: r for r in sn.wait_summary(progress, NOW).collect()}
    assert (summary["GOLD"]["zero_to_five"], summary["GOLD"]["wait_count"]) == (1, 2)
    assert summary["GOLD"]["max_wait"] == 3529.75 / 60
    assert (summary[None]["wait_count"], summary[None]["zero_to_five"]) == (2, 0)


def test_large_inputs_take_the_same_route_to_the_same_rows(make_tables, monkeypatch):
    tables = rich(make_tables)
    want = plain(sn.level_snapshot(sn.in_progress(tables, NOW), NOW))
    monkeypatch.setattr(skew.broadcast_if_small, "__defaults__", (0, False))
    assert plain(sn.level_snapshot(sn.in_progress(tables, NOW), NOW)) == want


def test_series_equals_single_snapshots(make_tables):
    events = [
        (1, "Welcome", 1, 2), (2, "LmiConnected", 1, 30), (3, "HardDisconnection", 1, 400), (4, "Welcome", 2, 3),
        (5, "LmiConnected", 2, 40.5), (6, "LaunchStart", 2, 1300), (7, "LaunchEnd", 2, 1500),
        (8, "HardDisconnection", 3, 1), (9, "LmiConnected", 3, 1), (10, "LmiConnected", 4, 60),
        (11, "HardDisconnection", 4, 59), (12, "FulfillmentEnded", 4, 700), (13, "LaunchEnd", 6, 9),
        (14, "LmiConnected", 6, 20), (15, "Welcome", 7, 500), (16, "LaunchStart", 9, 100), (17, "LmiConnected", 9, 90)]
    entities = [(1, at(2), None), (2, at(3), None), (3, at(0), None), (4, at(59), at(700)), (6, at(9), None),
                (7, at(600), None), (9, None, None), (10, at(-500), at(300))]
    tables = make_tables(events, entities)
    start, end, step, back = at(-20), at(1700), timedelta(seconds=20), timedelta(seconds=900)
    got = plain(sn.snapshot_series(tables, start, end, step, back))
    want = []
    for k in (1, 4, 5, 22, 46, 67):
        t = start + k * step
        want += plain(sn.level_snapshot(sn.in_progress(tables, t, back), t))
    times = {r[0] for r in want}
    assert sorted((r for r in got if r[0] in times), key=repr) == sorted(want, key=repr)
    assert len(times) == 6 and max(r[0] for r in got) <= end
