import random

import pytest
from conftest import at, plain
from test_lifecycle import random_rows, walk

from stagetrace.model import FORWARD, LAST_WINS
from stagetrace.operators import active, census, current
from stagetrace.operators import lifecycle as lc


def census_by_walk(rows, table, first_seen):
    ordered = sorted(walk(rows, table), key=lambda r: (r[4], r[0]))
    state, since, first, out = {}, {}, {}, []
    for i, entity, before, after, sec in ordered:
        first.setdefault(entity, sec)
        if before != after:
            state[entity], since[entity] = after, sec
        start = first if first_seen else since
        for s in set(state.values()):
            members = [e for e in state if state[e] == s]
            out.append((at(sec), i, s, len(members), at(max(start[e] for e in members))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("anchor", ["state_start", "first_seen"])
@pytest.mark.parametrize("table", [FORWARD, LAST_WINS], ids=["forward", "last"])
@pytest.mark.parametrize("chunk_rows", [17, 1000])
def test_running_census(make_events, table, anchor, chunk_rows):
    rows = random_rows(5, 150, 12, 0.35)
    got = census.running_census(make_events(rows), table, anchor, chunk_rows)
    assert plain(got) == census_by_walk(rows, table, anchor == "first_seen")


def test_running_counts(make_events):
    rows = random_rows(6, 120, 10)
    want = {}
    for t, i, state, n, _ in census_by_walk(rows, FORWARD, False):
        want.setdefault((t, i), {})[state.lower()] = n
    names = [s.lower() for s in FORWARD.states]
    got = plain(census.running_counts(make_events(rows), chunk_rows=20), "created_at", "id", *names)
    assert got == sorted(((t, i, *[c.get(s, 0) for s in names]) for (t, i), c in want.items()), key=repr)


def test_peak_keeps_ties_and_later_counts(spark):
    rows = [
        (at(1), 1, "WAITING", 2, at(1)), (at(2), 2, "WAITING", 1, at(1)), (at(3), 3, "WAITING", 2, at(3)),
        (at(4), 4, "WAITING", 2, at(4)), (at(5), 5, "DONE", 9, at(5))]
    df = spark.createDataFrame(
        rows, "created_at timestamp_ntz, id long, state string, n long, max_start timestamp_ntz")
    assert plain(census.peak_waiting(df)) == [(at(3), 2), (at(4), 2)]


def test_counts_and_census_of_current_state(make_events):
    events = make_events([(1, "Welcome", 1, 0), (2, "Welcome", 2, 5), (3, "FulfillmentEnded", 3, 6)])
    now = lc.current_of(lc.state_visits(events))
    assert dict(plain(current.state_counts(now))) == {
        "ENTERING": 2, "WAITING": 0, "LAUNCHING": 0, "TESTING": 0, "DONE": 1, "UNKNOWN": 0}
    assert plain(current.state_census(now)) == [("DONE", at(6), 1), ("ENTERING", at(5), 2)]
    assert current.state_counts_json(now).first()[0] == (
        '{"ENTERING":2,"WAITING":0,"LAUNCHING":0,"TESTING":0,"DONE":1,"UNKNOWN":0}')
    assert plain(current.state_pairs(now)) == [(1, "ENTERING"), (2, "ENTERING"), (3, "DONE")]
    assert plain(current.entity_row(now, 2)) == [(2, "ENTERING", at(5))]


def test_lists_come_in_bounded_pages(spark):
    now = spark.createDataFrame(
        [(i, "WAITING" if i % 2 else "DONE", at(i)) for i in range(50)],
        "f_id long, state string, state_start_time timestamp_ntz")
    pages = current.state_lists(now, page_ids=10).collect()
    assert max(len(p["items"]) for p in pages) <= 10
    waiting = sorted((p["page"], p["items"]) for p in pages if p["state"] == "WAITING")
    assert [i["f_id"] for _, items in waiting for i in items] == list(range(1, 50, 2))
    assert {p["state"] for p in pages if not p["items"]} == {"ENTERING", "LAUNCHING", "TESTING", "UNKNOWN"}


def test_board_items(spark):
    now = spark.createDataFrame(
        [(15905113, "WAITING", at(0))], "f_id long, state string, state_start_time timestamp_ntz")
    assert plain(current.board_items(now, "America/Chicago")) == [
        (15905113, "WAITING", "#C55479", "2020-01-01 06:00:00")]


def active_by_walk(rows):
    labels, state = active.MILESTONES, {}
    for i, kind, entity, sec in sorted(rows, key=lambda r: (r[3], r[0])):
        if entity is None:
            continue
        name = f"Event::{kind}"
        state.setdefault(entity, active.NEW)
        if name in labels:
            state[entity] = labels[name]
        elif name == active.TERMINAL:
            del state[entity]
    return sorted(state.items(), key=repr)


def test_active_milestones(make_events):
    rnd = random.Random(2)
    kinds = ["Welcome", "LMIConnected", "LaunchStart", "LaunchExamClicked", "LaunchEnd", "Other", None]
    rows = [(i, rnd.choice(kinds), rnd.randrange(40), rnd.randrange(60)) for i in range(150)]
    assert plain(active.active_milestones(make_events(rows))) == active_by_walk(rows)


@pytest.mark.parametrize("chunk_rows", [5, 1000])
def test_event_ids_may_repeat(make_events, chunk_rows):
    """The same id on several entities: visits are told apart by entity, so counts are right."""
    rows = random_rows(11, 60, 6)
    shared = [(i % 4, kind, entity, sec) for i, kind, entity, sec in rows]
    rows = [(i, kind, entity, n) for n, (i, kind, entity, _) in enumerate(shared)]
    got = census.running_census(make_events(rows), LAST_WINS, chunk_rows=chunk_rows)
    unique = [(n, kind, entity, sec) for n, (_, kind, entity, sec) in enumerate(rows)]
    want = census_by_walk(unique, LAST_WINS, False)
    drop = lambda rs: sorted(((r[0], *r[2:]) for r in rs), key=repr)
    assert drop(plain(got)) == drop(want)


def test_census_of_some_states_is_part_of_that_of_all(make_events):
    events = make_events(random_rows(7, 150, 12, 0.35))
    every = [r for r in plain(census.running_census(events, LAST_WINS, chunk_rows=17)) if r[2] in ("WAITING", "DONE")]
    assert plain(census.running_census(events, LAST_WINS, chunk_rows=17, states=("WAITING", "DONE"))) == every


def test_nothing_is_shuffled_after_the_time_layout(make_events):
    counts = census.running_counts(make_events(random_rows(7, 150, 12)), chunk_rows=17)
    assert "Exchange hashpartitioning" not in counts._jdf.queryExecution().executedPlan().toString()
