import random
from collections import defaultdict

import pytest
from conftest import T0, at, plain
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stagetrace.model import FORWARD, LAST_WINS, TransitionTable
from stagetrace.operators import lifecycle as lc

KINDS = ["Welcome", "LmiConnected", "LaunchStart", "LaunchEnd", "FulfillmentEnded", "GetHelp", None]
CYCLE = TransitionTable.from_rows([
    ("UNKNOWN", "Event::Welcome", "A"), ("A", "Event::LmiConnected", "B"),
    ("B", "Event::LmiConnected", "C"), ("C", "Event::Welcome", "A"),
    ("B", "Event::LaunchStart", "A"), ("UNKNOWN", "Event::GetHelp", "C")])
HOT = dict(hot_rows=3, chunk_rows=4)


def walk(rows, table):
    """Per event (id, entity, before, after), by following the table one event at a time."""
    step = {(s, t): n for s, t, n in table.rows()}
    by_entity = defaultdict(list)
    for i, kind, entity, sec in rows:
        if entity is not None:
            by_entity[entity].append((sec, i, kind))
    out = []
    for entity, events in by_entity.items():
        state = None
        for sec, i, kind in sorted(events, key=lambda e: e[:2]):
            now = "UNKNOWN" if state is None else state
            after = step.get((now, f"Event::{kind}"), now)
            out.append((i, entity, state, after, sec))
            state = after
    return out


def changes(rows, table):
    """(entity, old, new, seconds in state, seconds since first, event id)."""
    since, first, out = {}, {}, []
    for i, entity, before, after, sec in walk(rows, table):
        if before is None:
            since[entity] = first[entity] = sec
        elif before != after:
            out.append((entity, before, after, sec - since[entity], sec - first[entity], i))
            since[entity] = sec
    return sorted(out, key=repr)


def random_rows(seed, n, entities, hot_share=0.0):
    rnd = random.Random(seed)
    pick = lambda: 0 if rnd.random() < hot_share else rnd.randrange(entities)
    return [(i, rnd.choice(KINDS), pick(), rnd.randrange(n // 2)) for i in range(n)]


@pytest.mark.parametrize("table", [FORWARD, LAST_WINS, CYCLE], ids=["forward", "last", "cycle"])
@pytest.mark.parametrize("opts", [{}, HOT], ids=["cold", "hot"])
def test_fold_equals_walk(make_events, table, opts):
    rows = random_rows(7, 120, 12, 0.3)
    events = make_events(rows)
    got = plain(lc.fsm_states(events, table, **opts), "id", "fulfillment_id", "state_before", "state_after")
    assert got == sorted((r[:4] for r in walk(rows, table)), key=repr)
    want = changes(rows, table)
    cols = ("f_id", "old_state", "new_state", "time_in_state", "event_id")
    assert plain(lc.state_changes(events, table, **opts), *cols) == sorted(
        ((e, o, n, t, i) for e, o, n, t, _, i in want), key=repr)
    assert plain(lc.state_changes(events, table, anchor="first_seen", **opts), *cols) == sorted(
        ((e, o, n, f, i) for e, o, n, _, f, i in want), key=repr)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(KINDS), st.integers(0, 3), st.integers(0, 20)), min_size=1))
def test_fold_on_any_sequence(make_events, triples):
    rows = [(i, kind, entity, sec) for i, (kind, entity, sec) in enumerate(triples)]
    for opts in ({"hot_rows": None}, HOT):
        got = plain(lc.fsm_states(make_events(rows), **opts), "id", "fulfillment_id", "state_before", "state_after")
        assert got == sorted((r[:4] for r in walk(rows, FORWARD)), key=repr)


@pytest.mark.parametrize("opts", [{}, HOT], ids=["cold", "hot"])
def test_visits_chain(make_events, opts):
    rows = random_rows(11, 300, 6, 0.4)
    visits = lc.state_visits(make_events(rows), LAST_WINS, **opts).collect()
    by_entity = defaultdict(list)
    for v in visits:
        by_entity[v["fulfillment_id"]].append(v)
    for chain in by_entity.values():
        chain.sort(key=lambda v: (v["start_time"], v["start_id"]))
        assert chain[0]["prev_state"] is None and chain[-1]["end_id"] is None
        for a, b in zip(chain, chain[1:]):
            assert (a["end_time"], a["end_id"], a["next_state"]) == (
                b["start_time"], b["start_id"], b["state"])
            assert (b["prev_start"], b["prev_id"], b["prev_state"]) == (
                a["start_time"], a["start_id"], a["state"])
        assert {v["first_seen"] for v in chain} == {chain[0]["start_time"]}


def test_hot_entity_with_equal_times(make_events):
    """A whole entity at one instant is still cut into chunks, by event id."""
    rows = [(i, random.Random(i).choice(KINDS), 1, 5) for i in range(60)]
    got = plain(lc.fsm_states(make_events(rows), LAST_WINS, **HOT), "id", "fulfillment_id", "state_before", "state_after")
    assert got == sorted((r[:4] for r in walk(rows, LAST_WINS)), key=repr)


def test_documented_history(make_events):
    """Time in state is the trigger's time minus the start of the state left."""
    rows = [
        (1, "Welcome", 7, 0), (2, "LmiConnected", 7, 400), (3, "LaunchStart", 7, 1223),
        (4, "LaunchEnd", 7, 1547), (5, "FulfillmentEnded", 7, 5340)]
    changes_ = lc.state_changes(make_events(rows))
    assert plain(lc.history(changes_), "state", "time_in_state") == [
        ("ENTERING", 400), ("LAUNCHING", 324), ("TESTING", 3793), ("WAITING", 823)]
    assert plain(lc.time_per_state(changes_), "f_id", "state", "time_in_state") == [
        (7, "ENTERING", 400), (7, "LAUNCHING", 324), (7, "TESTING", 3793), (7, "WAITING", 823)]


def test_current_and_intervals(make_events):
    events = make_events([(1, "Welcome", 1, 0), (2, "LmiConnected", 1, 60), (3, "LaunchStart", 2, 5)])
    visits = lc.state_visits(events)
    assert plain(lc.current_of(visits)) == [(1, "WAITING", at(60)), (2, "LAUNCHING", at(5))]
    assert plain(lc.current_of(visits, "first_seen")) == [(1, "WAITING", T0), (2, "LAUNCHING", at(5))]
    assert plain(lc.state_intervals(visits)) == [
        (1, "ENTERING", T0, at(60)), (1, "WAITING", at(60), None), (2, "LAUNCHING", at(5), None)]


def test_wrap_days(make_events):
    day = 86_400
    events = make_events([(1, "Welcome", 1, 0), (2, "LmiConnected", 1, 2 * day + 7)])
    assert lc.state_changes(events).first()["time_in_state"] == 2 * day + 7
    assert lc.state_changes(events, wrap_days=True).first()["time_in_state"] == 7


def test_unknown_types(make_events):
    events = make_events([(1, "GetHelp", 1, 0), (2, "Welcome", 1, 5), (3, None, 1, 6)])
    assert plain(lc.state_changes(events), "old_state", "new_state", "time_in_state") == [
        ("UNKNOWN", "ENTERING", 5)]
    with pytest.raises(Exception, match="not in the transition table"):
        lc.state_changes(events, on_unknown="error").collect()


def test_last_event_history_leaves_unknown(make_events):
    events = make_events([(1, "LaunchEnd", 1, 0), (2, "GetHelp", 1, 4), (3, "Welcome", 1, 9)])
    assert plain(lc.last_event_history(events)) == [(1, "TESTING", 9)]


def test_entities_without_id_are_not_tracked(make_events):
    assert lc.state_visits(make_events([(1, "Welcome", None, 0)])).count() == 0


def test_bad_anchor(make_events):
    with pytest.raises(ValueError, match="anchor"):
        lc.state_changes(make_events([(1, "Welcome", 1, 0)]), anchor="other")


def test_one_exchange(make_events):
    """Changes, intervals and current state come out of a single shuffle."""
    visits = lc.state_visits(make_events([(1, "Welcome", 1, 0)]), hot_rows=None)
    for df in (lc.changes_of(visits), lc.state_intervals(visits), lc.current_of(visits)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "Window" not in plan and "Python" not in plan



@pytest.mark.parametrize("table", [FORWARD, LAST_WINS])
def test_thousands_of_chunks_of_one_entity(spark, make_events, monkeypatch, table):
    """A scan of several levels; a task composes no more than a block of an entity's chunks."""
    monkeypatch.setattr(lc, "SCAN_BLOCK", 4)
    rows = random_rows(3, 300, 2)
    events = make_events(rows)
    for run in (lc.state_changes, lc.fsm_states):
        assert plain(run(events, table, hot_rows=5, chunk_rows=2)) == plain(run(events, table, hot_rows=None))
    chunks = spark.range(2000).select(
        F.lit(7).cast("long").alias(lc.KEY), F.col("id").cast("int").alias("chunk"),
        F.transform(F.sequence(F.lit(0), F.lit(2)), lambda j: F.struct(F.pmod(F.col("id") * 7 + j * 3, F.lit(6)).cast("int").alias("code"))).alias("history"))
    got = {r.chunk: (r.incoming, r.fresh) for r in lc._incoming(chunks, table).collect()}
    state, want = table.seed, {}
    for c in range(2000):
        want[c] = (state, c == 0)
        for j in range(3):
            state = table.cells[state * table.width + (c * 7 + j * 3) % 6]
    assert got == want
    plan = lc._incoming(chunks, table)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "Python" not in plan
