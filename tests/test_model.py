import pytest

from stagetrace.model import FORWARD, LAST_WINS, STATES, TRACKED_TYPES, TYPE_STATE, TransitionTable

SHORT = {t: t.removeprefix("Event::") for t in TRACKED_TYPES}
MOVES = {
    ("ENTERING", "LmiConnected"): "WAITING",
    ("WAITING", "LaunchStart"): "LAUNCHING",
    ("LAUNCHING", "LaunchEnd"): "TESTING",
}


@pytest.mark.parametrize("state", STATES)
@pytest.mark.parametrize("kind", TRACKED_TYPES)
def test_forward_cells(state, kind):
    found = {(s, t): n for s, t, n in FORWARD.rows()}[(state, kind)]
    if state == "UNKNOWN":
        assert found == TYPE_STATE[kind]
    elif kind == "Event::FulfillmentEnded":
        assert found == "DONE"
    else:
        assert found == MOVES.get((state, SHORT[kind]), state)


def test_last_wins_cells():
    assert all(n == TYPE_STATE[t] for _, t, n in LAST_WINS.rows())


def test_table_from_frame(spark):
    df = spark.createDataFrame(FORWARD.rows(), "state string, event_type string, next_state string")
    assert TransitionTable.of(df) == FORWARD


def test_contradiction_is_refused():
    with pytest.raises(ValueError, match="two next states"):
        TransitionTable.from_rows([("A", "x", "B"), ("A", "x", "C")])


def test_too_large_is_refused():
    with pytest.raises(ValueError, match="limit"):
        TransitionTable.from_rows([("A", str(i), "B") for i in range(10_001)])
