"""Schemas, state domain and transition tables.

A transition table is plain data: rows of ``(state, event_type, next_state)``.
The two tables at the end differ only in those rows, so one operator runs both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The state domain, the tracked event types and their states.
STATES = ["ENTERING", "WAITING", "LAUNCHING", "TESTING", "DONE", "UNKNOWN"]
UNKNOWN = "UNKNOWN"
DONE = "DONE"

WELCOME = "Event::Welcome"
LMI_CONNECTED = "Event::LmiConnected"
LAUNCH_START = "Event::LaunchStart"
LAUNCH_END = "Event::LaunchEnd"
FULFILLMENT_ENDED = "Event::FulfillmentEnded"
HARD_DISCONNECTION = "Event::HardDisconnection"
GET_HELP = "Event::GetHelp"

TYPE_STATE = {
    WELCOME: "ENTERING",
    LMI_CONNECTED: "WAITING",
    LAUNCH_START: "LAUNCHING",
    LAUNCH_END: "TESTING",
    FULFILLMENT_ENDED: "DONE",
}
TRACKED_TYPES = list(TYPE_STATE)

EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("fulfillment_id", T.LongType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("created_by_id", T.StringType()),
])

# As in files: times are text there and parsed after the read.
EVENT_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("fulfillment_id", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("created_by_id", T.StringType()),
])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("f_id", T.LongType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("created_by", T.StringType()),
])

TABLE_NAMES = [
    "events", "fulfillments", "reservations", "iterations", "exams",
    "institutions", "proctor_levels", "taggings", "tags",
]


def resume_type(state: str) -> str:
    """Type of the event by which an entity goes on in a state known from before."""
    return f"\0resume {state}"


# A transition table is a parameter, not data that grows: it is written into every plan as
# literals. Larger ones are refused, for nothing of them may be dropped.
MAX_TRANSITIONS = 10_000


@dataclass(frozen=True)
class TransitionTable:
    """A validated transition table in the shape the fold works on.

    ``cells`` is the table flattened row by row: one row per state, one column per
    event type, with column 0 for types the table does not name (state is kept).
    """

    states: tuple[str, ...]
    types: tuple[str, ...]
    cells: tuple[int, ...]

    @classmethod
    def from_rows(cls, rows) -> TransitionTable:
        rows = [tuple(r) for r in rows]
        if len(rows) > MAX_TRANSITIONS:
            raise ValueError(f"transition table has {len(rows)} rows, limit {MAX_TRANSITIONS}")
        named = {s for r in rows for s in (r[0], r[2])} | {UNKNOWN}
        states = [s for s in STATES if s in named] + sorted(named - set(STATES))
        types = sorted({r[1] for r in rows})
        step = {}
        for state, event_type, next_state in rows:
            if step.setdefault((state, event_type), next_state) != next_state:
                raise ValueError(f"two next states for {state} / {event_type}")
        cells = []
        for s in states:
            cells.append(states.index(s))
            cells += [states.index(step.get((s, t), s)) for t in types]
        return cls(tuple(states), tuple(types), tuple(cells))

    @classmethod
    def from_df(cls, df: DataFrame) -> TransitionTable:
        rows = df.select("state", "event_type", "next_state").limit(MAX_TRANSITIONS + 1).collect()
        return cls.from_rows(rows)

    @classmethod
    def of(cls, table) -> TransitionTable:
        if isinstance(table, TransitionTable):
            return table
        return cls.from_df(table) if isinstance(table, DataFrame) else cls.from_rows(table)

    def resuming(self) -> TransitionTable:
        """The table with one more type per state, ``resume_type(state)``, that sets it from anywhere."""
        n = len(self.states)
        cells = []
        for i in range(n):
            cells += [*self.cells[i * self.width:(i + 1) * self.width], *range(n)]
        return TransitionTable(self.states, (*self.types, *map(resume_type, self.states)), tuple(cells))

    def absorbing(self) -> tuple[str, ...]:
        """States that no event leaves."""
        w = self.width
        return tuple(s for i, s in enumerate(self.states) if i != self.seed and set(self.cells[i * w:(i + 1) * w]) == {i})

    @property
    def width(self) -> int:
        return len(self.types) + 1

    @property
    def seed(self) -> int:
        return self.states.index(UNKNOWN)

    def code(self, event_type: Column, on_unknown: str = "ignore") -> Column:
        """Column of ``event_type`` in the table, 0 when the table does not name it."""
        at = F.coalesce(F.array_position(_literals(self.types), event_type), F.lit(0)).cast("int")
        if on_unknown == "ignore":
            return at
        if on_unknown == "error":
            message = F.concat(F.lit("event type not in the transition table: "),
                               F.coalesce(event_type, F.lit("NULL")))
            return F.when(at == 0, F.raise_error(message).cast("int")).otherwise(at)
        raise ValueError(f"on_unknown must be 'ignore' or 'error', not {on_unknown!r}")

    def step(self, state: Column, code: Column) -> Column:
        return F.get(_literals(self.cells), state * F.lit(self.width) + code)

    def name(self, state: Column) -> Column:
        return F.get(_literals(self.states), state)

    def rows(self) -> list[tuple[str, str, str]]:
        return [
            (s, t, self.states[self.cells[i * self.width + 1 + j]])
            for i, s in enumerate(self.states)
            for j, t in enumerate(self.types)
        ]


def _literals(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _seed_rows():
    return [(UNKNOWN, t, s) for t, s in TYPE_STATE.items()]


# Stages are passed in order, each by its own trigger; the end event closes from anywhere.
FORWARD = TransitionTable.from_rows(
    _seed_rows()
    + [
        ("ENTERING", LMI_CONNECTED, "WAITING"),
        ("WAITING", LAUNCH_START, "LAUNCHING"),
        ("LAUNCHING", LAUNCH_END, "TESTING"),
    ]
    + [(s, FULFILLMENT_ENDED, DONE) for s in ("ENTERING", "WAITING", "LAUNCHING", "TESTING")]
)

# Every known event sets its own state, backwards too.
LAST_WINS = TransitionTable.from_rows(
    [(s, t, to) for s in STATES for t, to in TYPE_STATE.items()]
)
