"""The registered queries in plain SQL over the supplied tables, written independently of Spark.

States come from walking each entity's events one after another with a recursive query; the
series and the census are evaluated point by point.
"""

from __future__ import annotations

_FIXTURE = """
fx_src AS (
  SELECT event_id AS id,
    CASE WHEN event_type = 'signup' THEN 'Event::Welcome'
         WHEN event_type = 'view' AND value <= 150 THEN 'Event::LmiConnected'
         WHEN event_type = 'view' THEN 'Event::GetHelp'
         WHEN event_type = 'click' THEN 'Event::LaunchStart'
         WHEN event_type = 'purchase' THEN 'Event::LaunchEnd'
         WHEN event_type = 'error' AND value >= 10 THEN 'Event::FulfillmentEnded'
         WHEN event_type = 'error' THEN 'Event::HardDisconnection' END AS type,
    user_id, ts, CAST(user_id AS VARCHAR) AS created_by_id
  FROM events),
fx_events AS (
  SELECT id, type, CAST(user_id * 100 + day(ts) AS BIGINT) AS fulfillment_id,
    TIMESTAMP '2024-01-01' + to_microseconds(
      (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 60) AS created_at, created_by_id
  FROM fx_src),
fx_raw AS (
  SELECT id, type, user_id AS fulfillment_id, ts AS created_at, created_by_id FROM fx_src),
fulfillments AS (
  SELECT fulfillment_id AS id, 'f-' || fulfillment_id AS uuid,
    fulfillment_id % (SELECT count(*) FROM orders) AS reservation_id,
    CASE WHEN (fulfillment_id // 100) % 10 <> 9 THEN min(created_at) END AS actual_started_at,
    min(created_at) FILTER (WHERE type = 'Event::FulfillmentEnded') AS actual_ended_at
  FROM fx_events GROUP BY fulfillment_id),
reservations AS (SELECT o_orderkey AS id, o_custkey AS iteration_id FROM orders),
iterations AS (SELECT c_custkey AS id, c_mktsegment AS type, c_nationkey AS exam_id FROM customer),
exams AS (
  SELECT n_nationkey AS id,
    (SELECT min(s_suppkey) FROM supplier WHERE s_nationkey = n_nationkey) AS institution_id
  FROM nation),
institutions AS (
  SELECT s_suppkey AS id, CASE WHEN s_suppkey % 7 <> 3 THEN n_regionkey END AS proctor_level_id
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
proctor_levels AS (SELECT r_regionkey AS id, r_name AS name FROM region),
tags AS (SELECT p_partkey AS id, p_brand AS name FROM part),
taggings AS (
  SELECT CAST(p_size AS BIGINT) AS taggable_id, 'Institution' AS taggable_type,
    p_partkey AS tag_id, 'skills' AS context FROM part WHERE p_partkey % 10 < 3
  UNION ALL
  SELECT p_size, 'Exam', p_partkey, 'skills' FROM part WHERE p_partkey % 10 = 4
  UNION ALL
  SELECT s_suppkey, 'Institution', s_suppkey, 'service_types' FROM supplier WHERE s_suppkey % 2 = 0)
"""

_FIVE = """('Event::Welcome', 'Event::LmiConnected', 'Event::LaunchStart', 'Event::LaunchEnd',
  'Event::FulfillmentEnded')"""

# What each type triggers, and the cells of the forward table that move.
_TRIGGERS = """
triggers(type, state) AS (VALUES
  ('Event::Welcome', 'ENTERING'), ('Event::LmiConnected', 'WAITING'),
  ('Event::LaunchStart', 'LAUNCHING'), ('Event::LaunchEnd', 'TESTING'),
  ('Event::FulfillmentEnded', 'DONE')),
domain(state) AS (VALUES ('ENTERING'), ('WAITING'), ('LAUNCHING'), ('TESTING'), ('DONE'), ('UNKNOWN'))
"""
_FORWARD = """
cells(state, type, nxt) AS (
  SELECT 'UNKNOWN', type, state FROM triggers
  UNION ALL VALUES
  ('ENTERING', 'Event::LmiConnected', 'WAITING'), ('WAITING', 'Event::LaunchStart', 'LAUNCHING'),
  ('LAUNCHING', 'Event::LaunchEnd', 'TESTING'), ('ENTERING', 'Event::FulfillmentEnded', 'DONE'),
  ('WAITING', 'Event::FulfillmentEnded', 'DONE'), ('LAUNCHING', 'Event::FulfillmentEnded', 'DONE'),
  ('TESTING', 'Event::FulfillmentEnded', 'DONE'))
"""
_LAST_WINS = """
cells(state, type, nxt) AS (
  SELECT d.state, t.type, t.state FROM domain d, triggers t)
"""


def _walk(source: str, cells: str = _FORWARD) -> str:
    return f"""{_FIXTURE}, {_TRIGGERS}, {cells},
ev AS (
  SELECT fulfillment_id AS f, id, created_at AS t, type,
    row_number() OVER (PARTITION BY fulfillment_id ORDER BY created_at, id) AS pos
  FROM {source}),
walk AS (
  SELECT f, id, t, type, pos, CAST(NULL AS VARCHAR) AS before, coalesce(nxt, 'UNKNOWN') AS after
  FROM ev LEFT JOIN (SELECT type, nxt FROM cells WHERE state = 'UNKNOWN') c USING (type)
  WHERE pos = 1
  UNION ALL
  SELECT e.f, e.id, e.t, e.type, e.pos, w.after, coalesce(c.nxt, w.after)
  FROM walk w JOIN ev e ON e.f = w.f AND e.pos = w.pos + 1
  LEFT JOIN cells c ON c.state = w.after AND c.type = e.type),
visits AS (
  SELECT f, after AS state, t AS vstart, id AS vid,
    lead(t) OVER w AS vend, lead(id) OVER w AS eid, lead(after) OVER w AS nxt,
    min(t) OVER (PARTITION BY f) AS first_seen
  FROM walk WHERE before IS NULL OR before <> after
  WINDOW w AS (PARTITION BY f ORDER BY t, id)),
current AS (
  SELECT f AS f_id, state, vstart AS state_start_time, first_seen FROM visits WHERE eid IS NULL)
"""


def _after(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


def _plain(select: str) -> str:
    return _after(_FIXTURE, select)


def _changes(source: str, cells: str = _FORWARD, anchor: str = "vstart", wrap: bool = False) -> str:
    secs = f"CAST(floor((epoch_us(vend) - epoch_us({anchor})) / 1000000) AS BIGINT)"
    spent = f"{secs} % 86400" if wrap else secs
    return f"""{_walk(source, cells)},
changes AS (
  SELECT f AS f_id, state AS old_state, nxt AS new_state, {spent} AS time_in_state,
    vend AS change_time, eid AS event_id FROM visits WHERE eid IS NOT NULL)
"""


_TRACKED = f"(SELECT * FROM fx_events WHERE type IN {_FIVE})"
_BEFORE = "created_at >= TIMESTAMP '2024-01-01 02:00:00'"
_HALF_OPEN = f"{_BEFORE} AND created_at < TIMESTAMP '2024-01-01 08:00:00' AND type IN {_FIVE}"
_CLOSED = f"{_BEFORE} AND created_at <= TIMESTAMP '2024-01-01 08:00:00' AND type IN {_FIVE}"

_COMPLETE = f"""complete AS (
  SELECT fulfillment_id FROM fx_events GROUP BY fulfillment_id
  HAVING list_sort(list(DISTINCT type)) = list_sort({_FIVE.replace('(', '[').replace(')', ']')})
    AND count(*) = count(type))
"""

_MESSAGE = """SELECT id, type AS event_type, fulfillment_id AS f_id,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS event_time, created_by_id AS created_by FROM fx_events"""


def _slots(where: str, pick: str, step_us: int) -> str:
    return f"""
SELECT e.*, TIMESTAMP '2024-01-01 02:00:00' + to_microseconds(slot * {step_us}) AS slot_start,
  TIMESTAMP '2024-01-01 02:00:00' + to_microseconds((slot + 1) * {step_us}) AS slot_end
FROM (SELECT *, {pick} FROM fx_events WHERE {where}) e"""


_PASSED = "(epoch_us(created_at) - epoch_us(TIMESTAMP '2024-01-01 02:00:00'))"


def _progress(ticks: str) -> str:
    return f"""{_FIXTURE},
ticks AS ({ticks}),
act AS (
  SELECT tick, f.* FROM ticks JOIN fulfillments f
  ON actual_started_at > tick - INTERVAL 3 HOUR AND actual_started_at <= tick
  AND (actual_ended_at IS NULL OR actual_ended_at > tick)),
firsts AS (
  SELECT tick, a.id,
    min(created_at) FILTER (WHERE e.type = 'Event::Welcome') AS welcome,
    min(created_at) FILTER (WHERE e.type = 'Event::LmiConnected') AS lmi_connected,
    min(created_at) FILTER (WHERE e.type = 'Event::LaunchStart') AS launch_start,
    min(created_at) FILTER (WHERE e.type = 'Event::LaunchEnd') AS launch_end,
    min(created_at) FILTER (WHERE e.type = 'Event::HardDisconnection') AS disconnect
  FROM act a LEFT JOIN fx_events e ON e.fulfillment_id = a.id AND e.created_at <= tick
  GROUP BY tick, a.id),
skills AS (
  SELECT institution_id, string_agg(coalesce(name, '<null>') || '*' || n, ',' ORDER BY name NULLS FIRST)
    AS skills
  FROM (SELECT taggable_id AS institution_id, name, count(*) AS n
        FROM taggings LEFT JOIN tags ON tags.id = tag_id
        WHERE context = 'skills' AND taggable_type = 'Institution' GROUP BY ALL)
  GROUP BY institution_id),
progress AS (
  SELECT a.tick, a.id AS f_id, a.uuid AS f_uuid, it.id AS iteration_id, i.id AS institution_id,
    it.type AS iteration_type, l.name AS proctor_level,
    (SELECT max(g.name) FROM taggings t LEFT JOIN tags g ON g.id = t.tag_id
     WHERE t.taggable_id = i.id AND context = 'service_types' AND taggable_type = 'Institution')
      AS service_type,
    welcome, (epoch_us(lmi_connected) - epoch_us(welcome)) / 1e6 AS precheck_time,
    lmi_connected, (epoch_us(launch_start) - epoch_us(lmi_connected)) / 1e6 AS wait_time,
    (epoch_us(a.tick) - epoch_us(lmi_connected)) / 1e6 AS current_wait,
    launch_start, (epoch_us(launch_end) - epoch_us(launch_start)) / 1e6 AS launch_time,
    launch_end, disconnect,
    CASE WHEN lmi_connected IS NOT NULL AND launch_start IS NULL AND launch_end IS NULL
           AND (disconnect IS NULL OR disconnect < lmi_connected) THEN 'WAITING'
         WHEN welcome IS NOT NULL AND lmi_connected IS NULL AND launch_start IS NULL
           AND launch_end IS NULL AND (disconnect IS NULL OR disconnect < welcome) THEN 'PRECHECK'
         WHEN launch_start IS NOT NULL AND launch_end IS NULL THEN 'LAUNCHING' END AS state,
    coalesce(s.skills, '<null>*1') AS proctor_skills,
    epoch_us(a.tick) - epoch_us(lmi_connected) AS us
  FROM act a JOIN firsts f ON f.tick = a.tick AND f.id = a.id
  LEFT JOIN reservations r ON r.id = a.reservation_id
  LEFT JOIN iterations it ON it.id = r.iteration_id
  LEFT JOIN exams x ON x.id = it.exam_id
  LEFT JOIN institutions i ON i.id = x.institution_id
  LEFT JOIN proctor_levels l ON l.id = i.proctor_level_id
  LEFT JOIN skills s ON s.institution_id = i.id)
"""


_AT = "SELECT TIMESTAMP '2024-01-01 06:00:00' AS tick"
_SERIES = """SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01 12:00:00',
  INTERVAL 1 MINUTE)) AS tick"""
_METRICS = """tick AS t, proctor_level,
  count(*) FILTER (WHERE state = 'PRECHECK') AS precheck_count,
  count(*) FILTER (WHERE state = 'WAITING') AS waiting_count,
  count(*) FILTER (WHERE state = 'LAUNCHING') AS launching_count,
  max(us) FILTER (WHERE state = 'WAITING') / 1e6 AS max_wait,
  CAST(sum(us) FILTER (WHERE state = 'WAITING') AS DOUBLE)
    / count(us) FILTER (WHERE state = 'WAITING') / 1e6 AS avg_wait"""
_BUCKETS = ",\n  ".join(
    f"count(*) FILTER (WHERE state = 'WAITING' AND us <= {60 * j}000000"
    + (f" AND us > {60 * (j - 1)}000000" if j > 1 else "") + f") AS wait_{j}_min"
    for j in range(1, 16)
) + ",\n  count(*) FILTER (WHERE state = 'WAITING' AND us > 900000000) AS wait_gt_15_min"
_SNAPSHOT = f"SELECT {_METRICS},\n  {_BUCKETS} FROM progress GROUP BY tick, proctor_level"


def _census(start: str) -> str:
    return f"""{_walk('fx_events')},
seq AS (SELECT id, t, row_number() OVER (ORDER BY t, id) AS k FROM ev),
spans AS (
  SELECT state, {start} AS since, a.k AS lo, coalesce(b.k, 1000000000000) AS hi
  FROM visits JOIN seq a ON a.id = vid LEFT JOIN seq b ON b.id = eid),
census AS (
  SELECT t AS created_at, id, state, count(*) AS n, max(since) AS max_start
  FROM seq JOIN spans ON lo <= k AND hi > k GROUP BY t, id, state)
"""


_FWD = _walk("fx_events")
_COUNTS = """SELECT d.state, count(f_id) AS n FROM domain d LEFT JOIN current c ON c.state = d.state
GROUP BY d.state"""

ORACLE = {
    "clean_lifecycles": _after(f"{_FIXTURE}, {_COMPLETE}", "SELECT * FROM fx_events SEMI JOIN complete USING (fulfillment_id)"),
    "entity_counts": _after(f"{_FIXTURE}, {_COMPLETE}", """
SELECT (SELECT count(DISTINCT fulfillment_id) FROM fx_events) AS found,
  (SELECT count(*) FROM complete) AS complete"""),
    "distinct_entities": _plain("""
SELECT fulfillment_id, min(created_at) AS first_at, arg_min(id, (created_at, id)) AS first_id
FROM fx_events GROUP BY fulfillment_id"""),
    "scan_range": _plain(f"SELECT * FROM fx_events WHERE {_HALF_OPEN} ORDER BY created_at, id"),
    "scan_range_closed": _plain(f"SELECT * FROM fx_events WHERE {_CLOSED}"),
    "range_count": _plain(f"SELECT count(*) AS n FROM fx_events WHERE {_CLOSED}"),
    "until_cutoff": _plain(
        "SELECT * FROM fx_events WHERE created_at <= TIMESTAMP '2024-01-01 07:21:17.242125'"),
    "event_rows": _plain("""SELECT id, type, fulfillment_id AS f_id, created_at AS "time",
  created_by_id AS created_by FROM fx_events"""),
    "event_messages": _plain(f"""SELECT CAST(json_object('id', id, 'event_type', event_type, 'f_id', f_id,
  'event_time', event_time, 'created_by', created_by) AS VARCHAR) AS value FROM ({_MESSAGE})"""),
    "decoded_messages": _plain("""SELECT id, type, fulfillment_id,
  date_trunc('second', created_at) AS created_at, created_by_id FROM fx_events"""),
    "legacy_messages": _plain("SELECT type, fulfillment_id FROM fx_events"),
    "interval_batches": _plain(_slots(_HALF_OPEN, f"{_PASSED} // 1000000 AS slot", 1_000_000)),
    "interval_batches_closed": _plain(
        _slots(_CLOSED, f"""unnest(CASE WHEN {_PASSED} % 1000000 = 0 AND {_PASSED} > 0
    THEN [{_PASSED} // 1000000 - 1, {_PASSED} // 1000000] ELSE [{_PASSED} // 1000000] END) AS slot""",
               1_000_000) + " WHERE slot_end < TIMESTAMP '2024-01-01 08:00:00'"),
    "batch_sizes": _plain(f"""SELECT slot, slot_start, count(*) AS n FROM (
{_slots(_HALF_OPEN, f"{_PASSED} // 60000000 AS slot", 60_000_000)}) GROUP BY ALL"""),
    "fsm_states": _after(_FWD, """SELECT id, f AS fulfillment_id, type, t AS created_at,
  before AS state_before, after AS state_after FROM walk"""),
    "state_changes": _after(_changes(_TRACKED), "SELECT * FROM changes"),
    "state_changes_all_types": _after(_changes("fx_events"), "SELECT * FROM changes"),
    "state_changes_first_seen": _after(_changes("fx_events", anchor="first_seen"), "SELECT * FROM changes"),
    "state_changes_long": _after(_changes("fx_raw", _LAST_WINS), "SELECT * FROM changes"),
    "state_changes_wrapped": _after(_changes("fx_raw", _LAST_WINS, "first_seen", True), "SELECT * FROM changes"),
    "last_event_states": _after(_walk("fx_events", _LAST_WINS), """SELECT id, f AS fulfillment_id, type,
  t AS created_at, before AS state_before, after AS state_after FROM walk"""),
    "last_event_history": _after(_changes("fx_events", _LAST_WINS),
                                 "SELECT f_id, old_state AS state, time_in_state FROM changes"),
    "fulfillment_history": _after(_changes(_TRACKED),
                                  "SELECT f_id, old_state AS state, time_in_state FROM changes"),
    "state_intervals": _after(
        _FWD, "SELECT f AS f_id, state, vstart AS valid_from, vend AS valid_to FROM visits"),
    "time_per_state": _after(_changes(_TRACKED), """SELECT f_id, old_state AS state,
  CAST(sum(time_in_state) AS BIGINT) AS time_in_state FROM changes GROUP BY ALL"""),
    "active_milestones": _plain("""
SELECT fulfillment_id AS f_id,
  coalesce(arg_max(CASE type WHEN 'Event::Welcome' THEN 'welcome'
      WHEN 'Event::LmiConnected' THEN 'connected' WHEN 'Event::GetHelp' THEN 'help' ELSE 'launch_start' END,
    (created_at, id)) FILTER (WHERE type IN ('Event::Welcome', 'Event::LmiConnected', 'Event::GetHelp',
      'Event::LaunchStart')), 'new') AS milestone
FROM fx_events e WHERE NOT EXISTS (
  SELECT 1 FROM fx_events x WHERE x.fulfillment_id = e.fulfillment_id AND x.type = 'Event::LaunchEnd'
  AND (x.created_at, x.id) >= (e.created_at, e.id))
GROUP BY fulfillment_id"""),
    "current_state": _after(_FWD, "SELECT f_id, state, state_start_time FROM current"),
    "current_state_first_seen": _after(
        _FWD, "SELECT f_id, state, first_seen AS state_start_time FROM current"),
    "entity_lookup": _after(_FWD, "SELECT f_id, state, state_start_time FROM current WHERE f_id = 801"),
    "state_census": _after(
        _FWD, "SELECT state, max(state_start_time) AS max_start, count(*) AS n FROM current GROUP BY state"),
    "state_counts": _after(_FWD, _COUNTS),
    "state_counts_json": _after(_FWD, f"""
SELECT '{{' || string_agg('"' || state || '":' || n, ',' ORDER BY list_position(
  ['ENTERING', 'WAITING', 'LAUNCHING', 'TESTING', 'DONE', 'UNKNOWN'], state)) || '}}' AS counts
FROM ({_COUNTS})"""),
    "state_lists": _after(_FWD, """
SELECT state, f_id // 1000 AS page,
  string_agg(f_id || '|' || strftime(state_start_time, '%Y-%m-%d %H:%M:%S.%f'), ',' ORDER BY f_id) AS items
FROM current GROUP BY ALL
UNION ALL SELECT state, 0, '' FROM domain ANTI JOIN current USING (state)"""),
    "state_pairs": _after(_FWD, 'SELECT f_id AS label, state AS "value" FROM current'),
    "board_items": _after(_FWD, """
SELECT f_id, state, '#' || format('{:06X}', list_reduce(
    list_prepend(0::BIGINT, list_transform(string_split(CAST(f_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda h, c: (h * 31 + c) & 16777215)) AS colour,
  strftime(state_start_time - INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS started FROM current"""),
    "first_event_times": _plain("""
SELECT fulfillment_id, min(created_at) FILTER (WHERE type = 'Event::Welcome') AS welcome,
  min(created_at) FILTER (WHERE type = 'Event::LmiConnected') AS lmi_connected,
  min(created_at) FILTER (WHERE type = 'Event::LaunchStart') AS launch_start,
  min(created_at) FILTER (WHERE type = 'Event::LaunchEnd') AS launch_end,
  min(created_at) FILTER (WHERE type = 'Event::HardDisconnection') AS disconnect
FROM fx_events WHERE type IN ('Event::Welcome', 'Event::LmiConnected', 'Event::LaunchStart',
  'Event::LaunchEnd', 'Event::HardDisconnection') GROUP BY fulfillment_id"""),
    "service_types": _plain("""
SELECT taggable_id AS institution_id, max(name) AS service_type
FROM taggings LEFT JOIN tags ON tags.id = tag_id
WHERE context = 'service_types' AND taggable_type = 'Institution' GROUP BY taggable_id"""),
    "entity_skills": _after(_progress(_AT), "SELECT institution_id, skills FROM skills"),
    "in_progress": _after(_progress(_AT), "SELECT * EXCLUDE (tick, us) FROM progress"),
    "level_snapshot": _after(_progress(_AT), _SNAPSHOT),
    "metric_rows": _after(_progress(_AT), f"SELECT {_METRICS} FROM progress GROUP BY tick, proctor_level"),
    "wait_histogram": _after(_progress(_AT), """
SELECT proctor_level, CAST(greatest(1, least(16, ceil(us / 60000000))) AS INTEGER) AS bucket, count(*) AS n
FROM progress WHERE state = 'WAITING' GROUP BY ALL"""),
    "wait_summary": _after(_progress(_AT), """
SELECT tick AS "time", proctor_level AS csr_level,
  CAST(sum(us) AS DOUBLE) / count(us) / 1e6 / 60 AS avg_wait, max(us) / 1e6 / 60 AS max_wait,
  count(*) FILTER (WHERE us <= 300000000) AS zero_to_five,
  count(*) FILTER (WHERE us > 300000000 AND us <= 600000000) AS five_to_ten,
  count(*) FILTER (WHERE us > 600000000 AND us <= 900000000) AS ten_to_fifteen,
  count(*) FILTER (WHERE us > 900000000 AND us <= 1200000000) AS fifteen_to_twenty,
  count(*) FILTER (WHERE us > 1200000000 AND us <= 1500000000) AS twenty_to_twenty_five,
  count(*) AS wait_count
FROM progress GROUP BY tick, proctor_level"""),
    "snapshot_series": _after(_progress(_SERIES), _SNAPSHOT),
    "running_counts": _after(_census("vstart"), """
SELECT created_at, id, """ + ", ".join(
        f"CAST(coalesce(sum(n) FILTER (WHERE state = '{s}'), 0) AS BIGINT) AS {s.lower()}"
        for s in ("ENTERING", "WAITING", "LAUNCHING", "TESTING", "DONE", "UNKNOWN"))
        + " FROM census GROUP BY created_at, id"),
    "running_census": _after(_census("vstart"), "SELECT * FROM census"),
    "running_census_first_seen": _after(_census("first_seen"), "SELECT * FROM census"),
    "peak_waiting": _after(_census("vstart"), """
SELECT max_start, n FROM (
  SELECT max_start, arg_max(n, (created_at, id)) AS n FROM census WHERE state = 'WAITING' GROUP BY max_start)
QUALIFY n = max(n) OVER ()"""),
    "stream_current_state": _after(
        _walk("fx_events", _LAST_WINS), "SELECT f_id, state, state_start_time FROM current"),
    "stream_raw_events": _plain("SELECT * FROM fx_events"),
}
ORACLE["entity_skill_names"] = _after(_FIXTURE, """
SELECT taggable_id AS institution_id, string_agg(coalesce(name, '<null>'), ',' ORDER BY name NULLS FIRST) AS skills
FROM taggings LEFT JOIN tags ON tags.id = tag_id
WHERE context = 'skills' AND taggable_type = 'Institution' GROUP BY taggable_id""")
ORACLE["custom_table_states"] = _plain("""
SELECT id, fulfillment_id, type, created_at,
  lag(state) OVER (PARTITION BY fulfillment_id ORDER BY created_at, id) AS state_before, state AS state_after
FROM (SELECT *, coalesce(last_value(type IGNORE NULLS) OVER (PARTITION BY fulfillment_id ORDER BY created_at, id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'UNKNOWN') AS state FROM fx_events)""")
ORACLE["stream_current_compacted"] = _after(_walk("fx_events", _LAST_WINS), """
SELECT f_id, state, as_of_time, as_of_id FROM current JOIN (
  SELECT f AS f_id, max(t) AS as_of_time, arg_max(id, (t, id)) AS as_of_id FROM ev GROUP BY f) USING (f_id)""")
ORACLE["stream_metric_series"] = _after(_progress("""SELECT unnest(generate_series(
  TIMESTAMP '2024-01-01 04:00:00', TIMESTAMP '2024-01-01 12:00:00', INTERVAL 4 HOUR)) AS tick"""),
    f"SELECT {_METRICS} FROM progress GROUP BY tick, proctor_level")
_SPOILED = """
SELECT id % 50 AS k, id, type, fulfillment_id, created_at, created_by_id,
  concat_ws(',', CASE WHEN id % 50 = 0 THEN 'x' ELSE '' END || id, type, fulfillment_id,
    CASE WHEN id % 50 = 1 THEN 'yesterday' ELSE strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') END,
    CASE WHEN id % 50 <> 2 THEN created_by_id END) AS record FROM fx_events"""
ORACLE["csv_good_rows"] = _plain("SELECT id, type, fulfillment_id, created_at, created_by_id FROM fx_events WHERE id % 50 > 2")
ORACLE["csv_rejected_rows"] = _plain(f"""
SELECT record, CASE k WHEN 0 THEN 'id' WHEN 1 THEN 'created_at' ELSE 'record' END AS reason FROM ({_SPOILED}) WHERE k <= 2""")
ORACLE["stream_from_messages"] = _after(_walk("fx_whole").replace("WITH RECURSIVE", "").replace(
    "fulfillments AS (", "fx_whole AS (SELECT id, type, fulfillment_id, date_trunc('second', created_at) AS created_at "
    "FROM fx_events),\nfulfillments AS ("), "SELECT f_id, state, state_start_time FROM current")
ORACLE["rejected_events"] = _plain("""
SELECT *, CASE WHEN id IS NULL THEN 'id' WHEN fulfillment_id IS NULL THEN 'entity' ELSE 'time' END AS missing
FROM (SELECT CASE WHEN id % 13 <> 0 THEN id END AS id, type,
    CASE WHEN id % 11 <> 0 THEN fulfillment_id END AS fulfillment_id,
    CASE WHEN id % 7 <> 0 THEN created_at END AS created_at FROM fx_events)
WHERE id IS NULL OR fulfillment_id IS NULL OR created_at IS NULL""")
ORACLE["stream_board_lists"] = ORACLE["state_lists"].replace("// 1000 AS", "// 10000 AS")
ORACLE["stream_metric_rows"] = ORACLE["metric_rows"]
ORACLE["clean_csv_round_trip"] = ORACLE["clean_lifecycles"]
ORACLE["stream_state_changes"] = ORACLE["state_changes_all_types"]
ORACLE["stream_board_counts"] = ORACLE["state_counts"]
ORACLE["stream_current_cold"] = ORACLE["current_state"]
ORACLE["stream_entity_lookup"] = ORACLE["entity_lookup"]
ORACLE["stream_repeated_events"] = ORACLE["state_changes_all_types"]
ORACLE["stream_entity_estimate"] = _plain("SELECT count(DISTINCT fulfillment_id) AS found, true AS close FROM fx_events")
ORACLE["loaded_snapshot"] = ORACLE["level_snapshot"]
