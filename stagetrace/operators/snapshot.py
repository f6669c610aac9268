"""Metrics of entities in progress at a point in time, and over a grid of points."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrace import model as m
from stagetrace.functions.scalar import (
    MICROS,
    ceil_div,
    micros,
    micros_between,
    ntz,
    seconds_between,
    to_minutes,
    wait_bucket,
)
from stagetrace.plans.dyadic import above, cover
from stagetrace.plans.skew import broadcast_if_small, skewed_join
from stagetrace.session import settle

# First-event column -> event type, lookback, histogram shape, sink columns.
FIRST_EVENTS = {
    "welcome": m.WELCOME,
    "lmi_connected": m.LMI_CONNECTED,
    "launch_start": m.LAUNCH_START,
    "launch_end": m.LAUNCH_END,
    "disconnect": m.HARD_DISCONNECTION,
}
LOOKBACK = timedelta(hours=3)
WAIT_WIDTH, WAIT_BUCKETS = timedelta(minutes=1), 15
SUMMARY_WIDTH, SUMMARY_BUCKETS = timedelta(minutes=5), 5
SUMMARY_NAMES = ["zero_to_five", "five_to_ten", "ten_to_fifteen", "fifteen_to_twenty",
                 "twenty_to_twenty_five"]
SNAPSHOT_STATES = ["PRECHECK", "WAITING", "LAUNCHING"]
METRIC_COLUMNS = ["t", "proctor_level", "precheck_count", "waiting_count", "launching_count",
                  "max_wait", "avg_wait"]


def first_event_times(events: DataFrame, types: dict[str, str] = FIRST_EVENTS) -> DataFrame:
    """First time of each event type per entity: one scan, one shuffle, combined before it."""
    firsts = [F.min(F.when(F.col("type") == t, F.col("created_at"))).alias(c) for c, t in types.items()]
    wanted = events.filter(F.col("type").isin(list(types.values())))
    return wanted.groupBy("fulfillment_id").agg(*firsts)


def _tag_counts(tables: dict[str, DataFrame], context: str) -> DataFrame:
    """How often each tag name is attached to each institution in a context; names may be NULL."""
    chosen = tables["taggings"].filter(
        (F.col("context") == context) & (F.col("taggable_type") == "Institution"))
    # Counted before the tags are joined, so a tag used everywhere is no hot join key.
    counted = chosen.groupBy("taggable_id", "tag_id").agg(F.count("*").alias("n"))
    tags = tables["tags"].select(F.col("id").alias("tag_id"), "name")
    named = counted.join(tags, "tag_id", "left")
    return named.groupBy(F.col("taggable_id").alias("institution_id"), "name").agg(
        F.sum("n").alias("n"))


def service_types(tables: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """Service type per institution. With several the largest name, or an error if ``strict``."""
    per = _tag_counts(tables, "service_types").groupBy("institution_id").agg(
        F.max("name").alias("service_type"), F.sum("n").alias("n"))
    if strict:
        message = F.concat(F.lit("more than one service type for institution "), "institution_id")
        checked = F.when(F.col("n") > 1, F.raise_error(message).cast("string"))
        per = per.withColumn("service_type", checked.otherwise(F.col("service_type")))
    return per.select("institution_id", "service_type")


def entity_skills(tables: dict[str, DataFrame]) -> DataFrame:
    """Skill tags per institution as sorted ``array<struct<name, n>>``.

    The counted form holds every tag, repeats and NULL names included, in a size bounded by the
    number of different names; ``expand_skills`` writes it out.
    """
    return _tag_counts(tables, "skills").groupBy("institution_id").agg(
        F.sort_array(F.collect_list(F.struct("name", "n"))).alias("skills"))


def expand_skills(skills) -> Column:
    """Counted tags as a plain array with every repeat."""
    each = F.transform(skills, lambda s: F.array_repeat(s["name"], s["n"].cast("int")))
    return F.flatten(each)


def no_skills() -> Column:
    """What an entity without skill tags shows: a single NULL name."""
    return F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(1).cast("long").alias("n")))


def snapshot_state() -> Column:
    """State at the snapshot from the first-event times known by then."""
    connected, started, ended = F.col("lmi_connected"), F.col("launch_start"), F.col("launch_end")
    welcome, lost = F.col("welcome"), F.col("disconnect")

    def kept(since):
        return lost.isNull() | (lost < since)

    not_launched = started.isNull() & ended.isNull()
    return (
        F.when(connected.isNotNull() & not_launched & kept(connected), "WAITING")
        .when(welcome.isNotNull() & connected.isNull() & not_launched & kept(welcome), "PRECHECK")
        .when(started.isNotNull() & ended.isNull(), "LAUNCHING"))


def _matching(right: DataFrame, key: str, left: DataFrame, left_key: str, small: bool) -> DataFrame:
    """Rows of ``right`` that ``left`` can meet, found without a shuffle when ``left`` is small."""
    if not small:
        return right
    keys = F.broadcast(left.select(F.col(left_key).alias(key)).distinct())
    # keys are unique as a rule, not by force: the count decides
    return broadcast_if_small(right.join(keys, key, "left_semi"), derived=True)[0]


def _with_dimensions(df: DataFrame, tables: dict[str, DataFrame], small: bool) -> DataFrame:
    """Left joins along reservation, iteration, exam, institution and level; all keys unique."""
    reservations = tables["reservations"].select(
        F.col("id").alias("reservation_id"), F.col("iteration_id").alias("_iteration"))
    iterations = tables["iterations"].select(
        F.col("id").alias("iteration_id"), F.col("type").alias("iteration_type"),
        F.col("exam_id").alias("_exam"))
    exams = tables["exams"].select(
        F.col("id").alias("_exam"), F.col("institution_id").alias("_institution"))
    institutions = tables["institutions"].select(
        F.col("id").alias("institution_id"), F.col("proctor_level_id").alias("_level"))
    levels = tables["proctor_levels"].select(
        F.col("id").alias("_level"), F.col("name").alias("proctor_level"))
    placed = df.join(
        _matching(reservations, "reservation_id", df, "reservation_id", small),
        "reservation_id", "left")
    placed = placed.join(
        _matching(iterations, "iteration_id", placed, "_iteration", small),
        F.col("_iteration") == F.col("iteration_id"), "left")
    placed = _few_keys(placed, exams, "_exam").withColumnRenamed("_institution", "_at")
    placed = _few_keys(placed, institutions.withColumn("_at", F.col("institution_id")), "_at")
    return _few_keys(placed, levels, "_level").drop("_iteration", "_exam", "_at", "_level")


def _few_keys(df: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to unique keys of which a few may hold most rows: by broadcast if a count allows it, else with these split off."""
    few, small = broadcast_if_small(right)
    return df.join(few, key, "left") if small else skewed_join(df, right, key, "left")


def active_fulfillments(fulfillments: DataFrame, as_of: datetime,
                        lookback: timedelta = LOOKBACK) -> DataFrame:
    """Started within the lookback and not ended, as known at ``as_of``."""
    started, ended, now = F.col("actual_started_at"), F.col("actual_ended_at"), ntz(as_of)
    return fulfillments.filter(
        (started > ntz(as_of - lookback)) & (started <= now) & (ended.isNull() | (ended > now)))


def in_progress(tables: dict[str, DataFrame], as_of: datetime,
                lookback: timedelta = LOOKBACK) -> DataFrame:
    """Entities in progress with their milestones, durations in seconds, state and skills.

    ``proctor_skills`` is in counted form (see ``entity_skills``). Events after ``as_of`` are
    hidden. The few active entities lead: when a count shows they are few, events and the large
    dimensions are first cut down to them by broadcast, so nothing large is shuffled.
    """
    active = settle(active_fulfillments(tables["fulfillments"], as_of, lookback))
    ids, small = broadcast_if_small(active.select(F.col("id").alias("fulfillment_id")))
    events = tables["events"].filter(F.col("created_at") <= ntz(as_of))
    if small:
        events = events.join(ids, "fulfillment_id", "left_semi")
    times = first_event_times(events).withColumnRenamed("fulfillment_id", "id")
    rows = _with_dimensions(active, tables, small).join(times, "id", "left")
    rows = rows.join(service_types(tables), "institution_id", "left")
    rows = rows.join(entity_skills(tables), "institution_id", "left")
    now = ntz(as_of)
    return rows.select(
        F.col("id").alias("f_id"), F.col("uuid").alias("f_uuid"), "iteration_id", "institution_id",
        "iteration_type", "proctor_level", "service_type", "welcome",
        seconds_between("welcome", "lmi_connected").alias("precheck_time"),
        "lmi_connected",
        seconds_between("lmi_connected", "launch_start").alias("wait_time"),
        seconds_between("lmi_connected", now).alias("current_wait"),
        "launch_start",
        seconds_between("launch_start", "launch_end").alias("launch_time"),
        "launch_end", "disconnect", snapshot_state().alias("state"),
        F.coalesce("skills", no_skills()).alias("proctor_skills"))


def _waiting(column: Column) -> Column:
    return F.when(F.col("state") == "WAITING", column)


def bucket_names(n: int = WAIT_BUCKETS) -> list[str]:
    return [f"wait_{j}_min" for j in range(1, n + 1)] + [f"wait_gt_{n}_min"]


def level_snapshot(progress: DataFrame, as_of: datetime) -> DataFrame:
    """One row per level: counts per state, longest and mean wait, wait histogram."""
    wait = _waiting(micros_between("lmi_connected", ntz(as_of)))
    bucket = wait_bucket(wait, WAIT_WIDTH, WAIT_BUCKETS)
    counts = [
        F.count(F.when(F.col("state") == s, True)).alias(f"{s.lower()}_count") for s in SNAPSHOT_STATES]
    spread = [
        F.count(F.when(bucket == j, True)).alias(name) for j, name in enumerate(bucket_names(), 1)]
    return (
        progress.groupBy("proctor_level")
        .agg(*counts, F.max(wait).alias("_max"), F.sum(wait).alias("_sum"), *spread)
        .select(
            ntz(as_of).alias("t"), "proctor_level", *[f"{s.lower()}_count" for s in SNAPSHOT_STATES],
            *_wait_seconds(), *bucket_names()))


def _wait_seconds() -> list[Column]:
    # Whole microseconds are summed and divided last, so the order of rows cannot change the mean.
    return [
        (F.col("_max") / F.lit(float(MICROS))).alias("max_wait"),
        F.when(F.col("waiting_count") > 0, F.col("_sum") / F.col("waiting_count") / F.lit(float(MICROS)))
        .alias("avg_wait")]


def wait_histogram(progress: DataFrame, as_of: datetime, width: timedelta = WAIT_WIDTH,
                   n: int = WAIT_BUCKETS) -> DataFrame:
    """Waiting entities per level and bucket, long form; ``bucket`` ``n + 1`` is the overflow."""
    wait = micros_between("lmi_connected", ntz(as_of))
    return (
        progress.filter(F.col("state") == "WAITING")
        .groupBy("proctor_level", wait_bucket(wait, width, n).alias("bucket"))
        .agg(F.count("*").alias("n")))


def wait_summary(progress: DataFrame, as_of: datetime) -> DataFrame:
    """Per level: mean and longest wait in minutes, five-minute buckets, number of rows.

    Counts all rows given, waiting or not, as far as they have a wait.
    """
    wait = micros_between("lmi_connected", ntz(as_of))
    bucket = wait_bucket(wait, SUMMARY_WIDTH, SUMMARY_BUCKETS)
    spread = [F.count(F.when(bucket == j, True)).alias(c) for j, c in enumerate(SUMMARY_NAMES, 1)]
    return (
        progress.groupBy(F.col("proctor_level").alias("csr_level"))
        .agg(F.sum(wait).alias("_sum"), F.count(wait).alias("_n"), F.max(wait).alias("_max"),
             *spread, F.count("*").alias("wait_count"))
        .select(
            ntz(as_of).alias("time"), "csr_level",
            F.when(F.col("_n") > 0, to_minutes(F.col("_sum") / F.col("_n") / F.lit(float(MICROS))))
            .alias("avg_wait"),
            to_minutes(F.col("_max") / F.lit(float(MICROS))).alias("max_wait"),
            *SUMMARY_NAMES, "wait_count"))


def metric_rows(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(*METRIC_COLUMNS)


_NEVER = 2 ** 60
_SERIES_COUNTS = ["present", "precheck", "launching", "waiting", *bucket_names()]
_WAITING_METRIC = _SERIES_COUNTS.index("waiting")


def _spells(rows: DataFrame, start: datetime, end: datetime, step: timedelta,
            lookback: timedelta) -> DataFrame:
    """Per entity the stretches of ticks in which it counts for a metric.

    While an entity is in progress each of its snapshot states holds over one stretch: it begins
    with the event that brings the state and ends with the first event that rules it out. Inside
    the waiting stretch the wait runs through the buckets one after another. ``metric`` is the
    place in ``_SERIES_COUNTS``, ``lo`` and ``hi`` are tick numbers.
    """
    passed = {
        c: F.coalesce(micros_between(ntz(start), c), F.lit(_NEVER))
        for c in ["actual_started_at", "actual_ended_at", *FIRST_EVENTS]}
    clock = rows.select("proctor_level", *[v.alias(c) for c, v in passed.items()])
    began, welcome, connected = (F.col(c) for c in ("actual_started_at", "welcome", "lmi_connected"))
    launch, done, lost = (F.col(c) for c in ("launch_start", "launch_end", "disconnect"))
    leaves = F.least(began + F.lit(micros(lookback)), F.col("actual_ended_at"))
    loss = lambda since: F.when(lost >= since, lost).otherwise(F.lit(_NEVER))
    states = clock.select(
        "proctor_level", began.alias("began"), leaves.alias("leaves"), connected.alias("since"),
        F.greatest(began, welcome).alias("pre_lo"),
        F.least(leaves, connected, launch, done, loss(welcome)).alias("pre_hi"),
        F.greatest(began, launch).alias("run_lo"), F.least(leaves, done).alias("run_hi"),
        F.greatest(began, connected).alias("wait_lo"),
        F.least(leaves, launch, done, loss(connected)).alias("wait_hi"))
    waits = F.col("wait_lo") < F.col("wait_hi")
    last = F.when(waits, len(_SERIES_COUNTS) - 1).otherwise(_WAITING_METRIC - 1)
    each = states.withColumn("metric", F.explode(F.sequence(F.lit(0), last)))
    metric, bucket = F.col("metric"), F.col("metric") - _WAITING_METRIC
    width = F.lit(micros(WAIT_WIDTH))
    upto = F.col("since") + width * bucket + 1
    lo = (F.when(metric == 0, F.col("began")).when(metric == 1, F.col("pre_lo"))
          .when(metric == 2, F.col("run_lo")).when(bucket <= 1, F.col("wait_lo"))
          .otherwise(F.greatest(F.col("wait_lo"), upto - width)))
    hi = (F.when(metric == 0, F.col("leaves")).when(metric == 1, F.col("pre_hi"))
          .when(metric == 2, F.col("run_hi"))
          .when((bucket == 0) | (bucket > WAIT_BUCKETS), F.col("wait_hi"))
          .otherwise(F.least(F.col("wait_hi"), upto)))
    ticks = F.lit((end - start) // step + 1).cast("long")
    tick = lambda c: F.greatest(
        F.lit(0).cast("long"), F.least(ticks, ceil_div(c, micros(step))))
    return each.select(
        "proctor_level", "metric", F.when(metric == _WAITING_METRIC, F.col("since")).alias("since"),
        tick(lo).alias("lo"), tick(hi).alias("hi"))


def snapshot_series(tables: dict[str, DataFrame], start: datetime, end: datetime,
                    step: timedelta = timedelta(seconds=5),
                    lookback: timedelta = LOOKBACK) -> DataFrame:
    """``level_snapshot`` at ``start, start + step, ...`` up to ``end``, all in one pass.

    An entity gives a few blocks of ticks per metric, not one row per tick; blocks are combined
    before their shuffle, so what is shuffled depends on ticks and levels, not on entities.
    """
    n = (end - start) // step + 1
    started, ended = F.col("actual_started_at"), F.col("actual_ended_at")
    seen = settle(tables["fulfillments"].filter(
        (started <= ntz(end)) & (started > ntz(start - lookback))
        & (ended.isNull() | (ended > ntz(start)))))
    events = tables["events"].filter(F.col("created_at") <= ntz(end))
    ids, small = broadcast_if_small(seen.select(F.col("id").alias("fulfillment_id")))
    if small:
        events = events.join(ids, "fulfillment_id", "left_semi")
    times = first_event_times(events).withColumnRenamed("fulfillment_id", "id")
    rows = _with_dimensions(seen, tables, small).join(times, "id", "left")
    blocks = cover(_spells(rows, start, end, step, lookback), "lo", "hi").groupBy(
        "proctor_level", "blk_size", "blk", "metric").agg(
        F.count("*").alias("n"), F.sum("since").alias("since_sum"), F.min("since").alias("since_min"))
    names = _SERIES_COUNTS
    blocks = blocks.groupBy("proctor_level", "blk_size", "blk").agg(
        *[F.sum(F.when(F.col("metric") == i, F.col("n"))).alias(c) for i, c in enumerate(names)],
        F.sum("since_sum").alias("since_sum"), F.min("since_min").alias("since_min"))
    blocks, _ = broadcast_if_small(blocks, derived=True)
    ticks = above(tables["events"].sparkSession.range(n).withColumnRenamed("id", "tick"), "tick", n)
    at = F.col("tick") * F.lit(micros(step))
    counts = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]
    return (
        ticks.join(blocks, ["blk_size", "blk"])
        .groupBy("tick", "proctor_level")
        .agg(*counts, F.sum("since_sum").alias("since_sum"), F.min("since_min").alias("since_min"))
        .filter("present > 0")
        .withColumns({f"{s.lower()}_count": F.col(s.lower()) for s in SNAPSHOT_STATES})
        .withColumn("_max", at - F.col("since_min"))
        .withColumn("_sum", at * F.col("waiting_count") - F.col("since_sum"))
        .select(
            F.timestamp_add("MICROSECOND", at, ntz(start)).alias("t"), "proctor_level",
            *[f"{s.lower()}_count" for s in SNAPSHOT_STATES], *_wait_seconds(), *bucket_names()))
