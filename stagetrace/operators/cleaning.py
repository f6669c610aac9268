"""Filters on raw events and the choice of entities with a complete lifecycle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrace.functions.scalar import encode_message, format_seconds, ntz
from stagetrace.model import TRACKED_TYPES
from stagetrace.plans.skew import HOT_ROWS, broadcast_if_small, skewed_join

KEY = "fulfillment_id"


def of_types(df: DataFrame, types=TRACKED_TYPES) -> DataFrame:
    return df.filter(F.col("type").isin(list(types)))


def usable(on_bad: str = "reject") -> Column:
    """Whether an event can be placed: it has an id, an entity and a time.

    ``on_bad="error"`` raises at the first one that can't.
    """
    good = F.col("id").isNotNull() & F.col(KEY).isNotNull() & F.col("created_at").isNotNull()
    if on_bad == "reject":
        return good
    if on_bad == "error":
        what = F.to_json(F.struct("id", KEY, F.col("created_at").cast("string").alias("created_at")))
        return F.when(good, True).otherwise(
            F.raise_error(F.concat(F.lit("event without id, entity or time: "), what)).cast("boolean"))
    raise ValueError(f"on_bad must be 'reject' or 'error', not {on_bad!r}")


def rejected_events(events: DataFrame) -> DataFrame:
    """Events that no state can come from, with the reason: the first of id, entity, time that is missing."""
    reason = (F.when(F.col("id").isNull(), "id").when(F.col(KEY).isNull(), "entity")
              .when(F.col("created_at").isNull(), "time"))
    return events.withColumn("missing", reason).filter(F.col("missing").isNotNull())


def in_range(df: DataFrame, start: datetime, end: datetime, boundary: str = "half_open") -> DataFrame:
    """Events from ``start`` on, before ``end``; ``closed`` takes those at ``end`` as well."""
    t = F.col("created_at")
    if boundary == "closed":
        return df.filter(t.between(ntz(start), ntz(end)))
    if boundary == "half_open":
        return df.filter((t >= ntz(start)) & (t < ntz(end)))
    raise ValueError(f"boundary must be 'half_open' or 'closed', not {boundary!r}")


def until(df: DataFrame, cutoff: datetime) -> DataFrame:
    """Events up to the cutoff; the first later one and all after it are left out."""
    return df.filter(F.col("created_at") <= ntz(cutoff))


def scan_events(df: DataFrame, start: datetime, end: datetime, types=TRACKED_TYPES,
                boundary: str = "half_open", ordered: bool = False) -> DataFrame:
    """Events of a time range and of the given types; ``ordered`` sorts by ``(created_at, id)``."""
    out = of_types(in_range(df, start, end, boundary), types)
    return in_time_order(out) if ordered else out


def in_time_order(df: DataFrame) -> DataFrame:
    return df.orderBy("created_at", "id")


def range_count(df: DataFrame, start: datetime, end: datetime, boundary: str = "closed") -> DataFrame:
    return scan_events(df, start, end, boundary=boundary).agg(F.count("*").alias("n"))


def _is_complete(required) -> Column:
    """Aggregate: the entity saw every required type and nothing else, NULL types included."""
    kind = F.col("type")
    seen_all = [F.max(F.when(kind == t, True)).isNotNull() for t in required]
    foreign = F.max(F.when(kind.isNull() | ~kind.isin(list(required)), True)).isNull()
    out = foreign
    for test in seen_all:
        out = out & test
    return out


def _per_entity(df: DataFrame, required) -> DataFrame:
    # A few flags per entity, combined before the shuffle; no set of types is collected.
    return df.groupBy(KEY).agg(_is_complete(required).alias("complete"))


def complete_lifecycles(df: DataFrame, required=TRACKED_TYPES,
                        hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All events of entities whose event types are exactly the required ones.

    Events are read twice: for the entities, and for their join, by broadcast when a count shows that few are complete.
    Else hot entities are found by one more pass over the key and split off.
    """
    keep, small = broadcast_if_small(_per_entity(df, required).filter("complete").select(KEY), derived=True)
    if small:
        return df.join(keep, KEY, "left_semi").select(*df.columns)
    return skewed_join(df, keep, KEY, "left_semi", hot_rows)


def entity_counts(df: DataFrame, required=TRACKED_TYPES) -> DataFrame:
    """Entities found, and entities left after cleaning. A NULL id counts as found, never as left."""
    return _per_entity(df, required).agg(
        F.count("*").alias("found"),
        F.count(F.when(F.col("complete") & F.col(KEY).isNotNull(), True)).alias("complete"))


def approx_entities(df: DataFrame, rsd: float = 0.01) -> DataFrame:
    """Approximate number of entities, for inputs where the exact one is not needed."""
    return df.agg(F.approx_count_distinct(KEY, rsd).alias("found"))


def entity_sketches(df: DataFrame, by: list[str], precision: int = 12) -> DataFrame:
    """Per ``by`` a mergeable sketch of the entities seen: ``(by, sketch)``, of a size that ``precision`` sets whatever is counted.

    Sketches of batches or days can be stored and merged later in any order; see ``merged_entities``.
    """
    return df.filter(F.col(KEY).isNotNull()).groupBy(*by).agg(F.hll_sketch_agg(F.col(KEY).cast("long"), precision).alias("sketch"))


def merged_entities(sketches: DataFrame) -> DataFrame:
    """``found``: the approximate number of different entities in all ``sketches``; relative error about 0.8 / sqrt(2 ** precision)."""
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("found"))


def distinct_entities(df: DataFrame) -> DataFrame:
    """Each entity once, with its first event; sort by ``first_at, first_id`` for order of appearance."""
    first = F.min(F.struct("created_at", "id"))
    return df.groupBy(KEY).agg(first.alias("f")).select(
        KEY, F.col("f.created_at").alias("first_at"), F.col("f.id").alias("first_id"))


def event_rows(df: DataFrame) -> DataFrame:
    """Events in the shape of the tracked ``events`` table of the batch replay."""
    return df.select(
        "id", "type", F.col(KEY).alias("f_id"), F.col("created_at").alias("time"),
        F.col("created_by_id").alias("created_by"))


def message_rows(df: DataFrame) -> DataFrame:
    """Events in message shape; times are cut to whole seconds as messages carry them."""
    return df.select(
        "id", F.col("type").alias("event_type"), F.col(KEY).alias("f_id"),
        format_seconds("created_at").alias("event_time"),
        F.col("created_by_id").alias("created_by"))


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON text per event in ``value``, ready for a message sink."""
    rows = message_rows(df)
    return rows.select(encode_message(rows.columns).alias("value"))
