"""Aggregates and board views over the current state of all entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrace.functions.scalar import colour_key, counts_json, floor_div, local_time
from stagetrace.model import STATES
from stagetrace.session import settle

PAGE_IDS = 10_000


def latest(changes: DataFrame) -> DataFrame:
    """Current row per entity from rows that each claim one as of ``(as_of_time, as_of_id)``."""
    row = F.max_by(F.struct(*[c for c in changes.columns if c != "f_id"]), F.struct("as_of_time", "as_of_id"))
    return changes.groupBy("f_id").agg(row.alias("r")).select("f_id", "r.*")


def entity_row(current: DataFrame, f_id: int) -> DataFrame:
    """The row of one entity."""
    return current.filter(F.col("f_id") == F.lit(f_id)).limit(1)


def state_census(current: DataFrame) -> DataFrame:
    """Per state that occurs: latest start and number of entities."""
    return current.groupBy("state").agg(
        F.max("state_start_time").alias("max_start"), F.count("*").alias("n"))


def _counts(current: DataFrame, states) -> DataFrame:
    counts = [F.count(F.when(F.col("state") == s, True)).alias(f"n{i}") for i, s in enumerate(states)]
    pairs = [F.struct(F.lit(s).alias("state"), F.col(f"n{i}").alias("n")) for i, s in enumerate(states)]
    return current.agg(*counts).select(F.array(*pairs).alias("counts"))


def state_counts(current: DataFrame, states=STATES) -> DataFrame:
    """Number of entities for every state of the domain, 0 included."""
    return _counts(current, states).select(F.inline("counts"))


def state_counts_json(current: DataFrame, states=STATES) -> DataFrame:
    return _counts(current, states).select(counts_json("counts").alias("counts"))


def state_lists(current: DataFrame, states=STATES, page_ids: int = PAGE_IDS) -> DataFrame:
    """Items per state as ordered pages ``(state, page, items)``.

    A page spans ``page_ids`` consecutive entity ids, so no list grows with the data; pages in
    order make up the whole list. A state without entities has one empty page.
    """
    current = settle(current)  # the states without entities are asked for as well
    item = F.struct("f_id", "state_start_time")
    filled = (
        current.groupBy("state", floor_div("f_id", page_ids).alias("page"))
        .agg(F.sort_array(F.collect_list(item)).alias("items")))
    none = F.array().cast(filled.schema["items"].dataType)
    empty = state_counts(current, states).filter("n = 0").select(
        "state", F.lit(0).cast("long").alias("page"), none.alias("items"))
    return filled.unionByName(empty)


def state_pairs(current: DataFrame) -> DataFrame:
    """``(label, value)`` series: entity id and its state."""
    return current.select(F.col("f_id").alias("label"), F.col("state").alias("value"))


def board_items(current: DataFrame, zone: str = "UTC") -> DataFrame:
    """What a board shows per entity: colour key and local start time."""
    return current.select(
        "f_id", "state", colour_key("f_id").alias("colour"),
        local_time("state_start_time", zone).alias("started"))
