"""Entities still under way, with the latest milestone each has reached."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Milestone labels of the four progress types, and the type that ends tracking.
MILESTONES = {
    "Event::Welcome": "welcome",
    "Event::LMIConnected": "connected",
    "Event::LaunchStart": "launch_start",
    "Event::LaunchExamClicked": "launch_exam",
}
TERMINAL = "Event::LaunchEnd"
NEW = "new"


def active_milestones(events: DataFrame, milestones: dict[str, str] = MILESTONES,
                      terminal: str = TERMINAL) -> DataFrame:
    """``(f_id, milestone)`` of entities with an event after their last terminal one.

    Three maxima per entity, combined before the shuffle.
    """
    at = F.struct("created_at", "id")
    label = None
    for kind, name in milestones.items():
        test = F.col("type") == kind
        label = F.when(test, name) if label is None else label.when(test, name)
    reached = F.struct("created_at", "id", label.alias("milestone"))
    per_entity = events.filter(F.col("fulfillment_id").isNotNull()).groupBy("fulfillment_id").agg(
        F.max(at).alias("seen"),
        F.max(F.when(F.col("type") == terminal, at)).alias("ended"),
        F.max(F.when(F.col("type").isin(list(milestones)), reached)).alias("reached"))
    since = F.struct(F.col("reached.created_at").alias("created_at"), F.col("reached.id").alias("id"))
    running = F.col("ended").isNull() | (F.col("seen") > F.col("ended"))
    counts = F.col("reached").isNotNull() & (F.col("ended").isNull() | (since > F.col("ended")))
    return per_entity.filter(running).select(
        F.col("fulfillment_id").alias("f_id"),
        F.when(counts, F.col("reached.milestone")).otherwise(NEW).alias("milestone"))
