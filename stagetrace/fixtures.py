"""The tracked tables as views over the supplied star-schema tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrace import model as m
from stagetrace.functions.scalar import floor_div, micros_between, ntz

# Fixed values of the mapping: clock origin, compression, and source type -> tracked type.
ORIGIN = datetime(2024, 1, 1)
COMPRESSION = 60
VIEW_SPLIT = 150
ERROR_SPLIT = 10


# The columns used of each supplied table.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_size int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _event_type() -> Column:
    kind, value = F.col("event_type"), F.col("value")
    return (
        F.when(kind == "signup", m.WELCOME)
        .when((kind == "view") & (value <= VIEW_SPLIT), m.LMI_CONNECTED)
        .when((kind == "view") & (value > VIEW_SPLIT), m.GET_HELP)
        .when(kind == "click", m.LAUNCH_START)
        .when(kind == "purchase", m.LAUNCH_END)
        .when((kind == "error") & (value >= ERROR_SPLIT), m.FULFILLMENT_ENDED)
        .when((kind == "error") & (value < ERROR_SPLIT), m.HARD_DISCONNECTION)
    )


def source_time(at: datetime) -> datetime:
    """Source clock value from which the compressed clock shows ``at`` or later."""
    return ORIGIN + (at - ORIGIN) * COMPRESSION


def map_events(source: DataFrame) -> DataFrame:
    """Tracked events from the source columns; row by row, so it also works on a stream."""
    passed = floor_div(micros_between(ntz(ORIGIN), "ts"), COMPRESSION)
    return source.select(
        F.col("event_id").alias("id"),
        _event_type().alias("type"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("fulfillment_id"),
        F.timestamp_add("MICROSECOND", passed, ntz(ORIGIN)).alias("created_at"),
        F.col("user_id").cast("string").alias("created_by_id"),
    )


def events(spark: SparkSession, sf_dir: str, start: datetime | None = None,
           end: datetime | None = None) -> DataFrame:
    """Tracked events; ``start`` and ``end`` (half-open) restrict the scan of the source itself."""
    source = _table(spark, sf_dir, "events")
    if start is not None:
        source = source.filter(F.col("ts") >= ntz(source_time(start)))
    if end is not None:
        source = source.filter(F.col("ts") < ntz(source_time(end)))
    return map_events(source)


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same events on the uncompressed clock, one entity per user: they live for weeks."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        _event_type().alias("type"),
        F.col("user_id").alias("fulfillment_id"),
        F.col("ts").alias("created_at"),
        F.col("user_id").cast("string").alias("created_by_id"),
    )


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All nine tables of the snapshot. ``fulfillments`` hides nothing; replays cut it by time."""
    ev = events(spark, sf_dir)
    n_orders = _table(spark, sf_dir, "orders").count()
    ended = F.when(F.col("type") == m.FULFILLMENT_ENDED, F.col("created_at"))
    never_started = F.floor(F.col("fulfillment_id") / 100) % 10 == 9
    fulfillments = (
        ev.groupBy("fulfillment_id")
        .agg(F.min("created_at").alias("first"), F.min(ended).alias("actual_ended_at"))
        .select(
            F.col("fulfillment_id").alias("id"),
            F.concat(F.lit("f-"), F.col("fulfillment_id")).alias("uuid"),
            (F.col("fulfillment_id") % F.lit(n_orders)).alias("reservation_id"),
            F.when(~never_started, F.col("first")).alias("actual_started_at"),
            "actual_ended_at",
        )
    )
    supplier = _table(spark, sf_dir, "supplier")
    nation = _table(spark, sf_dir, "nation")
    part = _table(spark, sf_dir, "part")
    first_supplier = supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("institution_id"))
    digit = F.col("p_partkey") % 10

    def tagging(df, taggable, tag, kind, context):
        return df.select(
            F.col(taggable).cast("long").alias("taggable_id"),
            F.lit(kind).alias("taggable_type"),
            F.col(tag).alias("tag_id"),
            F.lit(context).alias("context"),
        )

    return {
        "events": ev,
        "fulfillments": fulfillments,
        "reservations": _table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("iteration_id")),
        "iterations": _table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("type"),
            F.col("c_nationkey").alias("exam_id")),
        "exams": nation.join(first_supplier, nation.n_nationkey == first_supplier.s_nationkey, "left")
        .select(F.col("n_nationkey").alias("id"), "institution_id"),
        "institutions": supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
        .select(
            F.col("s_suppkey").alias("id"),
            F.when(F.col("s_suppkey") % 7 != 3, F.col("n_regionkey")).alias("proctor_level_id")),
        "proctor_levels": _table(spark, sf_dir, "region").select(
            F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "tags": part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name")),
        "taggings": tagging(part.filter(digit < 3), "p_size", "p_partkey", "Institution", "skills")
        .unionByName(tagging(part.filter(digit == 4), "p_size", "p_partkey", "Exam", "skills"))
        .unionByName(tagging(supplier.filter(F.col("s_suppkey") % 2 == 0), "s_suppkey", "s_suppkey",
                             "Institution", "service_types")),
    }
