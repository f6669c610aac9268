"""Readers: event files, message streams and the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrace.functions.scalar import decode_message, legacy_field, parse_time
from stagetrace.model import EVENT_CSV_SCHEMA, TABLE_NAMES


def read_events_csv(spark: SparkSession, path: str, schema=EVENT_CSV_SCHEMA,
                    infer: bool = False) -> DataFrame:
    """Events from CSV with a header; columns are found by name, others are not read.

    Times are parsed, never kept as text, so their order is that of time. ``infer`` guesses the
    types of all columns instead of taking those of ``schema``.
    """
    reader = spark.read.option("header", True)
    if infer:
        df = reader.option("inferSchema", True).option("preferDate", False).csv(path)
    else:
        df = reader.csv(path).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    if dict(df.dtypes)["created_at"] == "string":
        return df.withColumn("created_at", parse_time("created_at"))
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def split_events_csv(spark: SparkSession, path: str, schema=EVENT_CSV_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Events from CSV with a header, and the rows that cannot be read as ``(record, reason)``.

    ``reason`` is ``record`` for a row that has not one field per column, else the first column whose text is not of its type:
    ``id``, ``fulfillment_id``, ``created_at``. A field that is missing is no fault here; see ``cleaning.rejected_events``.
    """
    names = spark.read.option("header", True).csv(path).columns
    text = ", ".join(f"`{n}` string" for n in names)
    # all fields are parsed, or a short row would not be noticed
    raw = (spark.read.schema(f"{text}, _record string").option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_record").option("columnPruning", False).csv(path))
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema} | {"created_at": parse_time("created_at")}
    reason = F.when(F.col("_record").isNotNull(), "record")
    for f in schema:
        reason = reason.when(F.col(f.name).isNotNull() & typed[f.name].isNull(), f.name)
    judged = raw.withColumn("_reason", reason)
    good = judged.filter("_reason IS NULL").select(*(typed[f.name].alias(f.name) for f in schema))
    record = F.coalesce("_record", F.to_csv(F.struct(*(f"`{n}`" for n in names))))
    return good, judged.filter("_reason IS NOT NULL").select(record.alias("record"), F.col("_reason").alias("reason"))


def parse_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Events from JSON messages. A text that is no message gives a row of NULLs, not a loss."""
    return df.select(decode_message(value).alias("m")).select(
        F.col("m.id").alias("id"), F.col("m.event_type").alias("type"),
        F.col("m.f_id").alias("fulfillment_id"), parse_time("m.event_time").alias("created_at"),
        F.col("m.created_by").alias("created_by_id"))


def parse_legacy(df: DataFrame, value: str = "value") -> DataFrame:
    """Type and entity from space-separated messages: second and fourth field."""
    return df.select(
        legacy_field(value, 1).alias("type"),
        legacy_field(value, 3).try_cast("long").alias("fulfillment_id"))


def read_event_stream(spark: SparkSession, path: str | None = None, fmt: str = "text",
                      **options) -> DataFrame:
    """Events from a stream of JSON messages.

    ``fmt="text"`` watches a folder of files with one message per line. ``fmt="kafka"`` takes the
    usual connection options and no path.
    """
    reader = spark.readStream.format(fmt).options(**options)
    return parse_messages(reader.load(path) if path else reader.load())


def read_table_stream(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    """Stream over parquet files of a known schema."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def load_tables(spark: SparkSession, folder: str, names=TABLE_NAMES,
                views: bool = False) -> dict[str, DataFrame]:
    """The relational tables from one parquet folder each, on request also as temporary views."""
    tables = {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in names}
    if views:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return tables
