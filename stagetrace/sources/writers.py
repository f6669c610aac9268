"""Writers: CSV and messages, append-only logs, current state and metrics.

Logs written from micro-batches carry the batch number as a partition and overwrite only the
partitions they write, so a batch that runs twice leaves the same rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrace.functions.scalar import ntz
from stagetrace.operators.cleaning import to_messages
from stagetrace.operators.current import latest
from stagetrace.operators.snapshot import metric_rows
from stagetrace.sources.buckets import BucketStore, delete, versions

# Rows of one file of a log.
FILE_ROWS = 5_000_000
# Fixed value: a character that no text holds.
_NO_TEXT = "\x01"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header and full-precision times."""
    (df.write.mode(mode).option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def write_lines(lines: DataFrame, path: str, header: str, mode: str = "errorifexists") -> None:
    """Texts of one column as lines, just as they are, of files that each begin with the line ``header``.

    Every task writes files of its own. Empty lines are left out, as readers of CSV do.
    """
    # no character of a text is a separator, a quote, a comment's first or padding
    (lines.toDF(header).write.mode(mode).option("header", True).option("sep", _NO_TEXT).option("comment", _NO_TEXT).option("quote", "")
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_messages(events: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON message per line; for other sinks use the ``value`` column of ``to_messages``."""
    to_messages(events).write.mode(mode).text(path)


def stream_messages(events: DataFrame, path: str, checkpoint: str, fmt: str = "text", **trigger):
    return (to_messages(events).writeStream.format(fmt).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start(path))


def stream_raw_events(events: DataFrame, path: str, checkpoint: str, **trigger):
    """Append the raw events by day; each message lands exactly once."""
    dated = events.withColumn("day", F.to_date("created_at"))
    return (dated.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .partitionBy("day").trigger(**(trigger or {"availableNow": True})).start(path))


def _write_batch(df: DataFrame, path: str, batch_id: int, by: list[str]) -> None:
    if by:  # small days stay whole, a large one is dealt to several tasks by what it weighs when it is shuffled
        df = df.hint("rebalance", *map(F.col, by))
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_ROWS).partitionBy(*by, "batch_id").parquet(path))


def compact_log(spark: SparkSession, path: str, upto: int) -> None:
    """Fold the batches up to ``upto`` of every day of a log into one, which then bears the number of the newest of them.

    Only days of several such batches are read and written. The folded rows are written beside the log first; then that batch's rows
    are replaced, and the other batches' deleted last. Stopped in between, it may be run again, and ends with every row once:
    the copy beside the log stays until all is done, and is gone on with. Batches may be appended meanwhile; readers should wait.
    """
    beside = f"{path.rstrip('/')}-folded"
    if not versions(spark, beside, "upto", True):
        parts = [(d, b) for d in _days(spark, path) for b in versions(spark, f"{path}/{d}", "batch_id", False) if b <= upto]
        several = sorted({d for d, _ in parts if sum(x == d for x, _ in parts) > 1})
        if not several:
            return
        folders = [f"{path}/{d}/batch_id={b}" for d, b in parts if d in several]
        newest = {d: max(b for x, b in parts if x == d) for d in several}
        rows = spark.read.option("basePath", path).parquet(*folders).drop("batch_id")
        numbers = F.element_at(F.create_map(*(F.lit(x) for d, b in newest.items() for x in (d.split("=")[1], b))), F.coalesce(F.col("day").cast("string"), F.lit(_NO_DAY)))
        rows.withColumn("batch_id", numbers).hint("rebalance", F.col("day")).write.mode("overwrite").partitionBy("day", "batch_id").parquet(f"{beside}/upto={upto}")
    upto = versions(spark, beside, "upto", True)[-1]
    copy = f"{beside}/upto={upto}"
    for day in _days(spark, copy):
        kept = versions(spark, f"{copy}/{day}", "batch_id", False)[-1]
        folded = spark.read.parquet(f"{copy}/{day}/batch_id={kept}")
        folded.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(f"{path}/{day}/batch_id={kept}")
        for old in versions(spark, f"{path}/{day}", "batch_id", False):
            if old < kept:
                delete(spark, f"{path}/{day}/batch_id={old}")
    delete(spark, beside)


# Fixed value: how Spark names the folder of rows without a day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _days(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(n for n in (str(f.getPath().getName()) for f in files) if n.startswith("day="))


def append_changes(changes: DataFrame, path: str, batch_id: int) -> None:
    """Append to the transition log, partitioned by day of the change.

    A batch that runs again writes the same days, so it replaces exactly its own rows.
    """
    _write_batch(changes.withColumn("day", F.to_date("change_time")), path, batch_id, ["day"])


def append_unique(events: DataFrame, path: str, batch_id: int) -> None:
    """Append a batch of raw events to the log of their days, less those whose id an earlier batch has brought."""
    _write_batch(events.withColumn("day", F.to_date("created_at")), path, batch_id, ["day"])


def append_snapshot(snapshot: DataFrame, path: str, batch_id: int) -> None:
    """Append the seven metric columns of a snapshot, partitioned by day."""
    _write_batch(metric_rows(snapshot).withColumn("day", F.to_date("t")), path, batch_id, ["day"])


CURRENT = ("f_id long, state string, state_start_time timestamp_ntz, state_start_id long, "
           "first_seen timestamp_ntz, as_of_time timestamp_ntz, as_of_id long")


def current_store(spark: SparkSession, store: str) -> BucketStore:
    """The table of current states, in buckets of the entity."""
    return BucketStore(spark, store, CURRENT, ("f_id",), strict=True)


def upsert_current(batch: DataFrame, store: str, batch_id: int, unique: bool = False) -> None:
    """Set one batch's rows of ``CURRENT`` in the store of current states; ``unique`` says that an entity has one row at most.

    Only the buckets of these entities get a file. A batch that runs again replaces its own rows.
    """
    current_store(batch.sparkSession, store).put(batch if unique else latest(batch), batch_id)


def current_rows(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    """Rows of ``CURRENT``, one per entity, as of all batches, or those ``before`` a batch.

    An empty store is read as an empty table.
    """
    return current_store(spark, store).all(before)


def read_current(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    """``(f_id, state, state_start_time)`` as of all batches in the store, or those ``before`` one."""
    return current_rows(spark, store, before).select("f_id", "state", "state_start_time")


def lookup_current(spark: SparkSession, store: str, f_id: int) -> DataFrame:
    """``(f_id, state, state_start_time)`` of one entity; only the files of its bucket are opened."""
    return current_store(spark, store).lookup(f_id).select("f_id", "state", "state_start_time")


def compact_current(spark: SparkSession, store: str, upto: int, absorbed: tuple[str, ...] = (),
                    cold_before: datetime | None = None) -> None:
    """Fold the versions of every bucket that has several into one, as of the batches up to ``upto``.

    Entities in a state of ``absorbed``, which no event leaves, and without an event since ``cold_before``, move to the cold tier.
    ``upto`` itself may run again: the files that it started from stay until the next batch has ended.
    """
    cold = F.col("state").isin(list(absorbed)) if absorbed else None
    if cold is not None and cold_before is not None:
        cold = cold & (F.col("as_of_time") < ntz(cold_before))
    current_store(spark, store).compact(upto, cold)
