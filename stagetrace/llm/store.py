"""Tables written between phases of a job, in the folder that all executors share."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession

from stagetrace.session import scratch_path


class Kept:
    """A table written once; ``drop`` deletes it when no later phase reads it."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        self.schema = df.schema
        df.write.parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` worked out once: written as Parquet and read again, which also cuts its lineage."""
    return Kept(df, name).read()


def release(spark: SparkSession, wait: float = 0.5) -> None:
    """Let Spark's cleaner see that finished phases are gone, so their shuffle files are deleted.

    Listeners still hold a phase for a moment after its end, hence the second look after ``wait`` seconds.
    """
    for pause in (wait, 0):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(pause)
