"""A keyed table that micro-batches change: what a batch reads and writes depends on the batch, not on the table.

Rows lie in buckets of their key. A batch writes its rows as one more version of the buckets it touches and reads no others.
``pointer/version=...`` names the folders that make up the table as of a batch, and a batch counts once its pointer is
finished; so a batch that runs again starts from the pointer of the batch before it and replaces its own files only.
Compaction folds the versions of a bucket into one and may move rows that are done for good to a cold tier, which later
batches open only for keys that the hot tier does not hold.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stagetrace.functions.scalar import floor_div
from stagetrace.plans.skew import broadcast_if_small
from stagetrace.session import settle

BUCKETS = 16
# Neighbouring ids that one task writes at least.
TASK_IDS = 1 << 20
# Keys that may be written into a filter, so that the statistics and Bloom filters of files are asked.
FILTER_KEYS = 1_000
HOT, COLD = ("base", "rows"), ("cold",)
# Pointers of one batch: its own, then one per compaction after it.
_TURNS = 1_000
_VERSION = "_v"


def by_hash(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("long")


def by_range(key: str, width: int) -> Column:
    """Neighbouring keys share a bucket: for keys that grow with time, so that new ones meet few buckets."""
    return floor_div(key, width)


def versions(spark: SparkSession, folder: str, name: str, complete: bool) -> list[int]:
    """Numbers ``n`` of the sub-folders ``name=n``, in order; only finished ones if ``complete``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(folder)):
        return []
    found = [str(f.getPath().getName()) for f in fs.listStatus(path(folder))]
    numbers = [int(f.split("=")[1]) for f in found if f.startswith(f"{name}=")]
    if complete:
        numbers = [n for n in numbers if fs.exists(path(f"{folder}/{name}={n}/_SUCCESS"))]
    return sorted(numbers)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _lines(spark: SparkSession, folder: str) -> list[str]:
    """The lines of a few small text files, read without a job."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for file in fs.listStatus(path):
        if file.getPath().getName().startswith("part-"):
            stream = fs.open(file.getPath())
            found += spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
            stream.close()
    return found


Part = tuple[int, str, int]  # bucket, tier, number of the version


@dataclass(frozen=True)
class BucketStore:
    """The table at ``path`` with the columns of ``schema``, unique in ``key``.

    ``bucket`` gives a row's bucket from its ``by`` column, and only depends on that; ``inside``, for buckets that hold many keys,
    which part of it a task writes. ``strict`` says that no batch brings a key twice: one version alone is then read as it lies.
    """

    spark: SparkSession
    path: str
    schema: str
    key: tuple[str, ...]
    bucket: Callable[[str], Column] = by_hash
    inside: Callable[[str], Column] | None = None
    strict: bool = False

    @property
    def by(self) -> str:
        return self.key[0]

    # --- pointers

    def pointers(self, before: int | None = None) -> list[int]:
        found = versions(self.spark, f"{self.path}/pointer", "version", True)
        return [n for n in found if before is None or n // _TURNS < before]

    def batches(self) -> list[int]:
        """The finished batches that can still be read."""
        return sorted({n // _TURNS for n in self.pointers()})

    def _named(self, pointer: int) -> set[Part]:
        found = map(json.loads, _lines(self.spark, f"{self.path}/pointer/version={pointer}"))  # a few per bucket
        return {(r["bucket"], r["tier"], r["version"]) for r in found}

    def parts(self, before: int | None = None) -> set[Part]:
        """The parts of the table as of all batches, or those ``before`` one."""
        found = self.pointers(before)
        return self._named(found[-1]) if found else set()

    def _point(self, pointer: int, parts: set[Part]) -> None:
        text = json.dumps([{"bucket": b, "tier": t, "version": v} for b, t, v in sorted(parts)])
        rows = self.spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), "array<struct<bucket: long, tier: string, version: long>>")))
        rows.write.mode("overwrite").option("compression", "none").json(f"{self.path}/pointer/version={pointer}")
        self._sweep()

    def _sweep(self) -> None:
        """Delete what neither the last two pointers name, for readers of the one before, nor that of the batch before, for a batch that runs again."""
        found = self.pointers()
        kept = {*found[-2:], *[n for n in found if n // _TURNS < found[-1] // _TURNS][-1:]}
        gone = [n for n in found if n not in kept]
        if gone:
            named = set().union(*(self._named(n) for n in kept))
            for part in set().union(*(self._named(n) for n in gone)) - named:
                delete(self.spark, self._folder(part))
            for n in gone:
                delete(self.spark, f"{self.path}/pointer/version={n}")

    def _folder(self, part: Part) -> str:
        bucket, tier, version = part
        return f"{self.path}/{tier}/version={version}/bucket={bucket}"

    # --- rows

    def _columns(self) -> list[str]:
        return StructType.fromDDL(self.schema).names

    def _read(self, parts: Iterable[Part]) -> DataFrame:
        folders = sorted(map(self._folder, parts))
        schema = StructType.fromDDL(f"{self.schema}, {_VERSION} long")
        if not folders:
            return self.spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
        return self.spark.read.schema(schema).parquet(*folders)

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.key]
        if rest == [_VERSION]:
            return rows.groupBy(*self.key).agg(F.max(_VERSION).alias(_VERSION))
        newest = F.max_by(F.struct(*rest), _VERSION)
        # a key has few versions, so nothing is gained by aggregating before the shuffle
        return rows.repartition(*self.key).groupBy(*self.key).agg(newest.alias("r")).select(*self.key, "r.*")

    def _found(self, parts: Iterable[Part], narrow: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """The newest row of every key in ``parts``, of the rows that ``narrow`` leaves of each key's."""
        rows = narrow(self._read(parts))
        several = len({b for b, _, _ in parts}) < len(set(parts))
        return self._newest(rows) if several or not self.strict else rows

    def _write(self, rows: DataFrame, tier: str, version: int) -> set[Part]:
        folder = f"{self.path}/{tier}/version={version}"
        # sorted by key, so that the statistics of row groups tell which hold one
        by = ["bucket", *([self.inside(self.by)] if self.inside else [])]
        writer = rows.withColumn("bucket", self.bucket(self.by)).repartition(*by).sortWithinPartitions("bucket", *self.key).write
        if tier != "rows":  # what stays for long is asked for single keys
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.by}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.mode("overwrite").partitionBy("bucket").parquet(folder)
        return {(b, tier, version) for b in versions(self.spark, folder, "bucket", False)}

    def all(self, before: int | None = None) -> DataFrame:
        """The whole table as of all batches, or those ``before`` one. An empty store is read as an empty table."""
        return self._found(self.parts(before)).select(*self._columns())

    def get(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """The rows of ``keys (by)``, distinct and read from a table, out of the buckets that they fall into and no others.

        The cold tier is asked for keys that the hot one does not hold, by a filter that reaches the files if they are few.
        """
        parts = self.parts(before)
        if not parts:
            return self._read(parts).select(*self._columns())
        keys, _ = broadcast_if_small(keys)
        hot = self._touched(parts, HOT, keys)
        found = self._found(hot, lambda rows: rows.join(keys, self.by, "left_semi"))
        if any(tier in COLD for _, tier, _ in parts):
            found = settle(found)
            absent = settle(keys.join(found, self.by, "left_anti"))
            cold = self._read(self._touched(parts, COLD, absent))
            few = [r[0] for r in absent.limit(FILTER_KEYS + 1).collect()]
            if len(few) <= FILTER_KEYS:
                cold = cold.filter(F.col(self.by).isin(few))
            else:
                cold = cold.join(broadcast_if_small(absent)[0], self.by, "left_semi")
            found = found.unionByName(self._newest(cold))
        return found.select(*self._columns())

    def _touched(self, parts: set[Part], tiers: tuple[str, ...], keys: DataFrame) -> set[Part]:
        buckets = {b for b, tier, _ in parts if tier in tiers}
        if not buckets:
            return set()
        # no more buckets come back than the pointer names
        asked = keys.select(self.bucket(self.by).alias("b")).distinct().filter(F.array_contains(F.lit(sorted(buckets)), F.col("b")))
        touched = {r.b for r in asked.collect()}
        return {p for p in parts if p[1] in tiers and p[0] in touched}

    def lookup(self, value: int, before: int | None = None) -> DataFrame:
        """The row of one key: one bucket is read, filtered where it lies."""
        bucket = self.spark.sql(f"SELECT CAST({int(value)} AS BIGINT) AS k").select(self.bucket("k")).first()[0]
        parts = {p for p in self.parts(before) if p[0] == bucket}
        rows = self._read(parts).filter(F.col(self.by) == F.lit(value))
        return self._newest(rows).select(*self._columns())

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Set the rows of a batch, unique in their key; only their buckets get a file. The same batch again replaces them."""
        parts = self.parts(batch_id)
        for stale in [n for n in versions(self.spark, f"{self.path}/pointer", "version", False) if n // _TURNS >= batch_id]:
            delete(self.spark, f"{self.path}/pointer/version={stale}")
        number = batch_id * _TURNS
        new = self._write(rows.select(*self._columns(), F.lit(number).cast("long").alias(_VERSION)), "rows", number)
        self._point(number, parts | new)

    def compact(self, upto: int | None = None, cold: Column | None = None, drop: Column | None = None) -> None:
        """Fold buckets of several hot versions into one, as of the batches up to ``upto``.

        Rows for which ``cold`` holds move to the cold tier, those for which ``drop`` holds are left out for good. Buckets with one version
        only are left alone. Safe to stop anywhere: the new pointer counts once it is finished.
        """
        found = self.pointers(None if upto is None else upto + 1)
        if not found:
            return
        parts = self._named(found[-1])
        hot = {p for p in parts if p[1] in HOT}
        several = {p for p in hot if sum(q[0] == p[0] for q in hot) > 1}
        if not several:
            return
        number = found[-1] + 1
        rows = self._newest(self._read(several))
        if cold is not None:
            rows = settle(rows)
        if drop is not None:
            rows = rows.filter(~F.coalesce(drop, F.lit(False)))
        new: set[Part] = set()
        if cold is not None:
            cold = F.coalesce(cold, F.lit(False))
            done, rows = rows.filter(cold), rows.filter(~cold)
            if done.take(1):
                new |= self._write(done, "cold", number)
        new |= self._write(rows, "base", number)
        self._point(number, (parts - several) | new)

    def compact_cold(self, upto: int | None = None) -> None:
        """Fold the cold versions of every bucket that has several into one."""
        found = self.pointers(None if upto is None else upto + 1)
        parts = self._named(found[-1]) if found else set()
        cold = {p for p in parts if p[1] in COLD}
        several = {p for p in cold if sum(q[0] == p[0] for q in cold) > 1}
        if several:
            number = found[-1] + 1
            self._point(number, (parts - several) | self._write(settle(self._newest(self._read(several))), "cold", number))


def id_store(spark: SparkSession, path: str, width: int = 1 << 24) -> BucketStore:
    """A set of ids, ``width`` neighbouring ones to a bucket."""
    return BucketStore(spark, path, "id long", ("id",), partial(by_range, width=width), partial(by_range, width=TASK_IDS), True)
