"""Groups of bounded size streamed through Arrow, many per batch."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

BATCH_BYTES = 16 << 20


def arrow_schema(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)


def streamed(out: pa.Schema, groups: Callable[[pa.Table], dict], keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            cuts = _cuts(table, keys)
            last = int(cuts[-1])
            if last == 0:
                rest = table
                continue
            rest = table.slice(last)
            yield from _emit(table.slice(0, last), cuts, groups, out)
        if rest is not None:
            yield from _emit(rest, np.append(_cuts(rest, keys), rest.num_rows), groups, out)

    return run


def _cuts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        x = table.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _emit(table, cuts, groups, out):
    found = groups(table.combine_chunks(), cuts)
    rows = pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in out], schema=out)
    if rows.num_rows:
        yield rows


def map_arrow(df: DataFrame, run, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, so that long texts don't pile up in a worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(_then_released(run), schema)


def _then_released(run):
    """``run``, after which a worker gives back what it no longer uses: workers outlive their tasks, and so would freed memory."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim is not None:
            trim(0)

    return inner


def map_groups(df: DataFrame, keys: list[str], order: list[str],
               groups: Callable[[pa.Table, np.ndarray], dict], schema: str) -> DataFrame:
    """``groups(table, cuts)`` on whole groups of equal ``keys`` (no NULLs), sorted by keys and ``order``.

    ``cuts`` holds the first row of every group and the number of rows. The caller bounds the size of a group.
    """
    return map_arrow(df.repartition(*keys).sortWithinPartitions(*keys, *order),
                     streamed(arrow_schema(schema), groups, keys), schema)
