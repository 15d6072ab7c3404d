"""What the operators share: Arrow batches cut by bytes, fresh column names, a bounded key filter."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.session import ship_package

#: Bytes of text that a step holds at once. A longer document makes a slice of its own.
SLICE_BYTES = 3 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``limit`` bytes in each, but one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m", rows: int = 256) -> Iterator[None]:
    """Hand Python smaller batches for a while, for rows of many bytes; for steps that end within."""
    names = {"spark.sql.execution.arrow.maxBytesPerBatch": size, "spark.sql.parquet.columnarReaderBatchSize": str(rows)}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return pc.fill_null(batch.column(column), "").to_pylist()


_kept: dict = {}


def keep(make: Callable, *args):
    """``make(*args)``, remembered until something else is asked for, which frees it first.

    Spark reuses a Python worker for later stages; this way it holds the tables of one operator at a time.
    """
    key = (make, *args)
    if key not in _kept:
        _kept.clear()
        give_back()
        _kept[key] = make(*args)
    return _kept[key]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return what this Python worker no longer uses to the system: Spark keeps idle workers, and their memory counts."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def arrow_map(df: DataFrame, step: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` on executors that have this package."""
    ship_package(df.sparkSession)

    def run(batches):
        yield from step(batches)
        give_back()

    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, step: Callable, fields: list[T.StructField]) -> DataFrame:
    """Run ``step`` (batches to batches) that appends ``fields`` to all columns of ``df``."""
    return arrow_map(df, step, T.StructType([*df.schema.fields, *fields]))


def with_arrays(batch: pa.RecordBatch, arrays: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays.values()], names=[*batch.schema.names, *arrays])


#: Places of a key filter: its broadcast holds at most so many longs, whatever the size of the data.
FILTER_PLACES = 1 << 20


def key_place(value: Column, places: int = FILTER_PLACES) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(places).cast("long"))


def key_filter(keys: DataFrame, key: str, places: int = FILTER_PLACES) -> DataFrame:
    """The places that the values of ``key`` take: a set with a fixed bound, fit for a broadcast.

    A join with it lets every value of ``keys`` through, and a few others. With very many keys it lets
    everything through: callers filter early with it and stay right without it.
    """
    return keys.select(key_place(F.col(key), places).alias("_place")).distinct()


def join_filter(df: DataFrame, value: Column, places: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``value`` may be (``left_semi``) or cannot be (``left_anti``) among the keys."""
    return df.join(F.broadcast(places), key_place(value) == places["_place"], how)


def release(df: DataFrame) -> None:
    """Let Spark drop the broadcasts and shuffle files of plans that are done with.

    Its cleaner waits for the driver's garbage collection, which comes late when many small rounds leave little garbage
    each; until then they fill the driver's heap and the executors' disks.
    """
    df.sparkSession.sparkContext._jvm.System.gc()
