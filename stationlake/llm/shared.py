"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.scratch import scratch_folder

#: The white space of the word pattern, as a Java character class.
SPACE = "[\\x20\\x09-\\x0D]+"
#: Bytes of text that a Python worker takes at a time, and of rows that Spark hands to it together: its default of 64 MB is held
#: outside the heap by every task, in buffers that double while they fill.
SLICE_BYTES = 4_000_000
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES))
#: Shuffle files of a job that is over are deleted at once, not when the driver happens to collect its garbage.
CLEARED = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def words_between(text: Column, separators: str = SPACE) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


@contextmanager
def small_batches(spark: SparkSession, *more: tuple[str, str]) -> Iterator[None]:
    """Jobs started inside hand at most BATCH_BYTES of rows to a Python worker together, with more settings if there are any;
    the session's settings come back."""
    before = [(name, spark.conf.get(name, None)) for name, _ in (BATCH_BYTES, *more)]
    for name, value in (BATCH_BYTES, *more):
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before:
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to the folder all executors share, and read back.

    This cuts the lineage: an executor lost later costs its own tasks only. The job's shuffle files go when it is done.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    with small_batches(spark, CLEARED):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def thrifty(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, after which the worker gives back what it no longer holds. Workers live on from stage to stage, and the C library
    keeps what was freed: each stage would add its own peak to what an executor holds."""

    @wraps(run)
    def thrifty_run(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
        if trim:
            trim(0)

    return thrifty_run


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for files that tasks write themselves."""
    return scratch_folder(spark, name)


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns that a result is about to be given the name of."""
    return df.drop(*names)


def packed(df: DataFrame, field: str) -> DataFrame:
    """The whole row as one struct, so that no helper column can clash with its names."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(field)) if df.columns else df


def unique_name(stem: str) -> str:
    return f"{stem}-{uuid.uuid4().hex}"


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with some bytes in a column; a larger row is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)
