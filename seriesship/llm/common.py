"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import inspect
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z only, as the digests are defined over ASCII lower case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: A local frame below this many bytes may be sent to every executor.
BROADCAST_BYTES = 32 << 20


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once into the shared checkpoint folder; the lineage ends there.

    The folder is the session's ``spark.checkpoint.dir``. Only in local mode (tests), and where that is unset, a folder
    beside the warehouse is used. Spark removes the files with ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints"))
    return df.checkpoint()


#: With it, Spark removes the shuffle files of a query when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end_with_queries(spark: SparkSession) -> Iterator[None]:
    """Frames made inside give their shuffle files back as soon as an action on them is done.

    For chains of :func:`cut`: its rows are in the shared folder by then, and nothing reads those files again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


#: The rows that a Python worker is sent at once: their bytes, besides their number, 10,000 as a rule.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """From now on batches for Python workers have about 8 MB in this session, unless it has a bound of its own.

    Spark reads it when a frame is run, so it stays set. 10,000 texts take 60 MB and more, in the JVM and in the worker.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(8 << 20))


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its ``rows``, of at most ``row_bytes`` each, stay under the limit; else as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``: how the digests choose held-out rows. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``most`` bytes; a longer text is alone in its batch."""
    for batch in batches:
        start, held = 0, 0
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        for i, n in enumerate(lengths.tolist()):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Hands this process's free memory to the system. Allocators keep hundreds of MB, and a worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run`` of mapInArrow, applyInArrow or cogroups, which gives its memory back at the end of a task or group."""
    if inspect.isgeneratorfunction(run):

        @wraps(run)
        def whole(batches):
            yield from run(batches)
            give_back()

    elif len(inspect.signature(run).parameters) == 1:

        @wraps(run)
        def whole(here):
            out = run(here)
            give_back()
            return out

    else:

        @wraps(run)
        def whole(here, there):
            out = run(here, there)
            give_back()
            return out

    return whole


class Memo(dict):
    """Values of ``fn`` by argument, for use with ``[]``. Call :meth:`trim` between batches.

    It holds at most about twice ``most``: what was not asked for since the last but one trim goes.
    """

    def __init__(self, fn: Callable, most: int = 300_000) -> None:
        super().__init__()
        self.fn, self.most, self.old = fn, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.fn(key)
        self[key] = value
        return value

    def fill(self, keys: set, many: Callable) -> None:
        """Takes (key, value) from ``many(keys)`` for all keys that are not held."""
        new = []
        for key in keys.difference(self):
            value = self.old.get(key)
            if value is None:
                new.append(key)
            else:
                self[key] = value
        self.update(many(new))

    def trim(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
