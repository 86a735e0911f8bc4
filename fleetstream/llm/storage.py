"""Tables in the shared folder, which cut lineage and outlive lost executors."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetstream.sources.package import ship_package  # noqa: F401
from fleetstream.sources.workdir import shared_dir


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write the rows below ``spark.checkpoint.dir`` and read them from there."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_tasks_of(df: DataFrame, rows: int, each: int) -> DataFrame:
    """The rows of ``df`` in about one task per ``each`` of ``rows``, one per core at least.

    What is little, however many shuffle partitions there are, takes no longer to start and
    write than to work on. The number of tasks grows with the rows, up to those of ``df``.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-rows // each)))


#: Rows of a few numbers that may be broadcast, some ten megabytes.
_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Mark a stored table of ids for a broadcast, if it has few enough."""
    return F.broadcast(df) if df.count() <= _BROADCAST_ROWS else df


#: What a Python worker keeps for further tasks of the same kind.
KEPT: dict[str, object] = {}


def release_memory(keep: bool = False) -> None:
    """Give back what a Python worker no longer uses: it lives on for tasks of other kinds,
    and what one has freed would otherwise count beside what the next one takes. ``KEPT``
    goes, too, unless the task that ends has use for it."""
    if not keep:
        KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    # Where the C library is another one, freed memory stays with it.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(work: Callable[..., pa.Table], *args) -> pa.Table:
    """work(*args), with memory given back before and after: workers take turns, and one that
    waits for its next group keeps what the last one has freed."""
    release_memory()
    found = work(*args)
    release_memory()
    return found


def chance(*columns) -> Column:
    """A number from 0 up to 1 that a hash of the columns gives, in steps of 2**-53."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(2.0**53)


def fresh(name: str, columns: Iterable[str]) -> str:
    """The name, with as many underscores as tell it from the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
