"""What a Python worker holds: batches of a bounded size, and between tasks the cache of one operator.

Workers are reused by later stages. A cache that an earlier operator left would
take memory from theirs, so holding one drops any other.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch sent to a worker (Spark's own default is 64 MB, kept twice: off the heap and in the worker).
BATCH_BYTES = 4 << 20

_held: dict[Any, Any] = {}


def hold(key: Any, make: Callable[[], Any]) -> Any:
    """The cache named ``key``, made if this worker does not hold it."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Called by operators that keep nothing."""
    if _held:
        _held.clear()
        trim()


def trim() -> None:
    """Give freed memory back to the system: Arrow's pool and glibc keep it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """For operators that keep nothing: drops what another left, and trims after the task."""

    def tidied(batches: Iterator) -> Iterator:
        release()
        try:
            yield from run(batches)
        finally:
            trim()

    return tidied


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: Any) -> DataFrame:
    """``df.mapInArrow`` over batches of about ``BATCH_BYTES``, or one row if that is longer.

    Sets the session's bound, which holds for its later queries too; one that the
    user has set stays.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY, None) is None:
        conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)
