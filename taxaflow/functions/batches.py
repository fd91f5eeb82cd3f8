"""Arrow batches of bounded size: what Python tasks hold at a time."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession


def small_batches(spark: SparkSession, rows: int = 1024, size: int = 4 << 20) -> None:
    """Holds the session's Arrow batches to so many rows and bytes (by default they have 10,000 and 64 MB), which each
    running task has several times over, in the JVM and in Python."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}").rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def sliced(batches, used: list[str], rows: int = 256, size: int = 1 << 20):
    """Arrow batches in parts of at most so many rows and, beyond one row, bytes of the strings in ``used``, so that the
    Python values made of them stay few."""
    for b in batches:
        held = np.zeros(b.num_rows, np.int64)
        for c in used:
            x = b.column(b.schema.get_field_index(c))
            if pa.types.is_string(x.type) or pa.types.is_binary(x.type):
                held += pc.fill_null(pc.binary_length(x), 0).to_numpy(zero_copy_only=False)
            elif pa.types.is_list(x.type):
                held += 8 * pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
        upto, at = held.cumsum(), 0
        while at < b.num_rows:
            to = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, "right"))
            to = min(max(to, at + 1), at + rows, b.num_rows)
            yield b.slice(at, to - at)
            at = to
    give_back()


def give_back() -> None:
    """Hands memory that Arrow and the C library keep for later back to the system, at the end of a task: workers live on, and the next
    stage's come beside them."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)
