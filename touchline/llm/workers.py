"""Memory of Python workers, which Spark keeps from stage to stage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

#: Bytes of text, about, that a worker turns into Python strings at once.
SLICE_BYTES = 1_000_000
#: Bytes of a batch on its way to a worker.
BATCH_BYTES = 4 << 20
_HELD: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], Any] | None = None) -> Any:
    """What the worker keeps under ``key``; ``make`` builds it first.

    A worker keeps one thing: when an operator asks for its own, what the operator before it kept is dropped, and its
    memory returned. Without ``make`` nothing is kept.
    """
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            pa.default_memory_pool().release_unused()
            give_back()
        _HELD[key] = make() if make else None
    return _HELD[key]


def give_back() -> None:
    """Return freed memory to the system, where the C library has a call for it."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(spark) -> None:
    """Bound the batches Spark sends to workers by bytes: texts have any length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def by_bytes(batch: pa.RecordBatch, column: int, most_bytes: int = SLICE_BYTES, most_rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Slices of about so many bytes of a text column, and rows at most; one longer text is a slice of its own."""
    if not batch.num_rows:
        return
    texts = batch.column(column).cast(pa.large_string())
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1])
    at, held_bytes = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > at and (held_bytes + size > most_bytes or i - at >= most_rows):
            yield batch.slice(at, i - at)
            at, held_bytes = i, 0
        held_bytes += size
    yield batch.slice(at)
