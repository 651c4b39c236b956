"""What a Python worker does after a task: idle workers stay alive beside the JVM, so they must not sit on freed memory."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa


def release() -> None:
    """Give memory that is free back to the system, where the platform can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        return


def tidy(run: Callable) -> Callable:
    """A function for mapInArrow that releases memory at its end."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def tidy_group(run: Callable) -> Callable:
    """A function for applyInArrow that releases memory at its end."""

    @functools.wraps(run)
    def wrapped(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            release()

    return wrapped
