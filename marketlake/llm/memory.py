"""Memory of Python workers. They stay alive between tasks, and what one task has freed the C library keeps for the next."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def release() -> None:
    """Give unused memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of a task's batches that releases memory at its end."""

    @wraps(function)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            release()

    return run
