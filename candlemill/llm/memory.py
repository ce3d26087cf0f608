"""Give a task's memory back at its end.

Python workers are used again by later tasks and stages, and neither Arrow's pool nor the C
library returns freed memory by itself, so without this a worker stays as large as its largest
task.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

_kept: list[Callable[[], None]] = []

try:
    _trim = ctypes.CDLL(None).malloc_trim  # only the GNU library has it
except (AttributeError, OSError):
    _trim = None


def at_end(forget: Callable[[], None]) -> Callable[[], None]:
    """Register a function that drops what a module keeps in a worker."""
    _kept.append(forget)
    return forget


def release() -> None:
    for forget in _kept:
        forget()
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def lean(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run``, a function of batches, which releases what it used when its task ends."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped
