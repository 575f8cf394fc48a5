"""What a Python worker keeps from task to task: the tables of one operator at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import Any, TypeVar

import pyarrow as pa

Kept = TypeVar("Kept")

_kept: list[tuple[Hashable, Any]] = []

# Only the C library of GNU has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def keep(key: Hashable, build: Callable[[], Kept]) -> Kept:
    """The object of that key, built when the worker holds another one.

    Workers outlive stages. Holding the models of all operators that a pipeline
    went through would add up, so the last one is dropped before the next is built.
    """
    if not _kept or _kept[0][0] != key:
        release()
        _kept.append((key, build()))
    return _kept[0][1]


def release() -> None:
    """Give back what an operator before has left; for visits that keep nothing themselves."""
    if _kept:
        _kept.clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Hand free memory to the system, which both Arrow and the C library otherwise keep for later.

    A worker that waits for its next stage then holds its tables only, and the executor's other processes have the rest.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def kept() -> list[Hashable]:
    """The keys of what this worker holds."""
    return [key for key, _ in _kept]
