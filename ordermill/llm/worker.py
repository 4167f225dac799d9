"""Memory of Python workers, which Spark reuses from stage to stage and from query to query."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa

_held: dict[str, Callable[[], None]] = {}


def held_by(name: str, drop: Callable[[], None]) -> None:
    """Let ``drop`` free what a worker keeps between tasks under ``name``."""
    _held[name] = drop


def begin(*kept: str) -> None:
    """At the start of a task: drop what other stages left in this worker, and give freed memory back to the system."""
    for name, drop in _held.items():
        if name not in kept:
            drop()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)
