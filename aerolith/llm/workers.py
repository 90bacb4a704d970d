"""What a Python worker keeps from one task to the next.

Spark hands a worker from stage to stage, so a memo of one operator would lie beside
the work of the next.  A worker holds one memo at a time, and operators that need
memory themselves release it first."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_held: dict[str, object] = {}


def kept(name: str, build: Callable[[], object]) -> object:
    """The object ``name`` of this worker, built anew unless it is the one held."""
    if name not in _held:
        release()
        _held[name] = build()
    return _held[name]


def release() -> None:
    """Gives what is held, and what the allocators keep of earlier batches, back to the
    system; it may be called in any task, as ``kept`` builds again what it needs."""
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)
