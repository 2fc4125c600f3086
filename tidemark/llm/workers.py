"""Small state of a Python worker process that outlives one task."""

from __future__ import annotations

import ctypes
import gc
import sys
import types


def worker_cache(name: str) -> dict:
    """A dict of this worker process, by name. Holds only what can be computed again.

    A worker that goes on to another operator gives the last one's memory back first: Spark keeps
    workers alive, and several operators' caches at once would add up.
    """
    store = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker"))
    held = store.__dict__.setdefault("caches", {})
    if name not in held:
        if held:
            held.clear()
            _give_back()
        held[name] = {}
    return held[name]


def _give_back() -> None:
    """Return freed memory to the system, where its allocators can."""
    import pyarrow as pa

    gc.unfreeze()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)
