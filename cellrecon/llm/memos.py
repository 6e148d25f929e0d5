"""What a Python worker remembers from task to task: the memos of one operator at a time.

Spark keeps its Python workers between stages, and a stage's tasks profit from what earlier ones have
remembered. What another operator left behind would only add up, so it goes when a new one starts, and
the memory is given back to the machine.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_owner: str | None = None
_held: dict[Hashable, Any] = {}


def start(owner: str) -> None:
    """Called where a task of ``owner`` begins: drops what the worker remembers of any other operator."""
    global _owner
    if owner == _owner:
        return
    left = bool(_held)
    _owner = owner
    _held.clear()
    if left:
        gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What the current owner keeps under ``key``."""
    found = _held.get(key)
    if found is None:
        found = _held[key] = make()
    return found
