"""Memory of Python workers, which outlive their tasks."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def give_back() -> None:
    """Return what this worker no longer uses to the system, so that later stages and the JVM beside it have it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not this C library
