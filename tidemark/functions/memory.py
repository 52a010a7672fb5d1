"""Memory of Python workers, which live on after a task beside those of later stages."""

from __future__ import annotations

import ctypes

import pyarrow as pa


#: Blocks from this size on are mapped one by one; so much free memory stays at the end of the heap.
MAPPED_BYTES, FREE_BYTES = 1 << 20, 4 << 20
_M_TRIM_THRESHOLD, _M_MMAP_THRESHOLD = -1, -3


def keep_little() -> None:
    """From now on this process gives large blocks back as soon as they are freed.

    Otherwise the C library raises both bounds by itself, to 32 and 64 MB, once it has freed large blocks, and Arrow's own pool keeps some too.
    """
    try:
        tune = ctypes.CDLL(None).mallopt
        tune(_M_MMAP_THRESHOLD, MAPPED_BYTES)
        tune(_M_TRIM_THRESHOLD, FREE_BYTES)
    except (AttributeError, OSError):  # only some C libraries have it
        return
    pa.set_memory_pool(pa.system_memory_pool())


def give_back() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only some C libraries have it
        pass
