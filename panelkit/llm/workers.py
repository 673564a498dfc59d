"""What a Python worker takes, and what it gives back when a task has ended.

Spark keeps workers for later tasks, of other stages too, and each keeps the memory
it once took. Stages that load much call ``tidy`` at the end of a task. Threads of a
library keep memory of their own that ``tidy`` does not reach, and a task has one core.
"""

from __future__ import annotations

import ctypes
import gc
import os

import pyarrow as pa


def one_thread() -> None:
    """Let the tokenizers library work in the task's own thread, unless the environment says otherwise."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def tidy() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass
