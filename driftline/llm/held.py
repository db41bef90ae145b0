"""What a Python worker keeps from task to task: the tables of one operator at a time.

Workers outlive the stages of a job. Encoders, hashed words and the like are kept
as long as tasks of one kind follow each other, and let go when another kind begins.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

_kind: str | None = None
_clear: list[Callable[[], None]] = []


def only(kind: str, clear: Callable[[], None]) -> None:
    """From here on this worker keeps the tables of ``kind``, which ``clear`` lets go; those of another kind go now."""
    global _kind
    if kind == _kind:
        return
    for let_go in _clear:
        let_go()
    _kind, _clear[:] = kind, [clear]
    gc.collect()
    try:
        # Freed memory goes back to the system, where the C library can do that.
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass
