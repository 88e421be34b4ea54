"""What a Python worker keeps from one task to the next: the words of one step at a time.

Spark hands a worker from task to task and from query to query. What one step remembers is
thus held while the next one runs, beside all that this one needs, unless it is let go.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable

import pyarrow as pa

_KEPT: dict[Hashable, object] = {}


def keep(key: Hashable, make: Callable[[], object]):
    """What `make` gave for `key` in an earlier task of this worker, or gives now; what was kept
    under another key is let go first."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """For steps that remember nothing: let go what others have kept."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()
