"""Objects that a Python worker keeps between the tasks of a stage, and gives back afterwards."""

from __future__ import annotations

import ctypes
import functools
import gc
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa

#: Seconds without a task after which a worker drops what it keeps.
IDLE_SECONDS = 2.0

_kept: dict[object, object] = {}
_used = 0
_timer: threading.Timer | None = None
_lock = threading.Lock()


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # not glibc: its own allocator decides
    _trim = None


def give_back() -> None:
    """Returns freed memory to the system: workers outlive tasks, and what they hold on to the executor lacks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def lean(run: Callable) -> Callable:
    """A task's function over batches that gives freed memory back at its end."""
    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole


def _drop() -> None:
    with _lock:
        if _used == 0:
            _kept.clear()
            gc.collect()
            give_back()


@contextmanager
def kept(key: object, make: Callable[[], object]) -> Iterator[object]:
    """What ``make`` returned for ``key`` the first time, made anew after an idle spell.

    Workers outlive stages, so a cache that simply stayed would take its memory from
    whatever runs next.
    """
    global _used, _timer
    with _lock:
        if _timer is not None:
            _timer.cancel()
            _timer = None
        _used += 1
        if key not in _kept:
            _kept[key] = make()
        own = _kept[key]
    try:
        yield own
    finally:
        with _lock:
            _used -= 1
            if _used == 0:
                _timer = threading.Timer(IDLE_SECONDS, _drop)
                _timer.daemon = True
                _timer.start()
