"""What Python workers keep from task to task: bounded caches, of one operator at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any


class Memo(dict):
    """``memo[key]`` is ``compute(key)``.  When ``most`` keys are held they become the old generation, from which keys
    still in use move over; keys longer than ``longest`` characters are never held."""

    def __init__(self, compute: Callable[[str], Any], most: int = 150_000, longest: int = 48):
        super().__init__()
        self.compute, self.most, self.longest = compute, most, longest
        self.old: dict = {}

    def __missing__(self, key: str) -> Any:
        if (value := self.old.get(key)) is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                super().clear()
            self[key] = value
        return value

    def clear(self) -> None:
        super().clear()
        self.old = {}


_CACHES: dict[str, list[dict]] = {}
_USER = ""


def kept_for(operator: str, cache: dict) -> dict:
    """The cache, which ``use`` of another operator empties."""
    _CACHES.setdefault(operator, []).append(cache)
    return cache


def use(operator: str) -> None:
    """Call at the start of an operator's work in a task: workers are reused, and what another operator has left there
    would add to this one's memory."""
    global _USER
    if operator == _USER:
        return
    _USER = operator
    for other, caches in _CACHES.items():
        if other != operator:
            for c in caches:
                c.clear()
    gc.collect()
    try:
        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass
