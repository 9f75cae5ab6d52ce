"""Results that a worker process keeps from batch to batch."""

from __future__ import annotations

from collections.abc import Callable


class Remembered(dict):
    """Results of a function. When there are more than `size`, those used since the last time are
    kept and the others forgotten."""

    def __init__(self, of: Callable, size: int):
        super().__init__()
        self.of, self.size = of, size
        self.older: dict = {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.of(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


_KEPT: dict[str, tuple[object, object]] = {}


def per_process(name: str, sent, make: Callable):
    """What `make` makes of a broadcast value, once per worker process and value."""
    value = sent.value
    kept = _KEPT.get(name)
    if kept is None or kept[0] is not value:
        kept = _KEPT[name] = (value, make(value))
    return kept[1]
