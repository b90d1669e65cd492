"""Bounded memories and objects that live as long as a Python worker."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa

#: Entries per generation; keys longer than ``LONGEST_KEPT`` are encoded each time.
KEPT = 150_000
LONGEST_KEPT = 100

_workers: dict[str, tuple[object, object]] = {}


def per_worker(kind: str, key: object, build: Callable[[], object]) -> object:
    """An object made once in a Python worker; of each ``kind`` only the last one is held."""
    if kind not in _workers or _workers[kind][0] != key:
        _workers.pop(kind, None)
        _workers[kind] = (key, build())
    return _workers[kind][1]


def forget() -> None:
    """Drop what other operators hold in this worker."""
    _workers.clear()


def give_back() -> None:
    """Hand freed memory back to the system, since workers live on between tasks and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that gives memory back at its end."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


class Memory:
    """Values of keys, remembered in two generations; ``encode`` maps a list of new keys to their values."""

    def __init__(self, encode: Callable[[list], list], kept: int = KEPT):
        self.encode, self.kept = encode, kept
        self.young: dict[Hashable, object] = {}
        self.old: dict[Hashable, object] = {}

    def values(self, lists: list[list]) -> list[list]:
        """The values of each list of keys."""
        if len(self.young) > self.kept:
            self.old, self.young = self.young, {}
        get = self.young.get
        found = [list(map(get, keys)) for keys in lists]
        short = [i for i, values in enumerate(found) if None in values]
        missing = {k for i in short for k, v in zip(lists[i], found[i], strict=True) if v is None}
        if missing:
            new = {k: self.old[k] for k in missing if k in self.old}
            asked = [k for k in missing if k not in new]
            new.update(zip(asked, self.encode(asked), strict=True))
            self.young.update((k, v) for k, v in new.items() if len(k) <= LONGEST_KEPT)
            for i in short:
                found[i] = [new[k] if v is None else v for k, v in zip(lists[i], found[i], strict=True)]
        return found
