"""What a Python worker remembers within a task, bounded by bytes and given back at its end."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from inspect import signature

import pyarrow as pa

#: Bytes that one store of a worker holds before it starts anew.
STORE_BYTES = 60_000_000
#: Bytes of a dictionary entry and its objects besides their content.
ENTRY_BYTES = 250


class Room:
    """Counts what is put into some dictionaries and empties them all before they grow too large."""

    def __init__(self, *stores: dict, most: int = STORE_BYTES):
        self.stores, self.most, self.held = stores, most, 0

    def take(self, entries: int, content: int) -> bool:
        """Make room for new entries; true, and nothing taken, if everything was dropped for it."""
        need = entries * ENTRY_BYTES + content
        if self.held and self.held + need > self.most:
            self.clear()
            return True
        self.held += need
        return False

    def clear(self) -> None:
        for store in self.stores:
            store.clear()
        self.held = 0


def give_back(collect: bool = True) -> None:
    """Return free memory of Python, Arrow and the C library to the system, where that can be done."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def within_task(run: Callable[[Iterator], Iterator], *rooms: Room) -> Callable[[Iterator], Iterator]:
    """The same function over batches; when it ends the rooms are emptied and memory is given back."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            for room in rooms:
                room.clear()
            give_back()

    return wrapped


def within_group(run: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """The same function over a group's table, or two; what it needed in between is given back after it."""

    def one(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back(collect=False)

    def two(table: pa.Table, other: pa.Table) -> pa.Table:
        try:
            return run(table, other)
        finally:
            give_back(collect=False)

    # Spark looks at the number of parameters.
    return two if len(signature(run).parameters) == 2 else one
