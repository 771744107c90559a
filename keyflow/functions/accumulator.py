"""User-supplied accumulators, for folds that are no built-in aggregate."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any


class Accumulator:
    """Folds the rows of a key into a state.

    ``merge(early, late)`` must give what adding late's rows to early would have given. It lets the
    rows of one key be folded in several tasks.
    """

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, state: Any, row: tuple) -> Any:
        raise NotImplementedError

    def merge(self, early: Any, late: Any) -> Any:
        raise NotImplementedError

    def result(self, state: Any) -> Any:
        return state


class Reduce(Accumulator):
    """Folds single values with an associative function; the first value is taken as it is."""

    def __init__(self, function: Callable[[Any, Any], Any]):
        self.function = function

    def create(self):
        return None

    def add(self, state, row):
        return row[0] if state is None else self.function(state, row[0])

    def merge(self, early, late):
        if early is None or late is None:
            return late if early is None else early
        return self.function(early, late)


class LevelCounts(Accumulator):
    """How often each level occurred, written as ``level=count`` in level order."""

    def create(self):
        return {}

    def add(self, state, row):
        level = row[0] or 0
        state[level] = state.get(level, 0) + 1
        return state

    def merge(self, early, late):
        for level, n in late.items():
            early[level] = early.get(level, 0) + n
        return early

    def result(self, state):
        return ",".join(f"{level}={n}" for level, n in sorted(state.items()))


class Mean(Accumulator):
    """Mean of the values, kept as sum and count."""

    def create(self):
        return (0, 0)

    def add(self, state, row):
        return (state[0] + (row[0] or 0), state[1] + 1)

    def merge(self, early, late):
        return (early[0] + late[0], early[1] + late[1])

    def result(self, state):
        return state[0] / state[1] if state[1] else None
