"""A minimal acyclic transducer from terms to their places in sorted order.

Built from sorted terms one after another: the suffix of the last term that the next one does not share is final, and
a state that equals an earlier one in its end mark and arcs is replaced by that one. An arc's output is the number of terms that sort
before those behind it, so the outputs on a term's path add up to its place. Terms are looked up many at a time.
"""

from __future__ import annotations

import numpy as np


class Builder:
    """Takes terms in ascending order of their bytes, each once."""

    def __init__(self):
        self._known: dict[tuple, int] = {}  # a finished state's end mark and arcs -> its number
        self._terms: list[int] = []  # terms behind a finished state, itself included
        self._path: list[list] = [[False, []]]  # states of the last term: end mark and arcs of (byte, finished state)
        self._last = b""
        self.size = 0

    def add(self, term: bytes) -> None:
        last, shared = self._last, 0
        if self.size and term <= last:
            raise ValueError("terms must ascend")
        limit = min(len(last), len(term))
        while shared < limit and last[shared] == term[shared]:
            shared += 1
        self._finish(shared)
        self._path += [[False, []] for _ in range(len(term) - shared)]
        self._path[-1][0] = True
        self._last = term
        self.size += 1

    def _state(self, ends: bool, arcs: list[tuple[int, int]]) -> int:
        key = (ends, *arcs)
        number = self._known.get(key)
        if number is None:
            number = self._known[key] = len(self._terms)
            self._terms.append(ends + sum(self._terms[target] for _, target in arcs))
        return number

    def _finish(self, depth: int) -> None:
        """Finish the states of the last term below `depth`."""
        for at in range(len(self._last), depth, -1):
            state = self._state(*self._path.pop())
            self._path[-1][1].append((self._last[at - 1], state))

    def build(self) -> Transducer:
        self._finish(0)
        root = self._state(*self._path[0])
        keys, targets, outputs = [], [], []
        ends = np.zeros(len(self._terms), bool)
        for number, (end, *arcs) in enumerate(self._known):
            ends[number] = end
            before = int(end)
            for byte, target in arcs:
                keys.append(number << 8 | byte)
                targets.append(target)
                outputs.append(before)
                before += self._terms[target]
        return Transducer(root, ends, *(np.array(x, np.int64) for x in (keys, targets, outputs)))


class Transducer:
    """`keys` are state and byte of all arcs, ascending; `targets` and `outputs` belong to them."""

    def __init__(self, root: int, ends: np.ndarray, keys: np.ndarray, targets: np.ndarray, outputs: np.ndarray):
        self.root, self.ends, self.keys, self.targets, self.outputs = root, ends, keys, targets, outputs

    @property
    def states(self) -> int:
        return len(self.ends)

    def places(self, raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The place of each span of bytes among the terms, -1 for one that is no term."""
        found = np.full(len(starts), -1, np.int64)
        open_ = np.arange(len(starts))
        state = np.full(len(starts), self.root, np.int64)
        place = np.zeros(len(starts), np.int64)
        at = np.asarray(starts, np.int64)
        while len(open_):
            over = at == stops[open_]
            done = over & self.ends[state]
            found[open_[done]] = place[done]
            open_, state, place, at = (x[~over] for x in (open_, state, place, at))
            if not len(open_) or not len(self.keys):
                break
            key = state << 8 | raw[at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes = self.keys[arc] == key
            arc = arc[goes]
            open_, state = open_[goes], self.targets[arc]
            place, at = place[goes] + self.outputs[arc], at[goes] + 1
        return found
