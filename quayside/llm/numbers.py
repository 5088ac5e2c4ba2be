"""Arrays of whole numbers: hashing, lookups and gathering of runs."""

from __future__ import annotations

import numpy as np

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.int64(-(2**63))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly (the splitmix64 finaliser)."""
    x = values.astype(np.uint64) + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of all runs, one run after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Lookup:
    """Values of whole-number keys by open addressing, for many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default):
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.mask = size - 1
        self.keys = np.full(size + 1, EMPTY)
        self.values = np.full(size + 1, default, dtype=values.dtype)
        self.default = default
        keys = keys.astype(np.int64)
        places = self._home(keys)
        waiting = np.arange(len(keys))
        while len(waiting):
            at = places[waiting]
            free = self.keys[at] == EMPTY
            _, first = np.unique(at, return_index=True)
            put = np.zeros(len(waiting), bool)
            put[first] = True
            put &= free
            self.keys[at[put]] = keys[waiting[put]]
            self.values[at[put]] = values[waiting[put]]
            waiting = waiting[~put]
            places[waiting] = (places[waiting] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * GOLDEN) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        places = self._home(keys)
        there = self.keys[places]
        out = self.values[places]
        out[there != keys] = self.default
        open_ = np.flatnonzero((there != keys) & (there != EMPTY))
        while len(open_):
            places[open_] = (places[open_] + 1) & self.mask
            there = self.keys[places[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[places[open_[hit]]]
            open_ = open_[~hit & (there != EMPTY)]
        return out
