"""Encoding of texts by their distinct stretches, each encoded once by a worker and then looked up."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from recordloom.llm.arrays import U64, mix, ragged, window_sums

#: One random 64-bit number per byte value, twice: two numbers known of a long stretch make 120 bits.
_SEEDS = [mix(np.arange(1 + 256 * i, 257 + 256 * i, dtype=U64) * U64(0x9E3779B97F4A7C15)) for i in (0, 1)]
#: Bytes of a stretch that its two numbers hold as they are, with its length in the last byte; and masks by length.
SHORT = 15
_LOW, _HIGH = (np.array([(1 << 8 * min(max(n - at, 0), 8)) - 1 for n in range(SHORT + 1)], U64) for at in (0, 8))

Learn = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def _numbers(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers of each stretch: of up to SHORT bytes no two have the same."""
    padded = np.append(raw, np.zeros(16, np.uint8))
    eight = np.ndarray(len(raw) + 9, "<u8", padded, strides=(1,))  # the eight bytes from each on
    length = ends - starts
    few = np.minimum(length, SHORT)
    low, check = eight[starts] & _LOW[few], eight[starts + 8] & _HIGH[few] | length.astype(U64) << U64(56)
    long = np.flatnonzero(length > SHORT)
    if len(long):
        size = length[long]
        part, stop = raw[ragged(starts[long], size)], np.cumsum(size)
        low[long], found = (mix(window_sums(seed[part], stop - size, stop) + size.astype(U64)) for seed in _SEEDS)
        check[long] = found | U64(0xFF << 56)
    return mix(low ^ check * U64(0x9E3779B97F4A7C15)), check


class Remembered:
    """Ids of stretches of bytes, found by two 64-bit numbers (their bytes, if few); ``learn`` gives the ids of new ones and their count.

    Entries lie in a table of slots with a step to the next slot where one is taken, so that a look-up sorts nothing.
    """

    def __init__(self, learn: Learn, limit: int):
        self.learn, self.limit = learn, limit
        self.mask = U64((1 << max(10, (2 * limit).bit_length())) - 1)
        self._forget()

    def _forget(self):
        self.slots = np.full(int(self.mask) + 1, -1, np.int32)
        self.n, self.n_ids = 0, 0
        self.keys, self.checks = np.zeros(0, U64), np.zeros(0, U64)
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The entry of each stretch, -1 if there is none."""
        entry = self.slots[key & self.mask]
        if not self.n:
            return entry
        open_ = np.flatnonzero((entry >= 0) & ((self.keys[entry] != key) | (self.checks[entry] != check)))
        step = 0
        while len(open_):
            step += 1
            found = self.slots[(key[open_] + U64(step)) & self.mask]
            entry[open_] = found
            open_ = open_[(found >= 0) & ((self.keys[found] != key[open_]) | (self.checks[found] != check[open_]))]
        return entry

    def _add(self, key: np.ndarray, check: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        n, total = self.n + len(key), self.n_ids + len(ids)
        for name, more, at, end in (
            ("keys", key, self.n, n),
            ("checks", check, self.n, n),
            ("start", self.n_ids + np.cumsum(size) - size, self.n, n),
            ("size", size, self.n, n),
            ("ids", ids, self.n_ids, total),
        ):
            held = getattr(self, name)
            if len(held) < end:
                held = np.concatenate([held, np.zeros(max(end, 2 * len(held)) - len(held), held.dtype)])
                setattr(self, name, held)
            held[at:end] = more
        entries, place = np.arange(self.n, n, dtype=np.int32), key & self.mask
        while len(entries):
            free = np.flatnonzero(self.slots[place] < 0)
            slot, first = np.unique(place[free], return_index=True)
            self.slots[slot] = entries[free[first]]
            rest = np.ones(len(entries), bool)
            rest[free[first]] = False
            entries, place = entries[rest], (place[rest] + U64(1)) & self.mask
        self.n, self.n_ids = n, total

    def encode(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches in order, and how many each has."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if self.n > self.limit:
            self._forget()
        key, check = _numbers(raw, starts, ends)
        entry = self._find(key, check)
        new = np.flatnonzero(entry < 0)
        if len(new):
            order = new[np.lexsort((check[new], key[new]))]
            same = (key[order][1:] == key[order][:-1]) & (check[order][1:] == check[order][:-1])
            first = order[np.append(True, ~same)]
            # a step may bring more new stretches than are remembered: they have slots all the same
            while self.n + len(first) > len(self.slots) // 2:
                self._widen()
            data = raw.tobytes()
            self._add(key[first], check[first], *self.learn([data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]))
            entry[new] = self._find(key[new], check[new])
        return self.ids[ragged(self.start[entry], self.size[entry])], self.size[entry]

    def _widen(self) -> None:
        self.mask = U64(2 * int(self.mask) + 1)
        self.slots = np.full(int(self.mask) + 1, -1, np.int32)
        keys, checks, n = self.keys[: self.n], self.checks[: self.n], self.n
        start, size, ids = self.start[:n], self.size[:n], self.ids[: self.n_ids]
        self.n = self.n_ids = 0
        self._add(keys.copy(), checks.copy(), ids[ragged(start, size)].copy(), size.copy())
