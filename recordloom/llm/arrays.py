"""Texts of an Arrow batch as flat byte and word arrays, and small helpers the operators share."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text that one step looks at; bounds the memory of a task whatever the batch holds.
STEP_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15
_STEP = U64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for; a copy sent elsewhere starts empty."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def __reduce__(self):
        return (_Powers, ())

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, min(2 * len(self.up), STEP_BYTES + 1))
            up, down = np.full(size, _BASE, U64), np.full(size, pow(_BASE, -1, 1 << 64), U64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
        return self.up, self.down


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def per_worker(key: Hashable, make: Callable):
    """An object that a worker process keeps from task to task; of different keys only the last is kept.

    It lives in a module of its own, as functions sent by value bring new globals with each task.
    """
    state = vars(sys.modules.setdefault("recordloom_worker", types.ModuleType("recordloom_worker")))
    if state.get("key") != key:
        forget()  # the old one goes before the new one is made
        state["kept"] = make()
        state["key"] = key
    return state["kept"]


def forget() -> None:
    """Drop what the worker process keeps from task to task."""
    state = vars(sys.modules.get("recordloom_worker", types.ModuleType("recordloom_worker")))
    if state.get("kept") is not None:
        state["key"] = state["kept"] = None
        give_back()


def give_back() -> None:
    """Let memory that was freed go back to the system: a worker that waits for its next task should hold little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and where each begins (and the last ends); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def steps(batches: Iterable[pa.RecordBatch], text: str, most: int = STEP_BYTES, *, keeps: bool = False) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``most`` bytes of text, or one row; freed memory goes back after each batch.

    Unless the task ``keeps`` an object of its own (:func:`per_worker`), what another operator kept goes first.
    """
    if not keeps:
        forget()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).cumsum()
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch, size
        give_back()


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, … (count[0] of them), first[1], …"""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.cumsum(count) - count
    return np.arange(total) - np.repeat(shift - first, count)


class Words:
    """Words of some texts: runs of digits, ASCII letters (lower-cased) and all characters beyond ASCII."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = raw, offsets
        self.lower = _LOWER[raw]
        word = _IS_WORD[raw]
        begins, stops = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        stops[:-1] &= ~word[1:]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]  # a word ends with its text
        begins[heads] = word[heads]
        tails = heads[1:] - 1
        stops[tails] = word[tails]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        """A 64-bit number for each word, the same wherever the word stands."""
        if self._hashes is None:
            self._hashes = self.spans(self.starts, self.ends)
        return self._hashes

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit number for each stretch of lower-cased bytes."""
        if not len(starts):
            return np.zeros(0, U64)
        if not hasattr(self, "_sums"):
            up, _ = _powers.first(len(self.lower) + 1)
            self._sums = np.zeros(len(self.lower) + 1, U64)
            np.cumsum((self.lower.astype(U64) + U64(1)) * up[: len(self.lower)], out=self._sums[1:])
        _, down = _powers.first(len(self.lower) + 1)
        return mix((self._sums[ends] - self._sums[starts]) * down[starts] + (ends - starts).astype(U64) * _STEP)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All runs of ``width`` words within one text: first word, number of the text, 64-bit number."""
        count = np.maximum(self.counts - width + 1, 0)
        at = ragged(self.first[:-1], count)
        number = np.zeros(max(len(self.starts) - width + 1, 0), U64)
        for k in range(width):
            number = number * U64(_BASE) + self.hashes[k : k + len(number)]
        return at, np.repeat(np.arange(len(count)), count), mix(number[at] + U64(width))

    def whole(self, texts: np.ndarray, salt: int = 0) -> np.ndarray:
        """A 64-bit number for the word sequence of each of the named texts (those with words)."""
        count = self.counts[texts]
        order = ragged(np.zeros(len(texts), np.int64), count).astype(U64)
        values = mix(self.hashes[ragged(self.first[texts], count)] + mix(order + U64(salt)))
        return mix(np.add.reduceat(values, np.cumsum(count) - count) + count.astype(U64)) if len(texts) else np.zeros(0, U64)


def window_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each stretch of 64-bit values, the same wherever the stretch begins."""
    up, down = _powers.first(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def characters(raw: np.ndarray) -> np.ndarray:
    """For each byte position, how many characters begin before it."""
    out = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=out[1:])
    return out


def without(frame: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the columns that a result column of the same name (in any case) will replace."""
    taken = {n.lower() for n in names}
    return frame.select([F.col(f"`{c}`") for c in frame.columns if c.lower() not in taken])


def row_key(id_column: str, text_column: str) -> Column:
    """Tells apart rows that share an id: a number from id and text."""
    return F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text_column}`"))
