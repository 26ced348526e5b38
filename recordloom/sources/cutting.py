"""Records of large text files whose ends can only be told from all that stands before them.

A line break inside quotes ends no CSV row, and a comma inside a string or an inner list ends no element of a JSON
array. Files are read in splits all the same: Spark's text source cuts each split into pieces at the separator, and
what stands before a split is told by a scan in two levels. Each split is summed up as a function: from either
mode it may begin in (outside or inside quotes), the mode and depth it ends in and the records that end in it. These
functions, one narrow row per split, are put one after the other per file, which says where each split begins. Then
every split is cut on its own; only records that reach over the edge of a split are put together in a shuffle.
"""

from __future__ import annotations

import csv
import hashlib
import io
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.session import new_work_dir, written

# The cutting goes to the executors as it is.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Splits that are sent to every task; beyond that number lines are joined with them by a shuffle.
BROADCAST_SPLITS = 100_000

#: Depths that are counted before counts of the same depth are added up.
MOST_COUNTS = 1 << 18

SPLITS = "file string, block long, modes array<int>, depths array<long>, ends array<binary>, first string"
ENTRIES = "file string, block long, mode int, depth long, ends_open boolean, head long, names array<string>, crlf boolean"
PARTS = "file string, block long, head long, number long, whole boolean, last boolean, text string"


@dataclass(frozen=True)
class Effect:
    """What each of some pieces does, from mode 0 and from mode 1: the mode behind it and the change of depth."""

    modes: tuple[np.ndarray, np.ndarray]
    depths: tuple[np.ndarray, np.ndarray]

    def run(self, mode: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Mode and depth behind every piece, from what is before the first."""
        zero, one = (m.astype(np.int64) for m in self.modes)
        n = len(zero)
        settles = zero == one  # such a piece ends in one mode, wherever it began
        swaps = np.cumsum((zero == 1) & (one == 0))
        last = np.maximum.accumulate(np.where(settles, np.arange(n), -1))
        since = swaps - np.where(last >= 0, swaps[last], 0)
        after = np.where(last >= 0, zero[last], mode) ^ (since & 1)
        before = np.append(mode, after[:-1])
        return after, depth + np.cumsum(np.where(before == 0, *self.depths))


def _no_depth(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(n, np.int64), np.zeros(n, np.int64)


@dataclass(frozen=True)
class CsvRows:
    """Lines of CSV: mode 1 is inside a quoted value. A quote inside an unquoted value is a character like others."""

    sep: str = ","
    quote: str = '"'
    separator: str = "\n"
    level: int = 0

    def effect(self, pieces: pa.Array) -> Effect:
        n = len(pieces)
        modes = np.zeros(n, np.int8), np.ones(n, np.int8)
        some = pc.match_substring(pieces, self.quote).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(some).tolist():
            line = pieces[i].as_py()
            modes[0][i], modes[1][i] = self._opens(line, 0), self._leaves_open(line)
        return Effect(modes, _no_depth(n))

    def _opens(self, line: str, at: int) -> bool:
        """Whether a value is open behind a line, from a place where a value begins."""
        q, s = re.escape(self.quote), re.escape(self.sep)
        return re.compile(f"(?s)(?:(?:[^{q}{s}][^{s}]*+|{q}(?:[^{q}]|{q}{q})*+{q}[^{s}]*+)?+{s})*+{q}(?:[^{q}]|{q}{q})*+").fullmatch(line, at) is not None

    def _leaves_open(self, line: str) -> bool:
        """Whether a value is open behind a line that begins inside one."""
        q = re.escape(self.quote)
        end = re.compile(f"(?s)(?:[^{q}]|{q}{q})*+").match(line).end()
        if end == len(line):
            return True
        following = line.find(self.sep, end + 1)
        return following >= 0 and self._opens(line, following + 1)

    def counts(self, pieces: pa.Array, before: np.ndarray) -> np.ndarray:
        """Which pieces count if a record ends with them: empty lines outside quotes are no rows."""
        blank = pc.is_in(pieces, pa.array(["", "\r"], pieces.type)).to_numpy(zero_copy_only=False)
        return ~(blank & (before == 0))

    def names(self, first: str | None) -> list[str] | None:
        """Column names in a header, made distinct as Spark's CSV reader does."""
        if first is None:
            return None
        lines = csv.reader(io.StringIO(first.strip("\r\n"), newline=""), delimiter=self.sep, quotechar=self.quote, doublequote=True)
        found = next(lines, [])
        often = [name.lower() for name in found]
        return [f"_c{i}" if not name else f"{name}{i}" if often.count(name.lower()) > 1 else name for i, name in enumerate(found)]


@dataclass(frozen=True)
class JsonElements:
    """Pieces of one JSON array per file, cut at commas: mode 1 is inside a string, elements end at depth 1 or 0."""

    separator: str = ","
    level: int = 1

    def effect(self, pieces: pa.Array) -> Effect:
        plain = pc.replace_substring_regex(pieces, r"(?s)\\.", "")
        odd = pc.count_substring(plain, '"').to_numpy(zero_copy_only=False) % 2
        begun = pc.replace_substring_regex(plain, r'(?s)^[^"]*"?', "")  # from inside a string: what follows it
        return Effect((odd, 1 - odd), (self._depth(plain), self._depth(begun)))

    def _depth(self, pieces: pa.Array) -> np.ndarray:
        outside = pc.replace_substring_regex(pieces, r'(?s)"[^"]*(?:"|$)', "")
        up, down = (pc.count_substring_regex(outside, p).to_numpy(zero_copy_only=False).astype(np.int64) for p in (r"[\[{]", r"[\]}]"))
        return up - down

    def counts(self, pieces: pa.Array, before: np.ndarray) -> np.ndarray:
        return np.ones(len(pieces), bool)

    def names(self, first: str | None) -> None:
        return None


def pieces_of(spark: SparkSession, paths: str | Sequence[str], cutter, file, options: dict[str, str] | None) -> DataFrame:
    """``(file, block, value)``: pieces in the order they stand in, each in the split it begins in."""
    read = spark.read.options(**(options or {})).option("lineSep", cutter.separator).text([paths] if isinstance(paths, str) else list(paths))
    return read.select(file.alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches cut where another split begins."""
    for batch in batches:
        if not batch.num_rows:
            continue
        # splits of one task follow each other; the number of a split changes with its file or place
        file = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        block = batch.column("block").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
            part = batch.slice(start, stop - start)
            yield (part.column("file")[0].as_py(), int(block[start])), part


class Ends:
    """How many records end at each depth. From the wrong mode depths may drift as far as there are records."""

    def __init__(self, depths: np.ndarray | None = None, counts: np.ndarray | None = None):
        none = np.zeros(0, np.int64)
        self.added = [(none if depths is None else depths, none if counts is None else counts)]
        self.size = len(self.added[0][0])
        self.limit = MOST_COUNTS

    def add(self, depths: np.ndarray) -> None:
        self.added.append(np.unique(depths, return_counts=True))
        self.size += len(self.added[-1][0])
        if self.size > self.limit:
            self._add_up()
            self.limit = self.size + max(self.size, MOST_COUNTS)

    def _add_up(self) -> tuple[np.ndarray, np.ndarray]:
        every, counts = (np.concatenate(x) for x in zip(*self.added, strict=True))
        depths, place = np.unique(every, return_inverse=True)
        totals = np.zeros(len(depths), np.int64)
        np.add.at(totals, place, counts)
        self.added, self.size = [(depths, totals)], len(depths)
        return depths, totals

    def packed(self) -> bytes:
        return np.concatenate(self._add_up()).astype("<i8").tobytes()

    @staticmethod
    def up_to(packed: bytes, depth: int) -> int:
        """Records that end at ``depth`` or below."""
        depths, counts = np.frombuffer(packed, "<i8").reshape(2, -1)
        return int(counts[: np.searchsorted(depths, depth, side="right")].sum())


def _summed_up(cutter):
    """A row per split: what it does from either mode."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, modes, depths, ends, first, open_first = None, [0, 1], [0, 0], [Ends(), Ends()], [], True

        def summary() -> Iterator[pa.RecordBatch]:
            if split is not None:
                header = cutter.separator.join(first) if first and not open_first else None
                row = {"file": split[0], "block": split[1], "modes": modes, "depths": depths, "ends": [e.packed() for e in ends], "first": header}
                yield from pa.Table.from_pylist([row], _ARROW_SPLITS).to_batches()

        for own, batch in _by_split(batches):
            if own != split:
                yield from summary()
                split, modes, depths, ends, first, open_first = own, [0, 1], [0, 0], [Ends(), Ends()], [], True
            pieces = batch.column("value")
            effect = cutter.effect(pieces)
            for m in (0, 1):
                after, depth = effect.run(modes[m], depths[m])
                counted = (after == 0) & cutter.counts(pieces, np.append(modes[m], after[:-1]))
                if m == 0 and own[1] == 0 and cutter.level == 0 and open_first:
                    stop = np.flatnonzero(counted)
                    first += pieces.slice(0, int(stop[0]) + 1 if len(stop) else len(pieces)).to_pylist()
                    open_first = not len(stop)
                ends[m].add(depth[counted])
                modes[m], depths[m] = int(after[-1]), int(depth[-1])
        yield from summary()

    return run


_ARROW_ENTRIES = pa.schema(
    [
        ("file", pa.string()),
        ("block", pa.int64()),
        ("mode", pa.int32()),
        ("depth", pa.int64()),
        ("ends_open", pa.bool_()),
        ("head", pa.int64()),
        ("names", pa.list_(pa.string())),
        ("crlf", pa.bool_()),
    ]
)

_ARROW_SPLITS = pa.schema(
    [
        ("file", pa.string()),
        ("block", pa.int64()),
        ("modes", pa.list_(pa.int32())),
        ("depths", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.binary())),
        ("first", pa.string()),
    ]
)


def _put_together(cutter):
    """In which mode and at which depth each split of a file begins."""

    def run(splits: pa.Table) -> pa.Table:
        mode, depth, rows = 0, 0, []
        ordered = splits.sort_by("block").to_pylist()
        names = cutter.names(ordered[0]["first"]) if ordered[0]["block"] == 0 else None
        # as whole files are read: line ends are what the first one is
        crlf = bool(names) and ordered[0]["first"].split("\n")[0].endswith("\r")
        told = "\n".join([str(crlf), *(names or [])]).encode()
        head = int.from_bytes(hashlib.blake2b(told, digest_size=8).digest(), "big", signed=True) if names else 0
        for split in ordered:
            entry = {"file": split["file"], "block": split["block"], "mode": mode, "depth": depth, "head": head}
            mode, depth = split["modes"][mode], depth + split["depths"][mode]
            ends_open = mode == 1 or depth > cutter.level
            rows.append(entry | {"ends_open": ends_open, "names": names if split["block"] == 0 else None, "crlf": crlf})
        return pa.Table.from_pylist(rows, _ARROW_ENTRIES)

    return run


def _counted(cutter):
    """How many records end in each split, from where it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = zip(batch.column("packed"), batch.column("depth").to_pylist(), strict=True)
            counts = [Ends.up_to(packed.as_py(), cutter.level - depth) for packed, depth in at]
            kept = [name for name in batch.schema.names if name != "packed"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(counts, pa.int64())], names=[*kept, "n"])

    return run


def _cut(cutter):
    """Records and parts of records of each split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        mode = depth = number = head = 0
        held: list[str] = []
        whole = True

        def left_over() -> Iterator[pa.RecordBatch]:
            if split is not None and held:
                yield table([(number, False, False, cutter.separator.join(held))])

        def table(rows: list[tuple[int, bool, bool, str]]) -> pa.RecordBatch:
            n = len(rows)
            numbers, complete, last, texts = zip(*rows, strict=True)
            columns = [pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n), pa.array([head] * n), pa.array(numbers)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(complete), pa.array(last), pa.array(texts, pa.string())], names=["file", "block", "head", "number", "whole", "last", "text"])

        for own, batch in _by_split(batches):
            if own != split:
                yield from left_over()
                mode, depth, number, head = (batch.column(c)[0].as_py() for c in ("mode", "depth", "base", "head"))
                split, held, whole = own, [], mode == 0 and depth <= cutter.level
            pieces = batch.column("value")
            after, depths = cutter.effect(pieces).run(mode, depth)
            counted = cutter.counts(pieces, np.append(mode, after[:-1]))
            ended = np.flatnonzero((after == 0) & (depths <= cutter.level))
            texts, rows, start = pieces.to_pylist(), [], 0
            for stop in ended.tolist():
                if counted[stop] or held:
                    rows.append((number, whole, bool(depths[stop] < 1), cutter.separator.join([*held, *texts[start : stop + 1]])))
                    number += 1
                held, whole, start = [], True, stop + 1
            held += texts[start:]
            mode, depth = int(after[-1]), int(depths[-1])
            if rows:
                yield table(rows)
        yield from left_over()

    return run


def records(lines: DataFrame, cutter) -> tuple[DataFrame, DataFrame]:
    """``(file, head, number, last, text)`` of all records, numbered per file from 0, and the table of splits.

    ``head`` tells headers apart; ``last`` says that a record closes its file's array.
    """
    spark = lines.sparkSession
    summed = lines.mapInArrow(_summed_up(cutter), SPLITS).repartition("file", "block")
    summed = written(summed, new_work_dir(spark, "summed"))
    # a narrow row per split tells where it begins; no task holds the counts of all splits of a file
    begun = summed.drop("ends").groupBy("file").applyInArrow(_put_together(cutter), ENTRIES)
    own = summed.select("file", "block", "ends").join(begun, ["file", "block"])
    counted = own.select(*begun.columns, F.get("ends", "mode").alias("packed")).mapInArrow(_counted(cutter), f"{ENTRIES}, n long")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.select(*begun.columns, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    splits = written(placed, new_work_dir(spark, "splits"))
    seen = splits.agg(F.count(F.lit(1)).alias("n"), F.max("ends_open").alias("open")).first()
    entries = splits.select("file", "block", "mode", "depth", "base", "head")
    if seen.n <= BROADCAST_SPLITS:
        placed = lines.join(F.broadcast(entries), ["file", "block"])
    else:
        ordered = lines.withColumn("__at", F.monotonically_increasing_id())
        placed = ordered.join(entries, ["file", "block"]).sortWithinPartitions("file", "block", "__at").drop("__at")
    parts = placed.mapInArrow(_cut(cutter), PARTS)
    found = parts.where("whole").select("file", "head", "number", "last", "text") if seen.open else parts.select("file", "head", "number", "last", "text")
    if seen.open:  # else no record reaches over an edge, and no part needs another
        pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"])
        joined = parts.where("NOT whole").groupBy("file", "number").agg(
            F.first("head").alias("head"), F.max("last").alias("last"), F.array_join(pieces, cutter.separator).alias("text")
        )
        found = found.unionByName(joined.select(found.columns))
    return found, splits
