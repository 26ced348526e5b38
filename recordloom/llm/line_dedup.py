"""Substring dedup by hashing lines, paragraphs or sentences, and runs of words.

Texts are cut into units; a unit is known by the digest of its words (case, punctuation and spacing do not count).
So is every run of ``passage_words`` words, wherever it begins, since copied passages need neither begin nor end with
a unit. Digests are grouped over all documents and the earliest occurrence stays: that of the smallest id, then of
the smallest row key, then the first in the text. The words of later occurrences go if they form a stretch of at
least ``min_words`` words, so that passages and blocks of lines are caught while a short phrase that documents share
by chance stays in its place. Units without words belong to no stretch and do not break one.

How passages are found without grouping each of them with its place: an anchor is a run of a little over half as many
words; the smallest anchor of a passage comes with it wherever it occurs. Anchors that occur more than once are
grouped, and so are spread passages (the smallest of ``passage_words`` passages in a row) around them. What spread
passages cover that occurred earlier needs no further search, and a passage whose smallest anchor did not occur
earlier did not either. What is left, mostly at the ends of copies, is grouped wherever it occurs. From pass to pass
go tables of bits of bounded size; a bit set by chance costs rows and changes no result.

``unit`` is ``"line"``, ``"paragraph"`` (cut at blank lines) or ``"sentence"`` (lines cut further after ``.``,
``!`` and ``?``), the default. Runs of words are sought with ``passage_words``, by default 25 if the unit is the
sentence, else not; 0 seeks none.

Defined results: null and empty texts stay as they are. A null id ranks first. Rows with the same id and text
are one document: what one of them keeps, all keep. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.arrays import U64, Words, characters, mix, ragged, row_key, steps, utf8, window_sums, without
from recordloom.session import new_work_dir, written

SPANS = "array<struct<start:int,stop:int,chars:int>>"
UNITS = ("line", "paragraph", "sentence")
ID, KEY, AGAIN = "__id", "__row_key", "__again"
#: Places from here on are first words of passages or anchors, smaller ones are units.
PASSAGES, ANCHORS = 1 << 40, 1 << 41
#: Bits of the table for each digest that occurs more than once, and the size (a power of 2) of the largest table.
BITS_EACH, MOST_BITS = 16, 28
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SALTS = (0, 0x5BD1E995)
_END = np.zeros(256, bool)
_END[[33, 46, 63]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def unit_starts(raw: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """Byte positions where a unit begins: with each text, and behind each separator and the space after it."""
    if not len(raw):
        return np.zeros(0, np.int64)
    space = _SPACE[raw]
    line = raw == 10
    if unit == "line":
        cut = line
    elif unit == "paragraph":
        cut = np.zeros(len(raw), bool)
        cut[1:] = line[1:] & line[:-1]
    else:
        cut = line.copy()
        cut[1:] |= space[1:] & _END[raw[:-1]]
    # a unit begins at the first byte that is no space after a cut
    last_cut = np.maximum.accumulate(np.where(cut, np.arange(len(raw)), -1))
    last_solid = np.maximum.accumulate(np.where(~space, np.arange(len(raw)), -1))
    begin = np.zeros(len(raw), bool)
    begin[1:] = ~space[1:] & (last_cut[:-1] > last_solid[:-1])
    begin[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begin)


class Units:
    """Units of some texts that hold words: byte range, text, place in the text, number of words, digest."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, unit: str):
        starts = unit_starts(raw, offsets, unit)
        words = Words(raw, offsets)
        stops = np.append(starts[1:], len(raw))
        text = np.searchsorted(offsets, starts, side="right") - 1
        first = np.searchsorted(words.starts, starts)
        count = np.searchsorted(words.starts, stops) - first
        some = count > 0
        self.starts, self.stops, self.text, self.count = (x[some] for x in (starts, stops, text, count))
        by_text = np.bincount(self.text, minlength=len(offsets) - 1)
        self.place = ragged(np.zeros(len(by_text), np.int64), by_text)
        self.words, self.first_word = words, first[some]

    def digest(self, salt: int) -> np.ndarray:
        at = Words.__new__(Words)  # the units as if they were texts
        at._hashes, at.first, at.counts = self.words.hashes, np.append(self.first_word, len(self.words.starts)), self.count
        return at.whole(np.arange(len(self.count)), salt)


def _runs(words: Words, starts: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A 64-bit number for each run of ``width`` words."""
    return mix(window_sums(mix(words.hashes + U64(salt)), starts, starts + width) + U64(width))


def _slide(choose: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """The least or greatest of each ``width`` neighbouring values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = choose(values[:-step], values[step:])
        done += step
    return values


def _least(number: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of ``span`` numbers from each place of ``at`` on, and which numbers are the least of one."""
    if not len(at):
        return np.zeros(0, U64), np.zeros(len(number), bool)
    least = _slide(np.minimum, number, span)
    within = np.zeros(len(least) + 2 * (span - 1), U64)
    within[at + span - 1] = least[at]
    return least[at], (number == _slide(np.maximum, within, span)) & (number > 0)


class Passages:
    """All runs of ``width`` words within one text: first word, smallest anchor; the anchors that are one."""

    def __init__(self, words: Words, width: int):
        self.words, self.width, anchor = words, width, width // 2 + 1
        self.span = width - anchor + 1
        self.at = self._within(width)
        self.number = _runs(words, np.arange(len(words.starts) - anchor + 1), anchor) if len(self.at) else np.zeros(0, U64)
        self.least, chosen = _least(self.number, self.at, self.span)
        self.anchors = np.flatnonzero(chosen)

    def _within(self, width: int) -> np.ndarray:
        return ragged(self.words.first[:-1], np.maximum(self.words.counts - width + 1, 0)) if self.width else np.zeros(0, np.int64)

    def text(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.words.first, at, side="right") - 1

    def digest(self, at: np.ndarray, salt: int) -> np.ndarray:
        return _runs(self.words, at, self.width, salt)

    def spread(self) -> np.ndarray:
        """First words of the passages that are the smallest of ``width`` in a row."""
        if not len(self.at):
            return self.at
        number = self.digest(np.arange(len(self.words.starts) - self.width + 1), 1)
        return np.flatnonzero(_least(number, self._within(2 * self.width - 1), self.width)[1])

    def named(self, keys: np.ndarray, at: np.ndarray, kind: int) -> np.ndarray:
        """A number for each place of a text known by its row key."""
        text = self.text(at)
        return _named(keys[text], at - self.words.first[text] + kind)

    def open(self, often: np.ndarray, again: np.ndarray, first: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """First words of the passages that may have occurred earlier and are not covered by spread ones that did."""
        found = self.anchors[_have(often, self.number[self.anchors])]
        found = found[_have(again, self.named(keys, found, ANCHORS))]
        number = np.full(len(self.number), U64(2**64 - 1))
        number[found] = self.number[found]
        maybe = self.at[_slide(np.minimum, number, self.span)[self.at] == self.least] if len(self.at) else self.at
        known = _some(self, often)
        known = known[~_have(first, self.named(keys, known, PASSAGES))]
        depth = np.zeros(len(self.words.starts) + 1, np.int64)
        depth[known] += 1
        depth[known + self.width] -= 1
        covered = np.append(0, (depth[:-1].cumsum() > 0).cumsum())
        return maybe[covered[maybe + self.width] - covered[maybe] < self.width]


def _some(found: Passages, often: np.ndarray) -> np.ndarray:
    """First words of the spread passages whose smallest anchor occurs more than once."""
    at = found.spread()
    return at[_have(often, found.least[np.searchsorted(found.at, at)])]


def _named(keys: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(keys.view(U64) + mix(place.astype(U64)))


def _have(table: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Which digests have their bit in the table."""
    place = number >> U64(64 - 5 - len(table).bit_length())
    return (table[place >> U64(6)] >> (place & U64(63)) & U64(1)).astype(bool)


def _settled(frame: DataFrame, path: str) -> DataFrame:
    """As ``written``, and the shuffle files of the write go with its end."""
    conf = frame.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return written(frame, path)
    finally:
        conf.set(CLEANUP, before) if before is not None else conf.unset(CLEANUP)


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a table of this module that is used no more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _bits(numbers: DataFrame):
    """A table of bits for column ``number``, on all workers."""
    spark = numbers.sparkSession
    path = new_work_dir(spark, "numbers")
    numbers = _settled(numbers, path)
    bits = min(max((BITS_EACH * numbers.count()).bit_length(), 10), MOST_BITS)
    place = F.shiftrightunsigned("number", 64 - bits)
    mask = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(number, {64 - bits}) & 63 AS int))")
    rows = numbers.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(mask).alias("mask")).toArrow()  # 2 ** (MOST_BITS - 6) rows at most
    table = np.zeros(1 << (bits - 6), U64)
    table[rows["word"].to_numpy()] = rows["mask"].to_numpy().view(U64)
    _drop(spark, path)
    return spark.sparkContext.broadcast(table)


def _numbers(rows: DataFrame, kind: int) -> DataFrame:
    """The numbers of places of a kind (PASSAGES or ANCHORS)."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = _named(*(batch.column(c).to_numpy() for c in (KEY, "place")))
            yield pa.RecordBatch.from_arrays([pa.array(number.view(np.int64))], names=["number"])

    rows = rows.where((F.col("place") >= kind) & (F.col("place") < 2 * kind)).select(KEY, "place")
    return rows.mapInArrow(name, "number long")


def _judged(rows: DataFrame, only_again: bool) -> DataFrame:
    """Places (__id, __row_key, place) and whether their digests occurred earlier (again); or only those that did."""
    spark, rank = rows.sparkSession, F.struct(ID, KEY, "place")
    path = new_work_dir(spark, "digests")
    rows = _settled(rows, path)
    first = rows.groupBy("a", "b").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(first, ["a", "b"], "inner" if only_again else "left")
    again = F.col("first").isNotNull() & ~rank.eqNullSafe(F.col("first"))
    joined = joined.select(ID, KEY, "place", again.alias("again"))
    judged = _settled(joined.where("again") if only_again else joined, new_work_dir(spark, "judged"))
    _drop(spark, path)
    return judged


def repeated_units(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", unit: str = "sentence", passage_words: int | None = None
) -> DataFrame:
    """For each document, the places of its units and passages that occurred earlier: __id, __row_key, __again (sorted).

    The place of a passage is PASSAGES and the number of words before it.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}")
    width = _width(unit, passage_words)
    read = docs.select(F.col(f"`{id_column}`").alias(ID), row_key(id_column, text_column).alias(KEY), F.col(f"`{text_column}`").alias("text"))
    schema = T.StructType(read.schema.fields[:2]).add("place", "long").add("a", "long").add("b", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            units = Units(*utf8(batch.column("text")), unit)
            found = Passages(units.words, width)
            number, n = np.unique(np.concatenate([units.digest(SALTS[0]), found.number[found.anchors]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(number.view(np.int64)), pa.array(n)], names=["number", "n"])

    counted = read.select("text").mapInArrow(count, "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
    often = _bits(counted.where("n > 1").select("number"))

    def table(batch: pa.RecordBatch, text, place, a, b) -> pa.RecordBatch:
        columns = [batch.column(ID).take(pa.array(text)), batch.column(KEY).take(pa.array(text)), *[pa.array(x.view(np.int64)) for x in (place, a, b)]]
        return pa.RecordBatch.from_arrays(columns, names=[ID, KEY, "place", "a", "b"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            units = Units(*utf8(batch.column("text")), unit)
            digest = units.digest(SALTS[0])
            some = np.flatnonzero(_have(often.value, digest))
            yield table(batch, units.text[some], units.place[some], digest[some], units.digest(SALTS[1])[some])
            found = Passages(units.words, width)
            anchors = found.anchors[_have(often.value, found.number[found.anchors])]
            spread = _some(found, often.value)
            for at, kind, a, b in (
                (anchors, ANCHORS, found.number[anchors], np.zeros(len(anchors), U64)),
                (spread, PASSAGES, found.digest(spread, 1), found.digest(spread, 2)),
            ):
                text = found.text(at)
                yield table(batch, text, at - units.words.first[text] + kind, a, b)

    judged = _judged(read.mapInArrow(cut, schema), not width)
    again = judged.where("again")
    if width:
        after, first = _bits(_numbers(again, ANCHORS)), _bits(_numbers(judged.where("NOT again"), PASSAGES))

        def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, "text"):
                found = Passages(Words(*utf8(batch.column("text"))), width)
                at = found.open(often.value, after.value, first.value, batch.column(KEY).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(found.digest(at, 1)).view(np.int64))], names=["number"])

        wanted = _bits(read.select(KEY, "text").mapInArrow(left, "number long"))

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, "text"):
                found = Passages(Words(*utf8(batch.column("text"))), width)
                at = found.at[_have(often.value, found.least)]
                digest = found.digest(at, 1)
                some = _have(wanted.value, digest)
                at = at[some]
                text = found.text(at)
                yield table(batch, text, at - found.words.first[text] + PASSAGES, digest[some], found.digest(at, 2))

        again = again.where(F.col("place") < ANCHORS).unionByName(_judged(read.mapInArrow(ends, schema), True))
    return again.groupBy(ID, KEY).agg(F.array_sort(F.collect_set("place")).alias(AGAIN))


def _width(unit: str, passage_words: int | None) -> int:
    return passage_words if passage_words is not None else 25 if unit == "sentence" else 0


def remove_repeats(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    unit: str = "sentence",
    min_words: int = 25,
    passage_words: int | None = None,
    spans_column: str | None = "removed",
) -> DataFrame:
    """Documents without their repeated units and passages.

    ``spans_column`` adds the removed stretches with their offsets (in characters) in the original text.
    """
    names = [c for c in docs.columns if not spans_column or c.lower() != spans_column.lower()]
    docs = without(docs, [spans_column] if spans_column else [])
    again = repeated_units(docs, id_column=id_column, text_column=text_column, unit=unit, passage_words=passage_words)
    left = docs.withColumn(KEY, row_key(id_column, text_column)).alias("d")
    joined = left.join(again.alias("r"), F.col(f"d.`{id_column}`").eqNullSafe(F.col(f"r.{ID}")) & (F.col(f"d.{KEY}") == F.col(f"r.{KEY}")), "left")
    joined = joined.select(*[F.col(f"d.`{c}`") for c in names], F.col(AGAIN))
    width = _width(unit, passage_words)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text_column):
            raw, offsets = utf8(batch.column(text_column))
            texts, spans = _without_runs(raw, offsets, batch.column(AGAIN), unit, width, min_words)
            old = batch.column(text_column)
            texts = pa.array([o.as_py() if t is None else t for o, t in zip(old, texts, strict=True)], old.type)
            columns = [texts if c == text_column else batch.column(c) for c in names]
            if spans_column:
                columns.append(pa.array(spans, pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "stop", "chars")]))))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *[spans_column] * bool(spans_column)])

    schema = T.StructType([docs.schema[c] for c in names])
    if spans_column:
        schema = schema.add(spans_column, T.DataType.fromDDL(SPANS))
    return joined.mapInArrow(cut, schema)


def _without_runs(raw, offsets, again: pa.Array, unit: str, width: int, min_words: int) -> tuple[list, list]:
    """The new text of each text that loses something (else None), and the removed stretches."""
    texts: list[str | None] = [None] * len(again)
    spans: list[list[dict]] = [[] for _ in texts]
    if again.null_count == len(again):
        return texts, spans
    units = Units(raw, offsets, unit)
    words = units.words
    first = np.searchsorted(units.text, np.arange(len(texts) + 1))
    before, data = characters(raw), raw.tobytes()

    def after_space(word: int) -> int:
        """Where the space before a word ends, what stands before it without space included; its start if there is none."""
        gap = np.flatnonzero(_SPACE[raw[words.ends[word - 1] : words.starts[word]]])
        return int(words.ends[word - 1] + gap[-1] + 1) if len(gap) else int(words.starts[word])

    for t in np.flatnonzero(again.is_valid().to_numpy(zero_copy_only=False)):
        place = again[int(t)].values.to_numpy()
        own, run = first[t] + place[place < PASSAGES], place[place >= PASSAGES] - PASSAGES
        starts = np.append(units.first_word[own] - words.first[t], run)
        depth = np.zeros(words.counts[t] + 2, np.int64)
        np.add.at(depth, 1 + starts, 1)
        np.add.at(depth, 1 + starts + np.append(units.count[own], np.full(len(run), width)), -1)
        edges = np.flatnonzero(np.diff(depth.cumsum() > 0)) + words.first[t]
        kept, end = [], int(offsets[t])
        for i, j in edges.reshape(-1, 2):
            if j - i >= min_words:
                head, tail = (int(np.searchsorted(units.first_word, x, side="right")) - 1 for x in (i, j - 1))
                a = int(units.starts[head]) if units.first_word[head] == i else after_space(i)
                b = int(units.stops[tail]) if units.first_word[tail] + units.count[tail] == j else after_space(j)
                kept.append(data[end:a])
                spans[t].append({"start": int(before[a] - before[offsets[t]]), "stop": int(before[b] - before[offsets[t]]), "chars": int(before[b] - before[a])})
                end = b
        if spans[t]:
            texts[t] = b"".join([*kept, data[end : offsets[t + 1]]]).decode()
    return texts, spans
