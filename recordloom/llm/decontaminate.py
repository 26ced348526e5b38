"""Benchmark decontamination: documents are searched for runs of words that occur in test items.

Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. A window is ``width`` words
in a row of an item; an item of fewer words, but not none, is one window. The windows of a bounded slice of the
benchmark go to every task as a sorted array of 64-bit numbers behind a bit table; a number that is found is
verified word by word. A benchmark beyond ``slice_bytes`` is searched for in several passes, one slice each.

Null and empty texts have no words and are never hit. Items whose id is null count as an item named "null";
items with the same id are one. Rows are judged one by one, so repeated rows get equal results. Columns of the
input that have the name of a result column are replaced; all others are kept.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.arrays import U64, Words, characters, row_key, steps, utf8, without

_BITS = 22
RUN = "array<struct<first:int,last:int,start:int,stop:int>>"
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")


class WindowSet:
    """The windows of some items, by length: bit table, sorted numbers, and the words with the items they are in."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        words = Words(*utf8(pa.array([text for _, text in items], pa.string())))
        lower = words.lower.tobytes()
        found: dict[int, dict[int, None]] = defaultdict(dict)
        self.items: dict[bytes, set[str]] = defaultdict(set)
        for length in sorted({min(int(n), width) for n in words.counts if n}):
            for at, item, number in zip(*words.windows(length), strict=True):
                if length == width or words.counts[item] == length:
                    found[length][int(number)] = None
                    self.items[_words_at(lower, words, at, length)].add(items[item][0])
        self.lengths = {}
        for length, numbers in found.items():
            numbers = np.sort(np.fromiter(numbers, U64, len(numbers)))
            table = np.zeros(1 << _BITS, bool)
            table[numbers >> U64(64 - _BITS)] = True
            self.lengths[length] = (np.packbits(table), numbers)

    def hits(self, words: Words) -> list[tuple[int, int, int, set[str]]]:
        """Verified occurrences: text, first word, length, items."""
        out = []
        lower = None
        for length, (packed, numbers) in self.lengths.items():
            table = np.unpackbits(packed).view(bool)
            at, text, number = words.windows(length)
            maybe = np.flatnonzero(table[number >> U64(64 - _BITS)])
            place = np.minimum(np.searchsorted(numbers, number[maybe]), len(numbers) - 1)
            maybe = maybe[numbers[place] == number[maybe]]
            lower = lower or words.lower.tobytes()
            for i in maybe:
                items = self.items.get(_words_at(lower, words, at[i], length))
                if items:
                    out.append((int(text[i]), int(at[i]), length, items))
        return out


def _words_at(lower: bytes, words: Words, at: int, length: int) -> bytes:
    return b" ".join(lower[a:b] for a, b in zip(words.starts[at : at + length], words.ends[at : at + length], strict=True))


def _marker(known, text_column: str, kept: list[str]):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = known.value
        for batch in steps(batches, text_column):
            raw, offsets = utf8(batch.column(text_column))
            words = Words(raw, offsets)
            by_text = defaultdict(list)
            for text, at, length, items in windows.hits(words):
                by_text[text].append((at, length, items))
            before = characters(raw) if by_text else None
            runs, found = [], []
            for text in range(batch.num_rows):
                spans, items = [], set()
                for at, length, of in sorted(by_text.get(text, ()), key=lambda x: x[:2]):
                    items |= of
                    if spans and at <= spans[-1][1] + 1:
                        spans[-1][1] = max(spans[-1][1], at + length - 1)
                    else:
                        spans.append([at, at + length - 1])
                zero, origin = int(words.first[text]), int(offsets[text])
                runs.append(
                    [
                        {"first": a - zero, "last": b - zero, "start": int(before[words.starts[a]] - before[origin]), "stop": int(before[words.ends[b]] - before[origin])}
                        for a, b in spans
                    ]
                )
                found.append(sorted(items))
            columns = [batch.column(c) for c in kept] + [
                pa.array(words.counts, pa.int64()),
                pa.array(runs, pa.list_(pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "stop")]))),
                pa.array(found, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_words", "runs", "items"])

    return mark


def _mark(docs: DataFrame, items: list[tuple[str, str]], width: int, text_column: str, kept: list[str]) -> DataFrame:
    known = docs.sparkSession.sparkContext.broadcast(WindowSet(items, width))
    schema = T.StructType([f for f in docs.schema.fields if f.name in kept])
    schema = schema.add("n_words", "long").add("runs", T.DataType.fromDDL(RUN)).add("items", T.ArrayType(T.StringType()))
    return docs.mapInArrow(_marker(known, text_column, [f.name for f in schema.fields[:-3]]), schema)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    width: int = 13,
    one_in: int = 20,
    slice_bytes: int = 16 << 20,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add to every row n_words, n_hit (words inside any window), n_items, items_sha256, contaminated and spans.

    A row is contaminated if it has hits and at least one word in ``one_in`` is hit. ``spans`` holds the stretches
    of hit words as character offsets. ``keep`` names the input columns to carry along (all if None). With an empty
    benchmark nothing is hit.
    """
    docs = without(docs, [*RESULT, "runs", "items"])
    kept = docs.columns if keep is None else [c for c in docs.columns if c in keep]
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_column}`").cast("string"), F.lit("null")).alias("item"),
        F.coalesce(F.col(f"`{item_text_column}`"), F.lit("")).alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = -(-total // slice_bytes) or 1
    read = docs.select([F.col(f"`{c}`") for c in dict.fromkeys([*kept, text_column])])
    if parts == 1:
        marked = _mark(read, [tuple(r) for r in items.collect()], width, text_column, kept)
    else:
        keyed = docs.select(F.col(f"`{id_column}`").alias("id"), row_key(id_column, text_column).alias("key"), F.col(f"`{text_column}`").alias("text"))
        cut = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
        slices = [_mark(keyed, [tuple(r) for r in items.where(cut == i).collect()], width, "text", ["id", "key"]) for i in range(parts)]
        hits = functools.reduce(DataFrame.unionAll, [s.where("size(runs) > 0") for s in slices])
        hits = hits.groupBy("id", "key").agg(
            F.flatten(F.collect_set("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
        )
        counted = _mark(read, [], width, text_column, list(read.columns)).drop("runs", "items").alias("d")
        here = row_key(id_column, text_column)
        marked = counted.join(hits.alias("h"), F.col(f"d.`{id_column}`").eqNullSafe(F.col("h.id")) & (here == F.col("h.key")), "left")
        marked = marked.select(*[F.col(f"d.`{c}`") for c in kept], "n_words", *[F.expr(f"coalesce({c}, array()) AS {c}") for c in ("runs", "items")])
    marked = marked.withColumn("runs", F.expr("array_sort(runs)"))
    covered = """aggregate(runs, named_struct('n', 0L, 'end', -1),
        (s, r) -> named_struct('n', s.n + greatest(0, r.last - greatest(r.first - 1, s.end)), 'end', greatest(s.end, r.last)), s -> s.n)"""
    return marked.select(
        *[F.col(f"`{c}`") for c in kept],
        "n_words",
        F.expr(f"{covered} AS n_hit"),
        F.expr("CAST(size(items) AS BIGINT) AS n_items"),
        F.expr("sha2(concat_ws(',', array_sort(items)), 256) AS items_sha256"),
        F.expr(f"({covered}) > 0 AND {one_in} * ({covered}) >= n_words AS contaminated"),
        F.expr("transform(runs, r -> named_struct('start', r.start, 'stop', r.stop)) AS spans"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, action: str = "documents", text_column: str = "text", **options) -> DataFrame:
    """Remove contaminated rows (``action='documents'``) or the hit stretches of every row (``action='spans'``).

    The columns are those of the input. Rows without hits stay as they are.
    """
    if action not in ("documents", "spans"):
        raise ValueError("action is 'documents' or 'spans'")
    clash = [c for c in docs.columns if c.lower() in (*RESULT, "runs", "items")]
    if clash:  # kept aside, as the names are needed
        docs = docs.withColumnsRenamed({c: f"__{i}" for i, c in enumerate(clash)})
    found = find_contamination(docs, benchmark, text_column=text_column, **options)
    if action == "documents":
        out = found.where(~F.col("contaminated")).select([F.col(f"`{c}`") for c in docs.columns])
    else:
        cut = F.expr(
            f"""concat_ws('', transform(sequence(0, size(spans)), i -> substring(`{text_column}`,
            if(i = 0, 0, spans[i - 1].stop) + 1,
            if(i = size(spans), char_length(`{text_column}`), spans[if(i = size(spans), 0, i)].start) - if(i = 0, 0, spans[i - 1].stop))))"""
        )
        whole = F.col(f"`{text_column}`")
        found = found.withColumn(text_column, F.when(whole.isNull() | (F.size("spans") == 0), whole).otherwise(cut))
        out = found.select([F.col(f"`{c}`") for c in docs.columns])
    return out.withColumnsRenamed({f"__{i}": c for i, c in enumerate(clash)}) if clash else out
