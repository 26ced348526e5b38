"""Alignment of the tokens of two tokenizers over the same bytes.

Tokens of tokenizer A (byte-level) and of tokenizer B (SentencePiece) are byte ranges of one text. Offsets at which a
token of each ends cut the text into groups; within a group every A token is linked with every B token. The groups
are found by pointer jumping: every token points to the token that overlaps it and reaches farthest to the right
(itself if none goes on), and pointers are followed twice as far in each step until all have come to the last A
token of their group.

Links are counted over the corpus: how many documents hold a pair of ids linked. A document's links are kept as its
distinct pairs with how often each occurs; a group of many tokens counts its distinct ids first, and the pairs of one
text are made in slices of bounded size, so all pairs of a group are never there as links. Pairs held by more than one
in ``HOT`` of all (document, pair) rows, of which there can be ``HOT`` at most, go to all tasks together with the
highest count of each A id (a row per vocabulary entry); only the other pairs are shuffled to meet their counts. So
no key is held by more than one in ``HOT`` rows of that shuffle.

Defined results: a text that is null or empty, or that either tokenizer does not spell byte for byte (B writes U+2581
as a space), has no tokens: all numbers are zero and ``groups`` is empty. Rows are judged one by one, so repeated rows
and equal ids keep a row each and count as a document each. An empty table gives no rows. Other columns of the input
are not returned. Special tokens' strings inside texts are plain text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.arrays import per_worker, ragged, steps, utf8
from recordloom.llm.chunks import Remembered
from recordloom.llm.tables import settled
from recordloom.llm.token_files import Tokens
from recordloom.session import new_work_dir, written

HOT = 1 << 18
#: Bytes of text a step takes, links that are made at once, tokens from which a group counts distinct ids first,
#: (document, pair) rows that are counted at once, and stretches of text that a worker remembers per tokenizer.
STEP, SLICE, MANY, COUNTED, REMEMBERED = 1 << 19, 1 << 18, 64, 1 << 20, 1 << 19
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: ids of texts, and the bytes of each id."""

    def __init__(self, definition: str):
        self.tokens = Tokens(definition, special_as_text=True, remembered=REMEMBERED)
        tokenizer, values = self.tokens.tokenizer, byte_values()
        names = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
        self.spelling = [bytes(values[c] for c in n) if all(c in values for c in n) else n.encode() for n in names]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.tokens.encode(texts)


class Pieces:
    """Tokenizer B: ids of texts that begin with the space it adds, and the bytes of each id."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(len(self.model))]
        self.spelling = [bytes([int(n[1:-1], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        # where no piece goes on behind a word into the space after it, stretches between spaces are independent
        self.apart = not any(a != " " and b == " " for n in names for a, b in zip(n.replace("▁", " "), n.replace("▁", " ")[1:], strict=False))
        self.known = Remembered(self._learn, REMEMBERED)

    def _learn(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # the model adds the first space itself, but none to an empty text: spaces alone are taken from behind a word
        word = self.model.encode("a")
        ids = self.model.encode([s[1:].decode() if s.strip(b" ") else "a" + s.decode() for s in stretches], num_threads=1)
        ids = [one if s.strip(b" ") else one[len(word) :] for s, one in zip(stretches, ids, strict=True)]
        return np.array([i for one in ids for i in one], np.int32), np.array([len(one) for one in ids], np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, offsets = utf8(texts)
        begin = np.zeros(len(raw), bool)
        if self.apart:
            begin[1:] = (raw[1:] == 32) & (raw[:-1] != 32)
        begin[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(begin)
        ids, size = self.known.encode(raw, starts, np.append(starts[1:], len(raw)))
        edge = np.append(0, np.cumsum(size))[np.searchsorted(starts, offsets)]
        return ids, np.diff(edge)


def spelled(ids: np.ndarray, sizes: np.ndarray, spelling: list[bytes], texts: bytes, offsets: np.ndarray) -> np.ndarray:
    """Which texts their ids spell byte for byte."""
    parts = [spelling[i] for i in ids.tolist()]
    length = np.append(0, np.cumsum([len(p) for p in parts]))
    edges = np.append(0, np.cumsum(sizes))
    joined = b"".join(parts)
    if joined == texts and (length[edges] == offsets).all():
        return np.ones(len(sizes), bool)
    at = length[edges].tolist()
    return np.array([joined[at[i] : at[i + 1]] == texts[offsets[i] : offsets[i + 1]] for i in range(len(sizes))], bool)


def grouped(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each token's group, from where the tokens of both end; both end with the last byte."""
    n = len(end_a)
    over_b, over_a = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)  # the token over a token's last byte
    goes_on = end_b[over_b] > end_a
    points = np.append(np.where(goes_on, n + over_b, np.arange(n)), over_a)
    while True:
        further = points[points]
        if (further == points).all():
            break
        points = further
    last = np.flatnonzero(points[:n] == np.arange(n))
    group = np.searchsorted(last, points)
    return group[:n], group[n:]


class Aligned:
    """Groups of some texts, tokens of all texts one after the other."""

    def __init__(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, spell_a: np.ndarray, spell_b: np.ndarray):
        self.a, self.b, self.size_a, self.size_b = a.astype(np.int64), b.astype(np.int64), size_a, size_b
        self.group_a, self.group_b = grouped(np.cumsum(spell_a[a]), np.cumsum(spell_b[b])) if len(a) else (self.a, self.b)
        groups = int(self.group_a[-1]) + 1 if len(a) else 0
        self.count_a, self.count_b = (np.bincount(g, minlength=groups) for g in (self.group_a, self.group_b))
        self.first_a, self.first_b = (np.cumsum(c) - c for c in (self.count_a, self.count_b))
        text = np.repeat(np.arange(len(size_a)), size_a)
        self.text = text[self.first_a]  # of each group

    def numbers(self) -> list[np.ndarray]:
        """Per text: tokens of A, of B, groups, links."""
        links = np.zeros(len(self.size_a), np.int64)
        np.add.at(links, self.text, self.count_a * self.count_b)
        return [self.size_a, self.size_b, np.bincount(self.text, minlength=len(self.size_a)), links]

    def written(self, numerals: list[str]) -> list[str]:
        """Per text its groups: ids of A, ``|``, ids of B, groups parted by ``;``."""
        each = len(numerals) // 3
        code = np.zeros(len(self.a) + len(self.b), np.int64)
        place_a = np.arange(len(self.a)) + self.first_b[self.group_a]
        place_b = np.arange(len(self.b)) + (self.first_a + self.count_a)[self.group_b]
        code[place_a], code[place_b] = self.a, self.b
        code[place_a[self.first_a + self.count_a - 1]] += each
        code[place_b[self.first_b + self.count_b - 1]] += 2 * each
        edge = np.append(0, np.cumsum(self.size_a + self.size_b)).tolist()
        return ["".join([numerals[c] for c in code[i:j].tolist()])[:-1] for i, j in zip(edge[:-1], edge[1:], strict=True)]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Distinct linked ids of each text, in slices: text, pair (A << 32 | B), how often it is linked.

        Texts come in ascending order; a text may go on in the next slice, with other pairs.
        """
        many = self.count_a * self.count_b > MANY
        group, a, times = _distinct(self.group_a, self.a, many)
        group_b, b, times_b = _distinct(self.group_b, self.b, many)
        count_b = np.bincount(group_b, minlength=len(self.count_b))
        first_b = np.cumsum(count_b) - count_b
        order = np.lexsort((a, self.text[group]))
        group, a, times = group[order], a[order], times[order]
        text = self.text[group]
        run = np.cumsum(np.append(True, (text[1:] != text[:-1]) | (a[1:] != a[:-1]))) - 1 if len(a) else a
        ends = np.flatnonzero(np.append(run[1:] != run[:-1], True)) + 1 if len(a) else a
        links = np.append(0, np.cumsum(count_b[group]))
        start = 0
        while start < len(a):  # whole runs of one text and A id
            stop = int(ends[np.searchsorted(links[ends], links[start] + SLICE, side="right").clip(max=len(ends) - 1)])
            if links[stop] > links[start] + SLICE:
                shorter = ends[np.searchsorted(ends, stop) - 1] if np.searchsorted(ends, stop) else 0
                stop = int(shorter) if shorter > start else stop
            part = slice(start, stop)
            of = ragged(first_b[group[part]], count_b[group[part]])
            each = np.repeat(np.arange(start, stop), count_b[group[part]])
            key = run[each] << 32 | b[of]
            by = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.append(True, key[by][1:] != key[by][:-1]))
            row = each[by[first]]
            yield text[row], a[row] << 32 | b[of[by[first]]], np.add.reduceat((times[each] * times_b[of])[by], first)
            start = stop


def _distinct(group: np.ndarray, ids: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id, times: in groups of many links each id once, elsewhere token by token; groups ascend."""
    some = many[group]
    if not some.any():
        return group, ids, np.ones(len(ids), np.int64)
    key, times = np.unique(group[some] << 32 | ids[some], return_counts=True)
    rest = np.flatnonzero(~some)
    groups, both = np.append(key >> 32, group[rest]), np.append(key & 0xFFFFFFFF, ids[rest])
    order = np.argsort(groups, kind="stable")
    return groups[order], both[order], np.append(times, np.ones(len(rest), np.int64))[order]


class Aligner:
    """Both tokenizers, as one worker keeps them."""

    def __init__(self, definition: str, model: bytes):
        self.sides = ByteLevel(definition), Pieces(model)
        self.lengths = [np.array([len(s) for s in side.spelling], np.int64) for side in self.sides]
        most = max(len(side.spelling) for side in self.sides)
        self.numerals = [f"{i}{mark}" for mark in ",|;" for i in range(most)]

    def align(self, texts: pa.Array) -> tuple[np.ndarray, Aligned]:
        """Which texts have tokens, and the groups of those."""
        raw, offsets = utf8(texts)
        data, ok = raw.tobytes(), offsets[1:] > offsets[:-1]
        found = []
        for side in self.sides:
            ids, size = side.encode(texts)
            ok = ok & spelled(ids, size, side.spelling, data, offsets)
            found.append((ids, size))
        (a, size_a), (b, size_b) = ((ids[np.repeat(ok, size)], size[ok]) for ids, size in found)
        return ok, Aligned(a, b, size_a, size_b, *self.lengths)


def _links(docs: DataFrame, definition: str, model: bytes, id_column: str, text_column: str) -> DataFrame:
    """row, id, numbers and groups of each document (in the first of its rows), and its pairs and times (64-bit, packed)."""
    text = F.col(f"`{text_column}`")
    read = docs.select(F.col(f"`{id_column}`").alias("id"), F.when(text != "", F.concat(F.lit(" "), text)).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast((definition, model))
    numbers = T.StructType([T.StructField(n, T.LongType()) for n in NUMBERS])
    schema = T.StructType([T.StructField("row", T.LongType()), read.schema["id"], *numbers, T.StructField("groups", T.StringType())])
    schema = schema.add("pairs", "binary").add("times", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(("aligner", hash(sent.value)), lambda: Aligner(*sent.value))
        row = TaskContext.get().partitionId() << 36
        for batch in steps(batches, "text", STEP, keeps=True):
            n = batch.num_rows
            ok, aligned = aligner.align(batch.column("text"))
            where = np.flatnonzero(ok)
            stats = np.zeros((len(NUMBERS), n), np.int64)
            stats[:, where] = aligned.numbers()
            groups = np.full(n, "", object)
            groups[where] = aligned.written(aligner.numerals)
            pairs, times = np.full((2, n), b"", object)
            later: list[tuple[int, bytes, bytes]] = []
            begun = np.zeros(n, bool)
            for of, pair, often in aligned.pairs():
                first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                for i, j in zip(first.tolist(), np.append(first[1:], len(of)).tolist(), strict=True):
                    d, p, t = int(where[of[i]]), pair[i:j].tobytes(), often[i:j].tobytes()
                    if begun[d]:
                        later.append((d, p, t))
                    else:
                        pairs[d], times[d], begun[d] = p, t, True
                while later:  # a text's further pairs, as they come
                    d, p, t = later.pop()
                    empty = [pa.nulls(1, pa.int64())] * len(NUMBERS)
                    columns = [pa.array([row + d]), pa.nulls(1, batch.column("id").type), *empty, pa.nulls(1, pa.string()), pa.array([p], pa.binary()), pa.array([t], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            columns = [pa.array(row + np.arange(n)), batch.column("id"), *[pa.array(s) for s in stats], pa.array(groups, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(pairs, pa.binary()), pa.array(times, pa.binary())], names=schema.names)
            row += n

    return read.mapInArrow(run, schema)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed 64-bit numbers of all rows, and how many each row has."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), np.int64), np.array([len(p) // 8 for p in parts], np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    per_worker("pairs", lambda: None)  # the tokenizers are needed no more
    held, size = [], 0

    def out() -> pa.RecordBatch:
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            held.append(_flat(batch.column("pairs").slice(at, 256))[0])
            size += len(held[-1])
            if size >= COUNTED:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def align(
    docs: DataFrame,
    tokenizer_file: str,
    model_file: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    result: dict[str, Column] | None = None,
) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, and its groups.

    n_best: links whose count is the highest of their A id; count_sum: the counts of all links. ``result`` replaces
    the groups by expressions over them, so that only those are stored.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f, open(model_file, "rb") as m:
        definition, model = f.read(), m.read()
    wanted = result or {"groups": F.col("groups")}
    found = _links(docs, definition, model, id_column, text_column)
    found = found.select("row", "id", *NUMBERS, *[c.alias(f"__{i}") for i, c in enumerate(wanted.values())], "pairs", "times")
    found = written(found, new_work_dir(spark, "links"))

    counted = found.select("pairs").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = settled(counted, new_work_dir(spark, "pair_counts"))
    least = (counts.agg(F.sum("n").alias("n")).first().n or 0) // HOT
    hot = counts.where(F.col("n") > least).toArrow()  # HOT rows at most
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("highest"))
    best = highest.toArrow()  # a row per id of A at most
    order = np.argsort(hot["pair"].to_numpy())
    top = np.zeros(int(best["a"].to_numpy().max(initial=0)) + 1, np.int64)
    top[best["a"].to_numpy()] = best["highest"].to_numpy()
    known = spark.sparkContext.broadcast((hot["pair"].to_numpy()[order], hot["n"].to_numpy()[order], top))

    def look_up(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the hot pairs, and whether it is one."""
        keys = known.value[0]
        place = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
        return place, keys[place] == pair if len(keys) else np.zeros(len(pair), bool)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                (pair, size), (times, _) = (_flat(rows.column(c)) for c in ("pairs", "times"))
                place, is_hot = look_up(pair)
                n = np.where(is_hot, known.value[1][place], 0) if len(known.value[1]) else np.zeros(len(pair), np.int64)
                edge = np.append(0, np.cumsum(size))
                sums = [np.diff(np.append(0, np.cumsum(x))[edge]) for x in (times * (is_hot & (n == known.value[2][pair >> 32])), times * n)]
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], *map(pa.array, sums)], names=[*kept, "n_best", "count_sum"])

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                (pair, size), (times, _) = (_flat(rows.column(c)) for c in ("pairs", "times"))
                cold = ~look_up(pair)[1]
                of = np.repeat(rows.column("row").to_numpy(), size)
                yield pa.RecordBatch.from_arrays([pa.array(x[cold]) for x in (of, pair, times)], names=["row", "pair", "times"])

    kept = [c for c in found.columns if c not in ("pairs", "times")]
    schema = T.StructType([found.schema[c] for c in kept]).add("n_best", "long").add("count_sum", "long")
    local = found.mapInArrow(near, schema)
    rest = counts.where(F.col("n") <= least).withColumn("a", F.shiftright("pair", 32))
    vocabulary = spark.createDataFrame(best, "a long, highest long")
    rest = rest.join(F.broadcast(vocabulary), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("is_best"))
    met = found.select("row", "pairs", "times").mapInArrow(far, "row long, pair long, times long").join(rest, "pair")
    cold = met.select("row", F.when(F.col("is_best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    # the further rows of long documents add to their first ones as cold pairs do
    further = local.where("n_a IS NULL").select("row", "n_best", "count_sum")
    more = cold.unionByName(further).groupBy("row").agg(F.sum("n_best").alias("more_best"), F.sum("count_sum").alias("more_sum"))
    out = local.where("n_a IS NOT NULL").join(settled(more, new_work_dir(spark, "cold_links")), "row", "left")
    added = [(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    return out.select(F.col("id").alias(id_column), *NUMBERS, *added, *[F.col(f"__{i}").alias(name) for i, name in enumerate(wanted)])
