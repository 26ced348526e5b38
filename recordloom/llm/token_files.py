"""Token ids in files: canonical length-limited Huffman codes in independent blocks.

``write_tokens`` tokenises every text, appends the end id, counts all ids, derives one code for the whole corpus
and writes the documents in ascending order of their id. ``read_tokens`` decodes.

Files under the path given, all written by Spark:

* ``code``: symbol, bits. Codes are canonical: by length, then by symbol, counting upwards. No code is longer than
  ``MAX_BITS``, so that one table of 2 ** MAX_BITS entries decodes a symbol in one step.
* ``blocks``: one row per block of whole documents: part and first (ascending: documents ascend by id), doc_ids,
  lengths (ids per document), payload (the bits, most significant first), checkpoints (the bit at which every
  ``EVERY``-th id begins). A block can be read without any other, and each checkpoint without those before it.

Tokens are found per distinct stretch of text, cut where the byte-level pattern always parts it: around white space
and where words and other signs meet. Texts with other white space than spaces and line ends are tokenised whole.

Defined results: a null text is empty and has the end id only. Documents with a null id come first; those with
equal ids follow each other in the order of a hash of their text. An empty table gives files without blocks.
Other columns of the input are not stored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.arrays import U64, per_worker, ragged, row_key, steps, utf8
from recordloom.llm.chunks import Remembered
from recordloom.session import new_work_dir

MAX_BITS = 18
BLOCK, EVERY = 1 << 18, 256
#: Stretches a worker remembers.
REMEMBERED = 3 << 19
#: Bytes of text encoded together.
STEP = 1 << 20
#: New stretches the library gets as one text.
GROUP = 256
# Bytes that white space other than spaces and line ends begins with (or is): only texts with them are searched.
_MAYBE_SPACE = np.zeros(256, bool)
_MAYBE_SPACE[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_ODD_SPACE = re.compile(r"[^\S \n]")
_SIMPLE = re.compile(r" ?[^\s]+")
# ASCII letters, other ASCII, what of it ends before a letter (no space goes into a word, no quote into 's), and the
# second bytes of the letters that 0xC3 begins (À to ÿ but × and ÷)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_OTHER = ~_LETTER & (np.arange(256) < 128)
_ENDS = _OTHER.copy()
_ENDS[[32, 39]] = False
_SECOND = np.zeros(256, bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False

# a vocabulary entry (Ċ: line end, Ġ: space, Ã: 0xC3) that goes on from a line end into a word, or into a line end
_JOINED = re.compile("[^Ċ]Ċ|Ċ[A-Za-zĠÃ]")


def _letter_ends(raw: np.ndarray) -> np.ndarray:
    """The last bytes of the letters A-Z, a-z and À to ÿ."""
    found = _LETTER[raw]
    found[1:] |= (raw[:-1] == 0xC3) & _SECOND[raw[1:]]
    return found


class Tokens:
    """A byte-level tokenizer of the tokenizers library over many texts."""

    def __init__(self, definition: str, special_as_text: bool = False, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        # texts that hold one of them are left to the library as a whole
        self.whole = [t.content.encode() for t in added if not (special_as_text and t.special)]
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        # words between line ends need no pattern, if no merge joins them and nothing else is done to them
        settings = json.loads(definition)
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        apart = not any(_JOINED.search(t) for t in self.tokenizer.get_vocab(with_added_tokens=False))
        apart &= not any(w.decode().replace(" ", "").isalpha() for w in self.whole)
        self.words = None
        if apart and not settings.get("normalizer") and usual.items() <= (settings.get("pre_tokenizer") or {}).items():
            self.words = Tokenizer(self.tokenizer.model)
            self.words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known = Remembered(self._learn, remembered)

    def _grouped(self, tokenizer, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches that a line end parts, which has an id of its own."""
        joined = [b"\n".join(stretches[i : i + GROUP]).decode() + "\n" for i in range(0, len(stretches), GROUP)]
        found = [np.array(e.ids, np.int32) for e in tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.int32), *found])
        ends = np.flatnonzero(ids == self.line_end[0])
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _learn(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(stretches), np.uint8)
        length = np.fromiter(map(len, stretches), np.int64, len(stretches))
        first = np.cumsum(length) - length
        word = _letter_ends(raw)
        word[:-1] |= word[1:] & (raw[:-1] == 0xC3)
        word[first] |= raw[first] == 32
        # 0: a word, 1: of no white space but a space before it, 2: anything else
        kind = np.where(np.logical_and.reduceat(word, first) & (self.words is not None), 0, 2)
        for i in np.flatnonzero(kind).tolist():
            if len(self.line_end) == 1 and _SIMPLE.fullmatch(stretches[i].decode()) and not any(w in stretches[i] for w in self.whole):
                kind[i] = 1
        by_kind = [np.flatnonzero(kind == k).tolist() for k in range(3)]
        parts = [self._grouped(t, [stretches[i] for i in at]) for t, at in zip((self.words, self.tokenizer), by_kind, strict=False) if at]
        single = [self.tokenizer.encode(stretches[i].decode(), add_special_tokens=False).ids for i in by_kind[2]]
        parts.append((np.array([i for s in single for i in s], np.int32), np.array([len(s) for s in single], np.int64)))
        ids, found = (np.concatenate(p) for p in zip(*parts, strict=True))
        size, start = np.zeros(len(stretches), np.int64), np.zeros(len(stretches), np.int64)
        order = np.concatenate([np.array(at, np.int64) for at in by_kind])
        size[order], start[order] = found, np.cumsum(found) - found
        return ids[ragged(start, size)], size

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and how many each has."""
        raw, offsets = utf8(column)
        begin = self._begins(raw, offsets)
        maybe = np.unique(np.searchsorted(offsets, np.flatnonzero(_MAYBE_SPACE[raw]), side="right") - 1)
        for i in (i for i in maybe.tolist() if _ODD_SPACE.search(column[i].as_py())):
            begin[offsets[i] : offsets[i + 1]] = False
        data = raw.tobytes() if self.whole else b""
        for content in self.whole:
            at = data.find(content)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, side="right")) - 1
                begin[offsets[i] : offsets[i + 1]] = False
                at = data.find(content, int(offsets[i + 1]))
        begin[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(begin)
        ids, size = self.known.encode(raw, starts, np.append(starts[1:], len(raw)))
        edge = np.append(0, np.cumsum(size))[np.searchsorted(starts, offsets)]
        return ids, np.diff(edge)

    def _begins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pattern always parts a text that has no white space but spaces and line ends.

        White space begins anew behind a word, and so does its last byte before one; a line end is apart from the
        word behind it. Letters end before other ASCII and, unless it is a space or a quote, begin behind it.
        """
        begin = np.zeros(len(raw), bool)
        if not len(raw):
            return begin
        blank, letter = (raw == 32) | (raw == 10), _LETTER[raw]
        last = blank[:-1] & ~blank[1:]
        last[(offsets[1:] - 1)[(offsets[1:] > 0) & (offsets[1:] < len(raw))]] = False  # what ends a text stays together
        begin[:-1] = last
        begin[1:] |= blank[1:] & ~blank[:-1]
        begin[1:] |= (raw[:-1] == 10) & ~blank[1:]
        begin[1:] |= _letter_ends(raw)[:-1] & _OTHER[raw[1:]]
        begin[1:] |= _ENDS[raw[:-1]] & letter[1:]
        return begin


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits of the best prefix code without codes over ``limit`` bits (0 for symbols that do not occur).

    Package-merge: each level pairs up the packages of the level below with the symbols; a symbol's length is the
    number of levels at which it is among the cheapest.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    level, is_symbol = weight, [np.ones(len(weight), bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        is_symbol.append(rank < len(weight))
    take = 2 * (len(used) - 1)
    for symbols in reversed(is_symbol):
        chosen = int(symbols[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


class Code:
    """Canonical code of given lengths, with tables to write and to read."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        symbols = np.flatnonzero(lengths)
        symbols = symbols[np.lexsort((symbols, lengths[symbols]))]
        bits = lengths[symbols]
        room = np.int64(1) << (MAX_BITS - bits)  # entries of the table a code covers
        first = np.cumsum(room) - room
        self.codes = np.zeros(len(lengths), U64)
        self.codes[symbols] = (first >> (MAX_BITS - bits)).astype(U64)
        self.table = np.ones(1 << MAX_BITS, np.int32)  # symbol and, in the last five bits, how many bits it has
        self.table[: room.sum()] = np.repeat(symbols << 5 | bits, room)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of some ids, and where every EVERY-th begins."""
        bits = self.lengths[ids]
        end = np.cumsum(bits)
        at = end - bits
        word, shift = at >> 5, (64 - bits - (at & 31)).astype(U64)
        value = self.codes[ids] << shift  # no code spans more than two words of 32 bits
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        words = np.zeros(int(word[-1]) + 2, U64)
        words[word[first]] = np.add.reduceat(value >> U64(32), first)
        words[word[first] + 1] += np.add.reduceat(value & U64(0xFFFFFFFF), first)
        return words.astype(">u4").tobytes()[: -(-int(end[-1]) // 8)], at[::EVERY]

    def unpack(self, payload: bytes, checkpoints: np.ndarray, count: int) -> np.ndarray:
        """The ids of one block; all stretches between checkpoints advance together."""
        padded = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
        window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        at = checkpoints.astype(np.int64)
        out = np.zeros((EVERY, len(at)), np.int32)
        last = len(window) - 1
        for k in range(min(EVERY, count)):
            entry = window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32) >> np.uint32(32 - MAX_BITS)
            out[k] = found = self.table[entry]
            at += found & 31
        return out.T.ravel()[:count] >> 5


def _ranged(read: DataFrame) -> DataFrame:
    """Rows by ascending ranges of ids, about as many rows each, in as many partitions as a shuffle has.

    The bounds of whole numbers are found from the ids alone; Spark's own ranges would read the texts twice.
    """
    parts = int(read.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not isinstance(read.schema["id"].dataType, T.IntegralType) or parts < 2:
        return read.repartitionByRange("id", "key")
    shares = [i / parts for i in range(1, parts)]
    bounds = read.agg(F.percentile_approx("id", shares, 10_000).alias("bounds")).first().bounds
    listed = F.array(*[F.lit(b).cast("long") for b in sorted(set(bounds or []))]).cast("array<long>")
    # null ids, which come first, and then ids up to each bound
    part = F.when(F.col("id").isNull(), 0).otherwise(F.size(F.filter(listed, lambda bound: bound < F.col("id"))))
    return read.repartitionById(parts, part)


def _tokenise(docs: DataFrame, definition: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """part, row (ascending by id within the part), id, ids (little-endian 32-bit), in the order of the ids.

    Each task ends with a row of nulls but for symbol and n: the ids it found, and how often.
    """
    known = docs.sparkSession.sparkContext.broadcast(definition)
    read = docs.select(F.col(f"`{id_column}`").alias("id"), row_key(id_column, text_column).alias("key"), F.col(f"`{text_column}`").alias("text"))
    ordered = _ranged(read).sortWithinPartitions("id", "key").withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, row, n = per_worker(("tokens", known.value), lambda: Tokens(known.value)), 0, np.zeros(0, np.int64)
        for batch in steps(batches, "text", STEP, keeps=True):
            ids, size = tokens.encode(batch.column("text"))
            full = np.full(len(ids) + len(size), end_id, np.uint32)
            full[ragged(np.cumsum(size + 1) - size - 1, size)] = ids
            edges = np.append(0, np.cumsum(size + 1)) * 4
            texts = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(full)])
            rows = pa.array(np.arange(row, row + len(size)))
            row += len(size)
            more = np.bincount(full, minlength=len(n))
            more[: len(n)] += n
            n, kind = more, batch.column("id").type
            columns = [batch.column("part"), rows, batch.column("id"), texts.cast(pa.binary()), *[pa.nulls(len(size), listed)] * 2]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if row:
            some = np.flatnonzero(n)
            columns = [pa.nulls(1, t) for t in (pa.int32(), pa.int64(), kind, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([some], listed), pa.array([n[some]], listed)], names=names)

    schema = T.StructType().add("part", "integer").add("row", "long").add("id", read.schema["id"].dataType).add("ids", "binary")
    schema = schema.add("symbol", T.ArrayType(T.LongType())).add("n", T.ArrayType(T.LongType()))
    names, listed = schema.names, pa.list_(pa.int64())
    return ordered.mapInArrow(run, schema)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each symbol once, with the sum of its counts."""
    found = np.zeros(0, np.int64)
    for batch in batches:
        symbol, n = (batch.column(c).flatten().to_numpy() for c in ("symbol", "n"))
        found = np.append(found, np.zeros(max(int(symbol.max(initial=-1)) + 1 - len(found), 0), np.int64))
        np.add.at(found, symbol, n)
    some = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["symbol", "n"])


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    *,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Tokenise all texts and write them under ``path``."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    tokenised = _tokenise(docs, definition, end_id, id_column, text_column)
    tokens_at = new_work_dir(spark, "tokens")
    tokenised.write.option("compression", "zstd").parquet(tokens_at)
    found = spark.read.schema(tokenised.schema).parquet(tokens_at)
    counts = found.where("row IS NULL").select("symbol", "n").mapInArrow(_added, "symbol long, n long")
    table = counts.groupBy("symbol").agg(F.sum("n").alias("n")).toArrow()  # as many rows as the vocabulary has ids
    symbols, n = table["symbol"].to_numpy(), table["n"].to_numpy()
    every = np.zeros(int(symbols.max(initial=0)) + 1, np.int64)
    every[symbols] = n
    lengths = code_lengths(every)
    used = np.flatnonzero(lengths)
    rows = pa.table({"symbol": pa.array(used), "bits": pa.array(lengths[used])})
    spark.createDataFrame(rows, "symbol long, bits long").coalesce(1).write.parquet(f"{path}/code")
    code = spark.sparkContext.broadcast(Code(lengths))
    tokens = found.where("row IS NOT NULL").select("part", "row", "id", "ids")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, object, bytes]] = []
        total = 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(h[3] for h in held), np.uint32)
            payload, checkpoints = code.value.pack(ids)
            columns = ([held[0][0]], [held[0][1]], [[h[2] for h in held]], [[len(h[3]) // 4 for h in held]], [payload], [checkpoints])
            return pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("part", "row", "id", "ids")], strict=True):
                if held and (total >= BLOCK or row[0] != held[-1][0] or row[1] != held[-1][1] + 1):
                    yield block()
                    held, total = [], 0
                held.append(row)
                total += len(row[3]) // 4
        if held:
            yield block()

    kind = tokens.schema["id"].dataType
    schema = T.StructType().add("part", "integer").add("first", "long").add("doc_ids", T.ArrayType(kind))
    schema = schema.add("lengths", T.ArrayType(T.LongType())).add("payload", "binary").add("checkpoints", T.ArrayType(T.LongType()))
    names = schema.names
    id_type = pa.Table.from_batches([], spark.createDataFrame([], T.StructType().add("id", kind)).toArrow().schema).schema.field(0).type
    kinds = (pa.int32(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()))
    tokens.mapInArrow(pack, schema).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: part, first, doc_id, before (ids of its block before it), n_tokens, ids (little-endian)."""
    rows = spark.read.parquet(f"{path}/code").toArrow()
    lengths = np.zeros(int(rows["symbol"].to_numpy().max(initial=0)) + 1, np.int64)
    lengths[rows["symbol"].to_numpy()] = rows["bits"].to_numpy()
    code = spark.sparkContext.broadcast(Code(lengths))
    blocks = spark.read.parquet(f"{path}/blocks")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                size = batch.column("lengths")[i].values.to_numpy(zero_copy_only=False)
                edges = np.append(0, np.cumsum(size))
                ids = code.value.unpack(batch.column("payload")[i].as_py(), batch.column("checkpoints")[i].values.to_numpy(), int(edges[-1]))
                data = ids.astype("<u4").tobytes()
                texts = [data[a * 4 : b * 4] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                place = [pa.array([batch.column(c)[i].as_py()] * len(size), k) for c, k in (("part", pa.int32()), ("first", pa.int64()))]
                columns = [*place, batch.column("doc_ids")[i].values, pa.array(edges[:-1]), pa.array(size), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "first", "doc_id", "before", "n_tokens", "ids"])

    schema = T.StructType().add("part", "integer").add("first", "long").add("doc_id", blocks.schema["doc_ids"].dataType.elementType)
    return blocks.mapInArrow(unpack, schema.add("before", "long").add("n_tokens", "long").add("ids", "binary"))


def starts(spark: SparkSession, path: str) -> DataFrame:
    """part, first, start: how many ids of all documents come before each block.

    A running sum over the parts, of which there are as many as files, and one within each part.
    """
    size = F.expr("aggregate(lengths, 0L, (a, b) -> a + b)")
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "first", size.alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part").select("part", "first", (F.col("base") + F.col("inside")).alias("start"))


def tokenised(
    docs: DataFrame, tokenizer_file: str, *, end_id: int, result: dict[str, Column] | None = None, **columns: str
) -> DataFrame:
    """Write token files into the shared working folder and read them back: doc_id, start, n_tokens, ids.

    ``result`` replaces ids by expressions over them, so that only those move.
    """
    spark = docs.sparkSession
    path = new_work_dir(spark, "token_files")
    write_tokens(docs, path, tokenizer_file, end_id=end_id, **columns)
    wanted = [c.alias(n) for n, c in (result or {"ids": F.col("ids")}).items()]
    read = read_tokens(spark, path).select("part", "first", "doc_id", "before", "n_tokens", *wanted)
    joined = read.join(starts(spark, path), ["part", "first"])
    return joined.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", *(result or ["ids"]))
