"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Text is cut before each run of spaces, as no piece goes on behind one; words are the distinct stretches of a batch.
Words of equal length advance together: hashes of all their substrings up to the longest piece probe the sorted
piece keys, and for each end position the maximum over the pieces that end there becomes the best score, its index
the backpointer. Characters that no piece covers become their UTF-8 bytes.

A unigram model has log probabilities; a BPE model only has merge ranks. For a BPE file each piece gets the log
probability that Zipf's law gives its rank. The segmentation is the one SentencePiece's own unigram encoder finds
for the same pieces and scores.

Defined results: null has null ids, the empty text none. A space is put before every text that is not empty and
taken away by decoding, so that decoding gives back every text exactly; U+2581 is spelled in bytes for that.
Result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.arrays import U64, mix, per_worker, ragged, steps, utf8, without
from recordloom.llm.chunks import Remembered

_BASE = 0x9E3779B97F4A7C15
_STEP = U64(0xD6E8FEB86659FD93)
_BITS = 20
_SPACE, _ESCAPED = "▁", 0x110000  # no character has the second number
UNKNOWN_PENALTY = 10.0
#: Cells (characters of words) searched together.
CELLS = 1 << 17
#: Bytes of text encoded together, and words remembered by a worker.
STEP, REMEMBERED = 1 << 19, 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, U64), np.full(n, pow(_BASE, -1, 1 << 64), U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


class Pieces:
    """Pieces of a model as sorted keys with ids and scores, and the bytes of every id."""

    def __init__(self, pieces: list[tuple[int, str, float]], bytes_of: dict[int, int]):
        """``pieces``: id, text with U+2581 for a space, score; ``bytes_of``: id of each byte piece and its byte."""
        self.longest = max(len(p) for _, p, _ in pieces)
        self.up, self.down = _powers(self.longest + 1)
        keys = np.array([self._keys(self._matrix([p], False), len(p))[0, 0] for _, p, _ in pieces], U64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ids = np.array([i for i, _, _ in pieces], np.int32)[order]
        self.scores = np.array([s for _, _, s in pieces], np.float32)[order]
        self.unknown = np.float32(self.scores.min() - UNKNOWN_PENALTY)
        table = np.zeros(1 << _BITS, bool)
        table[self.keys >> U64(64 - _BITS)] = True
        self.table = np.packbits(table)
        self.byte_id = np.zeros(256, np.int32)
        texts = {i: p.replace(_SPACE, " ").encode() for i, p, _ in pieces}
        for i, byte in bytes_of.items():
            self.byte_id[byte] = i
            texts[i] = bytes([byte])
        parts = [texts.get(i, b"") for i in range(max(texts) + 1)]
        self.size = np.array([len(p) for p in parts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    @classmethod
    def load(cls, path: str, zipf: bool = True) -> Pieces:
        """Read a model file. ``zipf``: score pieces by the rank of their id instead of by the scores in the file."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        bytes_of = {i: int(model.id_to_piece(i)[3:5], 16) for i in range(size) if model.is_byte(i)}
        normal = [i for i in range(size) if not (i in bytes_of or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        whole = np.log((1 / np.arange(1, len(normal) + 1)).sum())
        scores = [float(-np.log(r + 1) - whole) if zipf else model.get_score(i) for r, i in enumerate(normal)]
        return cls([(i, model.id_to_piece(i), s) for i, s in zip(normal, scores, strict=True)], bytes_of)

    @staticmethod
    def _matrix(words: list[str], spaces: bool = True) -> np.ndarray:
        cells = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        if spaces:
            return np.where(cells == 32, ord(_SPACE), np.where(cells == ord(_SPACE), _ESCAPED, cells)).astype(np.uint32)
        return cells

    def _keys(self, cells: np.ndarray, length: int) -> np.ndarray:
        """Keys of all substrings of ``length`` characters, by first character."""
        n = cells.shape[1] - length + 1
        key = np.zeros((len(cells), n), U64)
        for k in range(length):
            key += (cells[:, k : k + n].astype(U64) + U64(1)) * self.up[k]
        return mix(key + np.array([length], U64) * _STEP)

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best segmentation of words of one length: ids of all of them in order, and how many each has."""
        cells = self._matrix(words)
        count, length = cells.shape
        longest = min(self.longest, length)
        table = np.unpackbits(self.table).view(bool)
        score = np.full((count, length + 1, longest), -np.inf, np.float32)  # by end, longest piece first
        piece = np.full((count, length + 1, longest), -1, np.int32)
        for n in range(1, longest + 1):
            key = self._keys(cells, n)
            row, start = np.nonzero(table[key >> U64(64 - _BITS)])
            place = np.minimum(np.searchsorted(self.keys, key[row, start]), len(self.keys) - 1)
            found = self.keys[place] == key[row, start]
            row, start, place = row[found], start[found], place[found]
            score[row, start + n, longest - n] = self.scores[place]
            piece[row, start + n, longest - n] = self.ids[place]
        single = score[:, 1:, longest - 1]
        single[np.isneginf(single)] = self.unknown
        best = np.full((count, length + 1 + longest), -np.inf, np.float32)
        best[:, longest] = 0
        back = np.zeros((count, length + 1), np.int64)
        every = np.arange(count)
        for end in range(1, length + 1):
            reached = best[:, end : end + longest] + score[:, end]
            back[:, end] = reached.argmax(axis=1)
            best[:, end + longest] = reached[every, back[:, end]]
        at, rows, ids, ends = np.full(count, length), [], [], []
        alive = every
        while len(alive):
            choice = back[alive, at[alive]]
            got = piece[alive, at[alive], choice]
            rows.append(alive)
            ends.append(at[alive].copy())
            ids.append(np.where(got >= 0, got, -1 - cells[alive, at[alive] - 1].astype(np.int64)))
            at[alive] -= longest - choice
            alive = alive[at[alive] > 0]
        rows, ends, ids = (np.concatenate(x) for x in (rows, ends, ids))
        order = np.lexsort((ends, rows))
        rows, ids = rows[order], ids[order]
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):
            spelled = [self.byte_id[list((_SPACE if c == _ESCAPED else chr(c)).encode())] for c in (-1 - ids[unknown]).tolist()]
            size = np.ones(len(ids), np.int64)
            size[unknown] = [len(x) for x in spelled]
            out = np.repeat(ids, size)
            out[ragged((np.cumsum(size) - size)[unknown], size[unknown])] = np.concatenate(spelled)
            rows, ids = np.repeat(rows, size), out
        return ids.astype(np.int32), np.bincount(rows, minlength=count)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Bytes of each run of ids, with the space in front taken away."""
        ids = np.clip(ids, 0, len(self.size) - 1)
        size = self.size[ids]
        data = self.data[ragged(self.start[ids], size)].tobytes()
        ends = np.append(0, np.cumsum(size))[offsets]
        texts = (data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
        return [t[1:] if t[:1] == b" " else t for t in texts]


class Encoder:
    """Encodes texts and remembers words."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known = Remembered(self._learn, REMEMBERED)

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [w.decode() for w in words]
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        sizes, ids, i = [], [], 0
        while i < len(order):
            length = len(texts[order[i]])
            j = i
            while j < len(order) and len(texts[order[j]]) == length and (j - i) * length < CELLS:
                j += 1
            got, size = self.pieces.search([texts[k] for k in order[i:j]])
            ids.append(got)
            sizes.append(size)
            i = j
        size = np.concatenate(sizes)
        start = np.cumsum(size) - size
        back = np.argsort(order)
        return np.concatenate(ids)[ragged(start[back], size[back])], size[back]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text begins (and the last ends)."""
        raw, offsets = utf8(column)
        size = np.diff(offsets)
        some = (size > 0).astype(np.int64)
        edges = np.append(0, np.cumsum(size + some))
        data = np.full(edges[-1], 32, np.uint8)  # with a space before each text
        data[ragged(edges[:-1] + some, size)] = raw
        space = data == 32
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[edges[:-1][some > 0]] = True
        starts = np.flatnonzero(begin)
        ids, count = self.known.encode(data, starts, np.append(starts[1:], len(data)))
        return ids, np.append(0, np.cumsum(count))[np.searchsorted(starts, edges)]


def encode(
    docs: DataFrame, pieces: Pieces, *, text_column: str = "text", ids_column: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """Add the ids of every text as an array. ``keep`` names the input columns to carry along (all if None)."""
    docs = without(docs, [ids_column])
    names = docs.columns if keep is None else [c for c in docs.columns if c in keep]
    model = docs.sparkSession.sparkContext.broadcast(pieces)
    name = hash((pieces.keys.tobytes(), pieces.ids.tobytes(), pieces.scores.tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("pieces", name), lambda: Encoder(model.value))
        for batch in steps(batches, text_column, STEP, keeps=True):
            text = batch.column(text_column)
            ids, ends = encoder.encode(text)
            missing = text.is_null()
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids), mask=missing if text.null_count else None)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], ids], names=[*names, ids_column])

    schema = T.StructType([docs.schema[c] for c in names]).add(ids_column, T.ArrayType(T.IntegerType()))
    return docs.select([F.col(f"`{c}`") for c in dict.fromkeys([*names, text_column])]).mapInArrow(run, schema)


def decode(docs: DataFrame, pieces: Pieces, *, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """Add the text of every array of ids. Ids that spell no UTF-8 give U+FFFD; unknown ids give nothing."""
    docs = without(docs, [text_column])
    names = docs.columns
    model = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids_column)
            for i in range(0, batch.num_rows, 256):
                part = column.slice(i, 256)
                flat = part.flatten()
                ids = flat.fill_null(len(model.value.size)).to_numpy(zero_copy_only=False)
                size = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                texts = model.value.decode(ids, np.append(0, np.cumsum(size)))
                texts = [None if null else t.decode(errors="replace") for t, null in zip(texts, part.is_null().to_pylist(), strict=True)]
                rows = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, text_column])

    return docs.mapInArrow(run, T.StructType(docs.schema.fields[:]).add(text_column, "string"))
