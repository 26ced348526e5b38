"""Product codes of vectors: every part of a vector becomes the index of the nearest entry of a small codebook.

All arithmetic is on integers: a component x is floor(scale * x). Vectors are cut into equal consecutive parts; the
codebook of each part position starts as that part of the vectors with the smallest ids and is refined in rounds
(assign every part, then move each entry to the floor of the mean of its parts).

The nearest entry is found in the Walsh-Hadamard domain: parts and entries are padded with zeros to a power of two
and transformed, which multiplies every squared distance by that power. Squared differences are added up coefficient
by coefficient in sequency order; what is added up so far never exceeds the whole, so an entry is out as soon as it
exceeds the whole distance of one other entry. Entries as near as the nearest are never out; of those the lowest
index is taken.

A round reads the vectors once; tasks emit sums per part and entry (``parts`` x ``entries`` rows at most), and the
codebooks, of a size set by parameters and the width of the vectors, are all that passes through the driver.

Defined results: vectors that are null or hold null or non-finite components are left out, and so are those with a
component whose product with the scale is beyond 2 ** 61, which no 64-bit arithmetic holds. Vectors narrower than
the widest, and widths that ``parts`` does not divide, are padded with zeros. Null ids rank last, vectors with equal
ids by their components; every row is coded. With fewer vectors than entries the codebooks are smaller. An error
beyond 64 bits is null. An empty table gives no rows. Other columns of the input are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.session import new_work_dir, written

LARGEST = 1 << 61
#: Rows looked at in one step.
STEP_ROWS = 4096
#: Into how many groups the rows of one label are dealt before their sum is joined to them.
SALTS = 32


def usable(vector: Column, scale: int) -> Column:
    """Whether a vector takes part."""
    bound = LARGEST / scale
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(x.between(-bound, bound), F.lit(False)))


def sequency(width: int) -> np.ndarray:
    """Numbers of the Walsh-Hadamard functions as the butterfly leaves them, ordered by sign changes."""
    odd = np.array([[(a & b).bit_count() & 1 for b in range(width)] for a in range(width)])
    return np.argsort((odd[:, 1:] != odd[:, :-1]).sum(axis=1), kind="stable")


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """Transform of rows whose length is a power of two, coefficients in sequency order."""
    rows, width = x.shape
    step = 1
    while step < width:
        low, high = np.split(x.reshape(rows, -1, 2, step), 2, axis=2)
        x = np.concatenate([low + high, low - high], axis=2).reshape(rows, width)
        step *= 2
    return x[:, sequency(width)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry to each part, the lowest of equally near ones, and its squared distance."""
    size = 1 << max(parts.shape[1] - 1, 0).bit_length()
    largest = max((int(np.abs(a).max(initial=0)) for a in (parts, entries)), default=0)
    exact = np.int64 if size * size * 4 * largest * largest < 1 << 62 else object
    x, c = (walsh_hadamard(np.pad(a, ((0, 0), (0, size - a.shape[1]))).astype(exact)) for a in (parts, entries))
    near = (x[:, :1] - c[:, 0]) ** 2
    guess = near.argmin(axis=1)
    most = ((x - c[guess]) ** 2).sum(axis=1)  # the whole distance of one entry bounds the least
    row, entry = np.nonzero(near <= most[:, None])
    near = near[row, entry]
    for k in range(1, size):
        near = near + (x[row, k] - c[entry, k]) ** 2
        stays = near <= most[row]
        row, entry, near = row[stays], entry[stays], near[stays]
    if not len(row):
        return entry, near
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))  # every row keeps one entry at least
    least = np.minimum.reduceat(near, first)
    best = np.flatnonzero(near == least[row])
    _, lowest = np.unique(row[best], return_index=True)  # entries ascend within a row
    return entry[best[lowest]], least // size


def integers(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the components, padded with zeros to the width."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).astype(np.int64)
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


class Codebooks:
    """Entries of every part position: parts x entries x components of a part."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    @classmethod
    def first(cls, vectors: np.ndarray, parts: int) -> Codebooks:
        return cls(vectors.reshape(len(vectors), parts, -1).swapaxes(0, 1))

    @property
    def sha256(self) -> str:
        """Digest of all components as decimal numbers, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _assigned(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance for every vector (rows) and part (columns)."""
    cut = vectors.reshape(len(vectors), len(entries), -1)
    found = [nearest(cut[:, part], entries[part]) for part in range(len(entries))]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _refined(kept: DataFrame, books: Codebooks, scale: int) -> Codebooks:
    """The codebooks after one round."""
    entries = books.entries
    parts, count, size = entries.shape
    width = parts * size

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(entries.shape, object), np.zeros((parts, count), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                vectors = integers(batch.column("vector").slice(at, STEP_ROWS), width, scale)
                index, _ = _assigned(vectors, entries)
                place = (index + np.arange(parts) * count).ravel()
                cut = vectors.reshape(-1, size)
                fits = int(np.abs(cut).max(initial=0)) * len(cut) < 1 << 62
                step = np.zeros((parts * count, size), np.int64 if fits else object)
                np.add.at(step, place, cut if fits else cut.astype(object))
                total += step.astype(object).reshape(entries.shape)
                n += np.bincount(place, minlength=parts * count).reshape(n.shape)
        part, entry = np.nonzero(n)
        totals = pa.array([[Decimal(v) for v in total[p, e]] for p, e in zip(part, entry, strict=True)], pa.list_(pa.decimal128(38, 0)))
        columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), totals]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "total"])

    partial = kept.select("vector").mapInArrow(sums, "part int, entry int, n long, total array<decimal(38,0)>")
    totals = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(size)]
    new = entries.astype(object)
    for row in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():  # parts x entries rows
        new[row.part, row.entry] = [int(row[f"t{i}"]) // row.n for i in range(size)]
    return Codebooks(new.astype(np.int64))


def _kept(vectors: DataFrame, id_column: str, vector_column: str, label_column: str | None, scale: int) -> DataFrame:
    label = F.lit(None).cast("int") if label_column is None else F.col(f"`{label_column}`")
    named = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("vector"), label.alias("label"))
    return named.where(usable(F.col("vector"), scale))


def train(kept: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> Codebooks | None:
    """Codebooks of the vectors (columns id and vector); none without vectors."""
    widest = kept.agg(F.max(F.size("vector")).alias("n")).first().n
    if widest is None:
        return None
    width = -(-max(widest, 1) // parts) * parts
    start = kept.select("id", "vector").orderBy(F.asc_nulls_last("id"), "vector").limit(entries).toArrow()
    books = Codebooks.first(integers(start["vector"], width, scale), parts)
    for _ in range(rounds):
        books = _refined(kept, books, scale)
    return books


def compress(
    vectors: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str | None = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
) -> DataFrame:
    """The id of every vector that takes part, its code (two hex digits a part), error (squared distances summed over
    the parts), label_error (errors summed over equal labels, nulls together; with a label column) and codebooks_sha256."""
    if entries > 256:
        raise ValueError("two hex digits number 256 entries at most")
    spark = vectors.sparkSession
    kept = _kept(vectors, id_column, vector_column, label_column, scale)
    schema = T.StructType([kept.schema["id"], kept.schema["label"]]).add("code", "string").add("error", "long")
    books = train(kept, parts, entries, rounds, scale)
    if books is None:
        return _named(spark.createDataFrame([], schema).withColumn("label_error", F.lit(None).cast("long")), None, id_column, label_column)
    table = books.entries

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                rows = batch.slice(at, STEP_ROWS)
                index, distance = _assigned(integers(rows.column("vector"), table.shape[0] * table.shape[2], scale), table)
                digits = index.astype(np.uint8).tobytes().hex()
                codes = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
                errors = [e if e < 1 << 63 else None for e in distance.astype(object).sum(axis=1).tolist()]
                columns = [rows.column("id"), rows.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    coded = kept.select("id", "vector", "label").mapInArrow(code, schema)
    if label_column is None:
        return _named(coded, books.sha256, id_column, label_column)
    coded = written(coded, new_work_dir(spark, "codes"))
    salt = F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int")
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = coded.withColumn("salt", salt).alias("c").join(sums.alias("s"), F.expr("c.label <=> s.label AND c.salt = s.salt"))
    return _named(joined.select("c.id", "c.code", "c.error", "s.label_error"), books.sha256, id_column, label_column)


def _named(coded: DataFrame, digest: str | None, id_column: str, label_column: str | None) -> DataFrame:
    columns = ["code", "error", *["label_error"] * (label_column is not None)]
    return coded.select(F.col("id").alias(id_column), *columns, F.lit(digest).cast("string").alias("codebooks_sha256"))
