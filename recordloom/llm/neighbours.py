"""Exact nearest neighbours by a block matrix join over int8 tiles.

Vectors are packed into blocks. Every block of queries meets every block of candidates once: blocks of candidates
form groups, each block of queries is copied to every group, and a task multiplies two int8 matrices. The product
of two rounded unit vectors is off by at most what the rounding took from both, which gives each cosine a lower and an upper
bound. A candidate survives if its upper bound reaches the k-th best lower bound of its query; survivors are
recomputed in double precision from the original vectors and kept in a heap of k per query, and the heaps of all
tiles are merged.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, neither
as queries nor as candidates; of vectors with different numbers of components only those with the most common
(of equally common ones the larger) number do. Ties go to the smaller id; a row with a null id takes no part. Of
rows with one id the smallest vector counts, and a query does not find its own id. With fewer candidates than k all are found. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.session import new_work_dir, written

#: Vectors in a block: a tile of float32 products is 16 MB.
BLOCK = 2048
#: Blocks of rows that the queries are copied to together.
GROUP = 16
#: Parts in which the heaps of a query are merged at first.
PARTS = 64
_PACKED = "side string, block long, size int, ids binary, vectors binary"


def _pack(side: str, width: int):
    """Blocks of the valid vectors of one partition; blocks are numbered by partition and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, vectors = np.zeros(0, np.int64), np.zeros((0, width))

        def block(n: int) -> pa.RecordBatch:
            columns = ([side], [number], [n], [ids[:n].tobytes()], [vectors[:n].tobytes()])
            types = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["side", "block", "size", "ids", "vectors"])

        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                ids = np.append(ids, part.column("id").to_numpy())
                vectors = np.append(vectors, flat.reshape(-1, width), axis=0)
                while len(ids) >= BLOCK:
                    yield block(BLOCK)
                    number += 1
                    ids, vectors = ids[BLOCK:], vectors[BLOCK:]
        if len(ids):
            yield block(len(ids))

    return run


def _rounded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 numbers, their scale and the length of what rounding took, for unit vectors."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    unit = vectors / largest  # first by the largest component, so that no square overflows or vanishes
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127
    small = np.rint(unit / scale)
    lost = np.sqrt(((unit - small * scale) ** 2).sum(axis=1))
    return small.astype(np.int8), scale[:, 0], lost


def _ordered_sum(products: np.ndarray) -> np.ndarray:
    """Sums from the first component to the last, one rounding a step."""
    return np.add.accumulate(products, axis=1)[:, -1]


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the rows of ``a`` with those of ``b`` in double precision.

    Rows are first scaled by a power of two, which changes no digit and keeps products in range.
    """
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (a, b))
    product, x, y = _ordered_sum(a * b), _ordered_sum(a * a), _ordered_sum(b * b)
    return product / np.sqrt(x * y)


def _tile(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = defaultdict(list)
        sides: dict[int, tuple] = {}

        def unpacked(batch: pa.RecordBatch, i: int, side: str) -> tuple:
            ids = np.frombuffer(batch.column(f"{side}_ids")[i].as_py(), np.int64)
            vectors = np.frombuffer(batch.column(f"{side}_vectors")[i].as_py(), np.float64).reshape(-1, width)
            return (ids, vectors, *_rounded(vectors))

        current = None
        for whole in batches:
            for i in range(whole.num_rows):
                block = whole.column("query_block")[i].as_py()
                if block != current:
                    if heaps:
                        yield _rows(heaps)
                        heaps.clear()
                    current, sides = block, {0: unpacked(whole, i, "query")}
                ids, vectors, small, scale, lost = sides[0]
                other, others, small2, scale2, lost2 = unpacked(whole, i, "row")
                # products of int8 numbers summed in float32 are exact as long as width * 127 ** 2 < 2 ** 24
                kind = np.float32 if width * 127**2 < 1 << 24 else np.float64
                product = (small.astype(kind) @ small2.astype(kind).T).astype(np.float64)
                about = product * scale[:, None] * scale2[None, :]
                error = lost[:, None] + (1 + lost[:, None]) * lost2[None, :] + 1e-12
                own = ids[:, None] == other[None, :]
                low = np.where(own, -np.inf, about - error)
                n = min(k, len(other))
                best = -np.partition(-low, n - 1, axis=1)[:, n - 1] if n == k else np.full(len(ids), -np.inf)
                known = np.array([heaps[q][0][0] if len(heaps[q]) == k else -np.inf for q in ids.tolist()])
                row, col = np.nonzero((about + error >= np.maximum(best, known)[:, None]) & ~own)
                for start in range(0, len(row), 1 << 14):
                    r, c = row[start : start + (1 << 14)], col[start : start + (1 << 14)]
                    for q, score, found in zip(ids[r].tolist(), _cosine(vectors[r], others[c]).tolist(), other[c].tolist(), strict=True):
                        heap, entry = heaps[q], (score, -found)
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
        if heaps:
            yield _rows(heaps)

    return run


def _rows(heaps: dict[int, list[tuple[float, int]]]) -> pa.RecordBatch:
    rows = [(q, -found, score) for q, heap in heaps.items() for score, found in heap]
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)]
    part = pa.array([TaskContext.get().partitionId() % PARTS] * len(rows), pa.int32())
    return pa.RecordBatch.from_arrays([*arrays, part], names=["query_id", "vec_id", "score", "part"])


def nearest(
    rows: DataFrame, queries: Column, *, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows by cosine of every row for which ``queries`` holds: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    read = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), vector.alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked"))
    finite = "NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(vector, x -> x != 0)"
    valid = read.where(f"id IS NOT NULL AND vector IS NOT NULL AND {finite}")
    widths = valid.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = widths[0]["width"]
    valid = valid.where(F.size("vector") == width).groupBy("id").agg(F.min("vector").alias("vector"), F.max("asked").alias("asked"))
    asked = valid.where("asked").select("id", "vector").mapInArrow(_pack("query", width), _PACKED)
    asked = written(asked, new_work_dir(spark, "query_blocks"))
    all_rows = written(valid.select("id", "vector").mapInArrow(_pack("row", width), _PACKED), new_work_dir(spark, "row_blocks"))
    # queries are fewer: they are copied to groups of row blocks, each of which moves once
    groups = max(1, -(-all_rows.count() // GROUP))
    to = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    left = asked.select(to, F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"))
    dealt = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group")
    right = all_rows.select(dealt, F.col("ids").alias("row_ids"), F.col("vectors").alias("row_vectors"))
    found = left.join(right, "group").mapInArrow(_tile(k, width), "query_id long, vec_id long, score double, part int")
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score"))), 1, k).alias("best")
    some = found.groupBy("query_id", "part").agg(best).select("query_id", F.explode("best").alias("b")).select("query_id", "b.vec_id", "b.score")
    merged = some.groupBy("query_id").agg(best)
    return merged.select("query_id", F.posexplode("best").alias("at", "b")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")
