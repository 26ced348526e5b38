"""SimHash near-duplicates found by meeting in the middle.

A document's fingerprint has bit i set if over half of its shingles' XXH64 numbers have it. Fingerprints that differ
in ``radius`` bits or fewer are linked; a document's component is named by its smallest id.

Every distinct fingerprint emits all numbers within half the radius of it (its variants). Two fingerprints are within
the radius exactly if they share a variant, so variants are brought together by a shuffle, and what collides is
checked bit by bit. Those at one variant all lie within the radius of any that is within half of it (rounded down):
each is tied to the smallest of those its bucket connects it with, which connects what all pairs would.

Variants far outweigh the texts they stand for (2,081 for 64 bits and radius 4), so they are never all there at once.
The XOR of the numbers of a variant's set bits, its syndrome, has 64 values; a pass takes the syndromes of one of
``PASSES`` equal groups, and a fingerprint reaches its variants of a syndrome by flips that are looked up, with none
thrown away. A variant travels as its fingerprint and the number of its flip, in blocks of one bucket each; the number
of buckets follows from the number of fingerprints, so that a bucket fits a task at any size. A variant cannot be
hot: at most 2,081 distinct fingerprints share it. Shuffle files go when their pass has ended.

Defined results: texts with fewer words than a shingle are one shingle; null texts and those without words have
fingerprint zero and are linked like others. Rows are judged one by one, so repeated rows and equal ids keep a row each. Null ids
name a component only if it has no other. An empty table gives no rows. Other columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.arrays import U64, mix, ragged
from recordloom.llm.tables import components, joined_by_key, settled
from recordloom.session import new_work_dir, written

SEED = 42
PASSES = 16
#: Variants a bucket holds on average, fingerprints a step takes, and shingles that are counted at once.
BUCKET, STEP, SHINGLES = 1 << 19, 1 << 12, 1 << 14
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None, width: int = 4) -> Iterator[list[int]]:
    """XXH64 numbers of a text's shingles, at most SHINGLES at once."""
    words = (text or "").encode().translate(_LOWER).split()  # at the six ASCII space characters
    if not words:
        return
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    starts = list(accumulate(map(len, words), lambda at, n: at + n + 1, initial=0))
    width = min(width, len(words))
    for i in range(0, len(words) - width + 1, SHINGLES):
        stop = min(i + SHINGLES, len(words) - width + 1)
        yield [hashed(joined[a : b - 1], SEED) for a, b in zip(starts[i:stop], starts[i + width : stop + width], strict=True)]


def bit_counts(hashes: np.ndarray, sizes: list[int]) -> np.ndarray:
    """How many numbers of each run have each bit set: runs x 64."""
    lanes = np.unpackbits(hashes.view(np.uint8), bitorder="little").view(U64).reshape(-1, 8)  # a byte counts to 255
    first = np.cumsum(sizes) - sizes
    groups = -(-np.array(sizes) // 255)
    starts = np.repeat(first, groups) + 255 * ragged(np.zeros(len(sizes), np.int64), groups)
    bytewise = np.add.reduceat(lanes, starts, axis=0).view(np.uint8)
    return np.add.reduceat(bytewise, np.cumsum(groups) - groups, axis=0, dtype=np.int64)


def fingerprints_of(texts: Iterable[str | None], width: int = 4) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    ones, total = [], []
    held: list[list[int]] = []
    owners: list[int] = []

    def count() -> None:
        if held:
            sizes = [len(h) for h in held]
            for i, n, c in zip(owners, sizes, bit_counts(np.array([x for h in held for x in h], U64), sizes), strict=True):
                ones[i] = ones[i] + c
                total[i] += n
        held.clear()
        owners.clear()

    waiting = 0
    for i, text in enumerate(texts):
        ones.append(np.zeros(64, np.int64))
        total.append(0)
        for hashes in shingle_hashes(text, width):
            held.append(hashes)
            owners.append(i)
            waiting += len(hashes)
            if waiting >= SHINGLES:
                count()
                waiting = 0
    count()
    if not ones:
        return np.zeros(0, U64)
    return np.packbits(2 * np.array(ones) > np.array(total)[:, None], axis=1, bitorder="little").view(U64).ravel()


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", width: int = 4) -> DataFrame:
    """One row per document: id and its fingerprint ``print`` (as a signed 64-bit number)."""
    read = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints_of((t.as_py() for t in batch.column("text")), width)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], names=["id", "print"])

    return read.mapInArrow(run, T.StructType([read.schema["id"]]).add("print", "long"))


class Flips:
    """All numbers with at most ``most`` set bits, by syndrome: the XOR of the numbers of their set bits."""

    def __init__(self, most: int):
        masks, syndromes = [], []
        for n in range(most + 1):
            for bits in combinations(range(64), n):
                masks.append(sum(1 << b for b in bits))
                syndromes.append(int(np.bitwise_xor.reduce(bits)) if bits else 0)
        order = np.argsort(syndromes, kind="stable")
        self.masks = np.array(masks, U64)[order]
        self.first = np.searchsorted(np.array(syndromes)[order], np.arange(65))

    def towards(self, prints: np.ndarray, syndrome: int) -> tuple[np.ndarray, np.ndarray]:
        """Every variant with that syndrome: which print it belongs to, and the number of its flip."""
        wanted = syndromes(prints) ^ syndrome
        first, count = self.first[wanted], self.first[wanted + 1] - self.first[wanted]
        return np.repeat(np.arange(len(prints)), count), ragged(first, count)


def syndromes(numbers: np.ndarray) -> np.ndarray:
    """For each number, the XOR of the numbers of its set bits."""
    out = np.zeros(len(numbers), np.int64)
    for k in range(6):
        of = U64(sum(1 << b for b in range(64) if b >> k & 1))
        out |= (np.bitwise_count(numbers & of).astype(np.int64) & 1) << k
    return out


def tied(prints: np.ndarray, flips: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) that connect the prints which share a variant (print ^ flip) as all their pairs would.

    With an odd radius, prints that both are half of it rounded up away are not linked by that variant.
    """
    variant = prints ^ flips
    ordered = np.sort(variant)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return shared, shared
    place = np.minimum(np.searchsorted(shared, variant), len(shared) - 1)
    some = np.flatnonzero(shared[place] == variant)
    own, node = np.unique(prints[some], return_inverse=True)
    near = np.bitwise_count(flips[some]) <= radius // 2
    order = np.lexsort((~near, place[some]))
    node, group, near = node[order], place[some][order], near[order]
    led = np.flatnonzero(np.append(True, group[1:] != group[:-1]) & near)
    stays = np.isin(group, group[led])
    node, group = node[stays], group[stays]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else group
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(group))))
    if (np.bitwise_count(own[node] ^ own[node[first]][of]) > radius).any():
        raise AssertionError("a print at a variant lies within the radius of those within half of it")
    label = np.arange(len(own))
    while len(node):  # the smallest print of each group, then of what that one was tied to
        low = np.minimum.reduceat(label[node], first)
        new = label.copy()
        np.minimum.at(new, node, low[of])
        new = new[new]
        if (new == label).all():
            break
        label = new
    tie = np.flatnonzero(label != np.arange(len(own)))
    return own[tie], own[label[tie]]


def links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Links a - b that connect the distinct fingerprints (column ``print``) as all pairs within the radius would."""
    spark = prints.sparkSession
    flips = Flips(-(-radius // 2))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = prints.count()
    buckets = max(1, n * len(flips.masks) // (PASSES * BUCKET))
    found = []
    for k in range(PASSES):
        mine = range(k * 64 // PASSES, (k + 1) * 64 // PASSES)

        def emit(batches: Iterator[pa.RecordBatch], mine=mine) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, STEP):
                    own = batch.column("print").slice(at, STEP).to_numpy().view(U64)
                    reached = [flips.towards(own, s) for s in mine]
                    row, flip = (np.concatenate([r[i] for r in reached]) for i in (0, 1))
                    bucket = (mix(own[row] ^ flips.masks[flip]) % U64(buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    edges = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets < len(order) else None
                    some = np.unique(bucket) if edges is None else np.flatnonzero(np.diff(edges))
                    first = np.searchsorted(bucket[order], some)
                    last = np.append(first[1:], len(order))
                    data = (own[row[order]].tobytes(), flip[order].astype(np.uint16).tobytes())
                    columns = [pa.array(some), *[pa.array([d[a * w : b * w] for a, b in zip(first.tolist(), last.tolist(), strict=True)], pa.binary()) for d, w in zip(data, (8, 2), strict=True)]]
                    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "prints", "flips"])

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[bytes, bytes]] = []
            bucket = None

            def out() -> pa.RecordBatch:
                own, flip = (np.frombuffer(b"".join(h[i] for h in held), kind) for i, kind in ((0, U64), (1, np.uint16)))
                a, b = tied(own, flips.masks[flip], radius)
                return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

            for batch in batches:
                for row in zip(*[batch.column(c).to_pylist() for c in ("bucket", "prints", "flips")], strict=True):
                    if row[0] != bucket and held:
                        yield out()
                        held.clear()
                    bucket = row[0]
                    held.append(row[1:])
            if held:
                yield out()

        blocks = prints.select("print").mapInArrow(emit, "bucket long, prints binary, flips binary")
        dealt = blocks.repartition(parts, "bucket").sortWithinPartitions("bucket")
        met = dealt.mapInArrow(meet, "a long, b long").distinct()
        found.append(settled(met, new_work_dir(spark, "links")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return settled(out.distinct(), new_work_dir(spark, "links"))


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """One row per document: its id, fingerprint (16 hex digits) and component_id."""
    spark = docs.sparkSession
    rows = written(fingerprints(docs, id_column=id_column, text_column=text_column, width=width), new_work_dir(spark, "fingerprints"))
    prints = written(rows.groupBy("print").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), new_work_dir(spark, "prints"))
    label = components(links(prints, radius))
    label = prints.join(label, F.col("print") == F.col("node"), "left").select("print", "least", "n", F.coalesce("label", "print").alias("label"))
    label = written(label, new_work_dir(spark, "labels"))
    least = label.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size"))
    # most prints are alone: only those of larger components are joined with their component's smallest id
    named = label.join(least.where("size > 1").drop("size"), "label", "left").select("print", "n", F.coalesce("component_id", "least").alias("component_id"))
    out = joined_by_key(rows, written(named, new_work_dir(spark, "components")), "print", "n")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return out.select(F.col("id").alias(id_column), digits.alias("fingerprint"), "component_id")
