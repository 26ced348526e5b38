"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded, verified.

A document is a bag of shingles of five words (all its words, if it has fewer). A shingle weighs its count times
the mean inverse document frequency of its words, 1 + ln(N / df) / ln(N), with df counted over all N documents in
a table of hashed words of fixed size. Improved consistent weighted sampling draws SAMPLES samples of each bag:
two documents share a sample with a probability equal to their weighted Jaccard similarity. BANDS bands of samples
are hashed; documents that share a band are candidates, and a candidate pair is a link if the weighted Jaccard
similarity of the whole bags is ``similarity`` or more. A class is a connected set of links.

How a band with many documents is searched: documents with the same words are one node. In a task, each node of a
band is compared (by the share of equal samples) with the band's leaders so far; it becomes a leader itself unless
it is as similar to one as a link asks for. Bands of many nodes are first searched in salted parts, then their leaders
together. Each band has an order of its own, so that a node that one leader does not represent well meets others.
In the first search a node gives one pair, with the leader most like it; the pairs are verified and make classes.
The second search goes through the bands that hold several classes and compares nodes with leaders of other classes
only, by the KEPT smallest shingles of each bag, which for short texts are all. What may be a link is verified, too.
Of the nodes a leader stands for each is compared, unless their distance from it tells that none can be near enough.
A band of near copies that are less similar to each other than a link asks for thus gives few pairs, not its square.

Defined results: null, empty and wordless texts have no near-duplicates, each is a class of its own. Texts that
differ only in case, punctuation or spacing have similarity 1. Rows with the same id and text are one document.
Result columns replace input columns of the same name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.arrays import U64, Words, mix, row_key, steps, utf8, without
from recordloom.session import new_work_dir, written

SHINGLE = 5
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
DF_BITS = 18
#: A share of equal samples this far below the similarity asked for makes no candidate (in the first search, which only
#: has to find most classes, FIRST_MARGIN); from SURELY on one node stands for another.
MARGIN, FIRST_MARGIN, SURELY = 0.3, 0.25, 0.8
#: Shingles kept of a node in the search between classes, and how far below the similarity their estimate may lie; if
#: fewer than EVEN shingles of equal weight would tell as much as the kept ones, only the samples count.
KEPT, KEPT_MARGIN, EVEN = 256, 0.15, 128
#: Nodes of a band that one task searches together at first.
PART = 1000
ID, KEY = "__id", "__row_key"
U32 = np.uint32


def _gamma_table(size: int = 1 << 16) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, whose distribution function is 1 - (1 + x) exp(-x)."""
    want = (np.arange(size) + 0.5) / size
    low, high = np.zeros(size), np.full(size, 64.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < want
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


class Sampler:
    """Improved consistent weighted sampling with variates derived from the shingle's 64-bit number."""

    def __init__(self):
        gamma = _gamma_table()
        self.gamma, self.log_gamma = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        k = mix(np.arange(1, 3 * SAMPLES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
        self.a, self.b, self.c = ((k[i * SAMPLES : (i + 1) * SAMPLES] >> U64(32)).astype(U32)[:, None] | U32(1) for i in range(3))

    def samples(self, number: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """SAMPLES 64-bit numbers of one bag; each tells the shingle drawn and its quantised weight."""
        low, high = number.astype(U32)[None, :], (number >> U64(32)).astype(U32)[None, :]
        log_weight = np.log(weight).astype(np.float32)[None, :]
        best, shingle, step = None, None, None
        every = np.arange(SAMPLES)
        for i in range(0, len(number), 1024):
            part = slice(i, i + 1024)
            x = low[:, part] * self.a + high[:, part] * self.b + self.c
            x ^= x >> U32(16)
            x *= U32(0x7FEB352D)
            x ^= x >> U32(15)
            y = x * U32(0x846CA68B)
            y ^= y >> U32(16)
            r = self.gamma[x & U32(0xFFFF)]
            beta = y.astype(np.float32) * np.float32(2.0**-32)
            t = log_weight[:, part] / r
            t += beta
            np.floor(t, out=t)
            rank = self.log_gamma[x >> U32(16)] - r * (t - beta + np.float32(1))
            at = rank.argmin(axis=1)
            value = rank[every, at]
            if best is None:
                best, shingle, step = value, number[part][at], t[every, at]
            else:
                less = value < best
                best = np.where(less, value, best)
                shingle = np.where(less, number[part][at], shingle)
                step = np.where(less, t[every, at], step)
        return mix(shingle + mix(step.astype(np.int64).view(U64) + U64(17)))


def bags(words: Words, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted shingles of some texts: first shingle of each text (and the end), numbers in order, weights."""
    at, text, number = words.windows(SHINGLE)
    value = np.zeros(len(words.starts) + 1)
    np.cumsum(idf[words.hashes >> U64(64 - DF_BITS)], out=value[1:])
    weight = (value[at + SHINGLE] - value[at]) / SHINGLE
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        mean = (value[words.first[short + 1]] - value[words.first[short]]) / words.counts[short]
        text, number, weight = np.append(text, short), np.append(number, words.whole(short)), np.append(weight, mean)
    order = np.lexsort((number, text))
    text, number, weight = text[order], number[order], weight[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(text)))
    # the mean is taken on a coarse grid, so that it is the same wherever the shingle stands
    weight = np.rint(weight[at] * 1024) / 1024 * count
    return np.searchsorted(text[at], np.arange(len(words.counts) + 1)), number[at], weight


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Inverse document frequency of every hashed word, counted over all rows of column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(1 << DF_BITS, np.int64), 0
        for batch in steps(batches, "text"):
            words = Words(*utf8(batch.column("text")))
            text = np.repeat(np.arange(batch.num_rows), words.counts)
            both = np.sort((words.hashes >> U64(64 - DF_BITS)).astype(np.int64) + (text << DF_BITS))
            both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
            found += np.bincount(both & ((1 << DF_BITS) - 1), minlength=1 << DF_BITS)
            rows += batch.num_rows
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(found[some], rows))], names=["word", "n"])

    table = texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()  # 2 ** DF_BITS + 1 rows at most
    word, n = table["word"].to_numpy(), table["n"].to_numpy()
    rows = int(n[word == -1].sum())
    idf = np.ones(1 << DF_BITS)
    if rows > 1:
        idf += 1  # a word not counted has been seen nowhere else
        idf[word[word >= 0]] = 1 + np.log(rows / n[word >= 0]) / np.log(rows)
    return idf


def _sketches(read: DataFrame, idf) -> DataFrame:
    """Per row: __id, __row_key, node (16 bytes that stand for its words), bands, samples (one byte each)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in steps(batches, "text"):
            words = Words(*utf8(batch.column("text")))
            first, number, weight = bags(words, idf.value)
            some = np.flatnonzero(words.counts)
            nodes = np.stack([words.whole(some, s) for s in (1, 2)], axis=1)
            drawn = np.array([sampler.samples(number[a:b], weight[a:b]) for a, b in zip(first[some], first[some + 1], strict=True)], U64).reshape(-1, SAMPLES)
            bands = drawn.reshape(-1, BANDS, ROWS)
            band = np.zeros(bands.shape[:2], U64) + np.arange(BANDS, dtype=U64)
            for r in range(ROWS):
                band = mix(band * U64(31) + bands[:, :, r])
            rows = pa.array(some)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(ID).take(rows),
                    batch.column(KEY).take(rows),
                    pa.array([n.tobytes() for n in nodes], pa.binary()),
                    pa.FixedSizeListArray.from_arrays(pa.array(band.ravel().view(np.int64)), BANDS).cast(pa.list_(pa.int64())),
                    pa.array([d.tobytes() for d in (drawn >> U64(56)).astype(np.uint8)], pa.binary()),
                ],
                names=[ID, KEY, "node", "bands", "samples"],
            )

    schema = T.StructType(read.schema.fields[:2]).add("node", "binary").add("bands", T.ArrayType(T.LongType())).add("samples", "binary")
    return read.mapInArrow(sketch, schema)


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of sorted batches that belong together; a group comes in several pieces if it spans batches."""
    for batch in batches:
        rows = batch.to_pylist()
        for key, members in itertools.groupby(rows, lambda r: tuple(r[c] for c in by)):
            yield key, list(members)


def _sorted(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a group in one task, in an order that differs from band to band."""
    return rows.repartition(*by).sortWithinPartitions(*by, F.xxhash64("band", "node"), "node")


class _Leaders:
    """Samples of the leaders of a group as one growing matrix."""

    def __init__(self):
        self.samples, self.rows = np.zeros((16, SAMPLES), np.uint8), []

    def equal(self, drawn: np.ndarray) -> np.ndarray:
        """Share of samples that each leader has in common with a node."""
        return (self.samples[: len(self.rows)] == drawn).sum(axis=1) / SAMPLES

    def add(self, drawn: np.ndarray, row) -> None:
        if len(self.rows) == len(self.samples):
            self.samples = np.concatenate([self.samples, np.zeros_like(self.samples)])
        self.samples[len(self.rows)] = drawn
        self.rows.append(row)


def _search(rows: DataFrame, by: list[str], maybe: float) -> DataFrame:
    """In groups of ``by``: a node and the leader most like it (a, b, share of equal samples); and each leader (a alone)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.float64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["band", "a", "b", "equal", "samples"])

        def led() -> Iterator[pa.RecordBatch]:
            for i in range(0, len(leaders.rows), 4096):
                yield table([(group[0], n, None, None, s.tobytes()) for n, s in zip(leaders.rows[i : i + 4096], leaders.samples[i:], strict=False)])

        group, leaders = None, _Leaders()
        for key, members in _groups(batches, by):
            if key != group:
                yield from led()
                group, leaders = key, _Leaders()
            out = []
            for row in members:
                drawn = np.frombuffer(row["samples"], np.uint8)
                equal = leaders.equal(drawn)
                near = np.flatnonzero(equal >= maybe)
                if len(near):
                    best = near[equal[near].argmax()]
                    out.append((key[0], row["node"], leaders.rows[best], float(equal[best]), None))
                if not len(near) or equal[best] < SURELY:
                    leaders.add(drawn, row["node"])
            yield table(out)
        yield from led()

    return _sorted(rows, by).mapInArrow(find, "band long, a binary, b binary, equal double, samples binary")


def candidates(nodes: DataFrame, maybe: float) -> DataFrame:
    """Each node with the leaders most like it, one of each band at most (a, b, share of equal samples)."""
    spark = nodes.sparkSession
    in_band = nodes.select("node", F.explode("bands").alias("band"))
    shared = in_band.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = in_band.join(shared, "band").join(nodes.select("node", "samples"), "node")
    rows = rows.withColumn("part", F.expr(f"pmod(xxhash64(node), 1 + n div {PART})"))
    found = written(_search(rows, ["band", "part"], maybe), new_work_dir(spark, "candidates"))
    big = shared.where(F.col("n") >= PART).select("band")
    leaders = found.where("b IS NULL").join(big, "band", "left_semi").select("band", F.col("a").alias("node"), "samples")
    both = found.unionByName(_search(leaders, ["band"], maybe)).where("b IS NOT NULL")
    return written(both.groupBy("a", "b").agg(F.max("equal").alias("equal")), new_work_dir(spark, "pairs"))


def _shingles(texts: DataFrame, idf) -> DataFrame:
    """Of each text's bag the KEPT shingles with the smallest numbers, and their weights; mostly the whole bag. ``even``
    is how many shingles of equal weight would tell as much: few, if some weigh far more than others."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            first, number, weight = bags(Words(*utf8(batch.column("text"))), idf.value)
            parts = [slice(a, min(a + KEPT, b)) for a, b in itertools.pairwise(first)]
            numbers = pa.array([number[p].tobytes() for p in parts], pa.binary())
            weights = pa.array([weight[p].tobytes() for p in parts], pa.binary())
            even = []
            for a, b in itertools.pairwise(first):
                w = weight[a:b]
                even.append(float(w.sum() ** 2 / max((w * w).sum(), 1e-12) * min(1, KEPT / max(b - a, 1))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), numbers, weights, pa.array(even, pa.float64())], names=["node", "numbers", "weights", "even"]
            )

    return texts.select("node", "text").mapInArrow(keep, "node binary, numbers binary, weights binary, even double")


class _Bag:
    """The smallest shingles of a text, up to ``last`` all of them."""

    def __init__(self, row: dict):
        self.row = row
        self.numbers, self.weights = np.frombuffer(row["numbers"], U64), np.frombuffer(row["weights"], np.float64)
        self.whole = len(self.numbers) < KEPT
        self.last = U64(2**64 - 1) if self.whole else self.numbers[-1]
        self.sums = np.append(0, self.weights.cumsum())
        self.drawn = np.frombuffer(row["samples"], np.uint8)

    def similar(self, others: list[_Bag]) -> np.ndarray:
        """Weighted Jaccard similarity to each of the others, over the shingles known of both; exact for whole bags."""
        last = np.minimum(self.last, np.array([o.last for o in others], U64))
        sizes = np.array([len(o.numbers) for o in others])
        numbers = np.concatenate([o.numbers for o in others])
        at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
        same = (self.numbers[at] == numbers) & (numbers <= np.repeat(last, sizes))
        least = np.where(same, np.minimum(self.weights[at], np.concatenate([o.weights for o in others])), 0)
        both = np.add.reduceat(least, sizes.cumsum() - sizes)
        mine = self.sums[np.searchsorted(self.numbers, last, side="right")]
        theirs = np.array([o.sums[np.searchsorted(o.numbers, x, side="right")] for o, x in zip(others, last, strict=True)])
        return both / np.maximum(mine + theirs - both, 1e-12)


class _Classes:
    """Classes of a group, joined as links are found in it."""

    def __init__(self):
        self.joined: dict[bytes, bytes] = {}

    def of(self, bag: _Bag) -> bytes:
        label = bag.row["label"]
        while label in self.joined:
            above = self.joined[label]
            self.joined[label] = self.joined.get(above, above)
            label = above
        return label

    def links(self, bag: _Bag, others: list[_Bag], similarity: float) -> Iterator[_Bag]:
        """Those of the others that may be linked with a node of another class. A link that is sure joins the classes."""
        others = [o for o in others if self.of(o) != self.of(bag)]
        for o, s in zip(others, bag.similar(others) if others else [], strict=True):
            exact = bag.whole and o.whole
            mine, theirs = self.of(bag), self.of(o)
            if theirs == mine:
                continue
            told = exact or min(bag.row["even"], o.row["even"]) >= EVEN
            if told and s < similarity - (1e-9 if exact else KEPT_MARGIN):
                continue
            yield o
            if exact and s >= similarity + 1e-9:
                self.joined[theirs] = mine


#: What the search between classes gives back: pairs (a, b), and nodes with their leaders (a, leader).
APART = "band long, a binary, b binary, leader binary, least double"


def _apart_rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [()] * 5
    kinds = [pa.int64(), *[pa.binary()] * 3, pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["band", "a", "b", "leader", "least"])


def _search_apart(rows: DataFrame, by: list[str], similarity: float) -> DataFrame:
    """In groups of ``by``: pairs of nodes of different classes that may be a link (a, b); and, in bands of several
    parts, each node with the leader that stands for it (a, leader), for leaders with ``least``, the smallest share of
    samples a node it stands for has in common with it.

    A node is stood for by a leader of its own class within SURELY of it. Shares of unlike samples are distances, so a
    leader far enough from a node, by ``least``, has none near it; of other leaders every node is compared, unless it is
    of the node's class. Links known exactly join their classes for the rest of the group."""
    maybe, many = similarity - MARGIN - 1e-9, PART

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def led() -> Iterator[pa.RecordBatch]:
            alone = [(group[0], f[0].row["node"], None, f[0].row["node"], float(n)) for f, n in zip(leaders.rows, least, strict=True) if f[0].row["n"] >= many]
            if alone:
                yield _apart_rows(alone)

        group, leaders, least, classes = None, _Leaders(), [], _Classes()
        for key, members in _groups(batches, by):
            if key != group:
                yield from led()
                group, leaders, least, classes = key, _Leaders(), [], _Classes()
            out = []
            for row in members:
                bag = _Bag(row)
                equal = leaders.equal(bag.drawn)
                families = [leaders.rows[i] for i in np.flatnonzero(equal >= maybe - 1 + np.array(least))]
                others = [o for f in families if classes.of(f[0]) != classes.of(bag) for o in f]
                if others:
                    drawn = np.stack([o.drawn for o in others])
                    others = [others[i] for i in np.flatnonzero((drawn == bag.drawn).sum(axis=1) >= maybe * SAMPLES)]
                    out += [(key[0], row["node"], o.row["node"], None, None) for o in classes.links(bag, others, similarity)]
                own = [i for i in np.flatnonzero(equal >= SURELY) if leaders.rows[i][0].row["label"] == row["label"]]
                if own:
                    at = max(own, key=lambda i: equal[i])
                    leaders.rows[at].append(bag)
                    least[at] = min(least[at], equal[at])
                    if row["n"] >= many:
                        out.append((key[0], row["node"], None, leaders.rows[at][0].row["node"], None))
                else:
                    leaders.add(bag.drawn, [bag])
                    least.append(1.0)
            yield _apart_rows(out)
        yield from led()

    return _sorted(rows, by).mapInArrow(find, APART)


def _meeting(leaders: DataFrame, similarity: float) -> DataFrame:
    """In bands that were searched in parts: pairs of leaders of different parts that may be a link (a, b); and leaders
    (a) with the ``part`` and ``label`` of another leader, where nodes that either of the two stands for may be a link.
    The leader with the nodes most like it comes as the guest of the other's part."""
    maybe = similarity - MARGIN - 1e-9

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, seen, least, parts, classes, guests = None, _Leaders(), [], [], _Classes(), set()
        for key, members in _groups(batches, ["band"]):
            if key != group:
                group, seen, least, parts, classes, guests = key, _Leaders(), [], [], _Classes(), set()
            out = []
            for row in members:
                bag = _Bag(row)
                equal = seen.equal(bag.drawn)
                apart = np.array(parts, np.int64) != row["part"]
                near = [seen.rows[i] for i in np.flatnonzero((equal >= maybe) & apart)]
                out += [(key[0], row["node"], o.row["node"], None, None) for o in classes.links(bag, near, similarity)]
                # of two leaders that stand for themselves alone all has been compared
                wide = (np.array(least) + row["least"] < 2) & (equal >= maybe - 2 + np.array(least) + row["least"]) & apart
                for o in (seen.rows[i] for i in np.flatnonzero(wide)):
                    if classes.of(o) != classes.of(bag):
                        guest, home = (row, o.row) if row["least"] >= o.row["least"] else (o.row, row)
                        met = (guest["node"], home["part"], home["label"])
                        if met not in guests:
                            guests.add(met)
                            out.append((key[0], guest["node"], None, *met[1:]))
                seen.add(bag.drawn, bag)
                least.append(row["least"])
                parts.append(row["part"])
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["band", "a", "b", "part", "label"])

    return _sorted(leaders, ["band"]).mapInArrow(find, "band long, a binary, b binary, part long, label binary")


def links_of_guests(guests: DataFrame, families: DataFrame, kept: DataFrame, label: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes of different parts of a band that may be a link, of classes that are still apart.

    The nodes a guest stands for go to the parts it is a guest of; a task holds one part."""
    spark = guests.sparkSession
    maybe = similarity - MARGIN - 1e-9
    for name, c in (("mine", "a"), ("theirs", "label")):
        guests = guests.join(label.select(F.col("node").alias(c), F.col("label").alias(name)), c, "left").withColumn(name, F.coalesce(name, c))
    guests = written(guests.where("mine != theirs").select("band", "a", "part").distinct(), new_work_dir(spark, "guests"))
    member = families.select("band", "leader", F.col("a").alias("node"), "part")
    moved = guests.withColumnRenamed("a", "leader").join(member.drop("part"), ["band", "leader"])
    home = member.join(guests.select("band", "part").distinct(), ["band", "part"], "left_semi")
    rows = home.select("band", "part", "node", F.lit(False).alias("guest"))
    rows = rows.union(moved.select("band", "part", "node", F.lit(True).alias("guest")))
    renamed = kept.drop("label").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, here, classes = None, _Leaders(), _Classes()
        for key, members in _groups(batches, ["band", "part"]):
            if key != group:
                group, here, classes = key, _Leaders(), _Classes()
            out = []
            for row in members:
                bag = _Bag(row)
                if row["guest"]:
                    near = [here.rows[i] for i in np.flatnonzero(here.equal(bag.drawn) >= maybe)]
                    out += [(row["node"], o.row["node"]) for o in classes.links(bag, near, similarity)]
                else:
                    here.add(bag.drawn, bag)
            columns = list(zip(*out, strict=True)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])

    rows = rows.join(renamed, "node").repartition("band", "part").sortWithinPartitions("band", "part", "guest")
    return written(_undirected(rows.mapInArrow(find, "a binary, b binary")), new_work_dir(spark, "pairs"))


def links_between(nodes: DataFrame, label: DataFrame, texts: DataFrame, idf, similarity: float) -> tuple[DataFrame, tuple[DataFrame, ...] | None]:
    """Pairs of nodes (a, b) of different classes that may be links: of two nodes of a band that have enough samples in
    common, and are not in one class by other links of the band, every pair; but for those that
    :func:`links_of_guests` is to find from the tables that come second."""
    spark = nodes.sparkSession
    named = nodes.join(texts.select("node"), "node").join(label, "node", "left")
    named = named.select("node", "bands", "samples", F.coalesce("label", "node").alias("label"))
    in_band = named.select("node", "label", F.explode("bands").alias("band"))
    shared = in_band.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    shared = written(shared.where("low != high").select("band", "n"), new_work_dir(spark, "bands"))
    places = written(in_band.select("node", "band").join(shared, "band"), new_work_dir(spark, "places"))
    some = places.select("node").distinct()
    kept = _shingles(texts.join(some, "node", "left_semi"), idf)
    kept = written(kept.join(named.drop("bands"), "node"), new_work_dir(spark, "shingles"))
    part = F.expr(f"pmod(xxhash64(node), 1 + n div {PART})").alias("part")
    rows = places.join(kept, "node").select("*", part)
    found = written(_search_apart(rows, ["band", "part"], similarity), new_work_dir(spark, "apart"))
    families = found.where("b IS NULL").withColumn("node", F.col("a")).join(shared, "band").select("band", "a", "leader", "least", part)
    leaders = families.where("least IS NOT NULL").select("band", F.col("a").alias("node"), "least", "part").join(kept, "node")
    met = written(_meeting(leaders, similarity), new_work_dir(spark, "met"))
    pairs = found.where("b IS NOT NULL").select("a", "b").union(met.where("b IS NOT NULL").select("a", "b"))
    guests = met.where("b IS NULL")
    later = None if guests.isEmpty() else (guests.drop("b"), families, kept)
    return written(_undirected(pairs), new_work_dir(spark, "pairs")), later


def _undirected(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()


def _verify(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """Weighted Jaccard similarity of the bags of each pair: a, b, similarity."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for one in steps(batches, "text") for s in steps([one], "other")):
            sides = [bags(Words(*utf8(batch.column(c))), idf.value) for c in ("text", "other")]
            similar = []
            for i in range(batch.num_rows):
                (x, v), (y, w) = ((n[f[i] : f[i + 1]], g[f[i] : f[i + 1]]) for f, n, g in sides)
                _, p, q = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                both = np.minimum(v[p], w[q]).sum()
                similar.append(both / max(v.sum() + w.sum() - both, 1e-12))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similar, pa.float64())], names=["a", "b", "similarity"])

    one = pairs.select("a", "b").join(texts.withColumnRenamed("node", "a"), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("other")), "b")
    return two.select("a", "b", "text", "other").mapInArrow(compare, "a binary, b binary, similarity double")


def components(links: DataFrame) -> DataFrame:
    """Connected components of links a - b: node, the smallest node it is connected with."""
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select("b", "a"))
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), new_work_dir(spark, "labels"))
    while True:
        seen = both.join(label, both["b"] == label["node"]).select(F.col("a").alias("node"), "label")
        lowest = label.union(seen).groupBy("node").agg(F.min("label").alias("label"))
        # what the label itself is labelled with: paths halve in each round
        up = label.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = lowest.join(up, "label", "left").select("node", F.coalesce(F.least("above", "label"), "label").alias("label"))
        new = written(jumped, new_work_dir(spark, "labels"))
        if not new.join(label, ["node", "label"], "left_anti").limit(1).count():
            return new
        label = new


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links between the classes: node, label."""
    for c in "ab":
        of = label.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
        links = links.join(of, c, "left").withColumn(c, F.coalesce(f"{c}_label", c)).drop(f"{c}_label")
    above = components(written(links.select("a", "b").where("a != b").distinct(), new_work_dir(label.sparkSession, "joins")))
    # a class is labelled with one of its nodes; a node without a class so far is its own
    alone = above.join(label, "node", "left_anti").select("node", F.col("label").alias("new"))
    up = above.select(F.col("node").alias("label"), F.col("label").alias("new"))
    moved = label.join(up, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    return written(moved.union(alone), new_work_dir(label.sparkSession, "labels"))


def _linked(label: DataFrame, pairs: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """Labels after those of the pairs that are links."""
    links = written(_verify(pairs, texts, idf), new_work_dir(label.sparkSession, "verified")).where(F.col("similarity") >= similarity)
    return label if links.isEmpty() else _joined(label, links)


def near_duplicates(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", similarity: float = 0.8
) -> DataFrame:
    """One row per row of the input with words: __id, __row_key, class (a node), first (is it the class's first row?),
    class_id (the smallest id of the class) and class_size."""
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{id_column}`").alias(ID), row_key(id_column, text_column).alias(KEY), F.col(f"`{text_column}`").alias("text"))
    idf = spark.sparkContext.broadcast(document_frequencies(read.select("text")))
    sketches = written(_sketches(read, idf), new_work_dir(spark, "sketches"))
    nodes = sketches.groupBy("node").agg(F.first("bands").alias("bands"), F.first("samples").alias("samples"))
    nodes = written(nodes, new_work_dir(spark, "nodes"))
    pairs = candidates(nodes, similarity - FIRST_MARGIN)
    in_band = nodes.select("node", F.explode("bands").alias("band"))
    involved = in_band.join(in_band.groupBy("band").count().where("count > 1").select("band"), "band").select("node").distinct()
    row_of = sketches.groupBy("node").agg(F.min(F.struct(ID, KEY)).alias("row")).join(involved, "node").select("node", "row.*")
    chosen = row_of.alias("r").join(read.alias("d"), F.expr(f"r.{ID} <=> d.{ID} AND r.{KEY} = d.{KEY}"))
    texts = written(chosen.select("node", "d.text").dropDuplicates(["node"]), new_work_dir(spark, "texts"))

    # first the best pair of each node, then what may link the classes this makes
    best = pairs.groupBy("a").agg(F.max(F.struct("equal", "b")).alias("best"))
    first = _undirected(best.select("a", "best.b"))
    checked = written(_verify(first, texts, idf), new_work_dir(spark, "verified"))
    label = components(checked.where(F.col("similarity") >= similarity))
    rest, later = links_between(nodes, label, texts, idf, similarity)
    label = _linked(label, rest, texts, idf, similarity)
    if later is not None:
        label = _linked(label, links_of_guests(*later, label, similarity), texts, idf, similarity)
    classed = sketches.select(ID, KEY, "node").join(label, "node", "left").select(ID, KEY, F.coalesce("label", "node").alias("class"))
    classed = written(classed, new_work_dir(spark, "classes"))
    heads = classed.groupBy("class").agg(F.min(F.struct(ID, KEY)).alias("head"), F.count(F.lit(1)).alias("class_size"))
    out = classed.join(heads, "class")
    return out.select(ID, KEY, "class", F.struct(ID, KEY).eqNullSafe(F.col("head")).alias("first"), F.col(f"head.{ID}").alias("class_id"), "class_size")


def classes(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", similarity: float = 0.8) -> DataFrame:
    """One row per document: its id, class_id (the smallest id of its class) and class_size (1 without words)."""
    found = near_duplicates(docs, id_column=id_column, text_column=text_column, similarity=similarity).alias("f")
    rows = docs.select(F.col(f"`{id_column}`").alias(ID), row_key(id_column, text_column).alias(KEY)).alias("d")
    found = found.dropDuplicates([ID, KEY]).alias("f")
    joined = rows.join(found, F.expr(f"d.{ID} <=> f.{ID} AND d.{KEY} = f.{KEY}"), "left")
    alone = F.col("f.class").isNull()
    return joined.select(
        F.col(f"d.{ID}").alias(id_column),
        F.when(alone, F.col(f"d.{ID}")).otherwise(F.col("f.class_id")).alias("class_id"),
        F.coalesce("f.class_size", F.lit(1)).alias("class_size"),
    )


def keep_first(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", similarity: float = 0.8) -> DataFrame:
    """The documents without near-duplicates of an earlier one (by id); the columns are those of the input.

    Of rows with the same id and text one stays.
    """
    gone = near_duplicates(docs, id_column=id_column, text_column=text_column, similarity=similarity)
    gone = gone.where("NOT first").select(ID, KEY).distinct().alias("g")
    here = docs.withColumn(KEY, row_key(id_column, text_column)).alias("d")
    kept = here.join(gone, F.col(f"d.`{id_column}`").eqNullSafe(F.col(f"g.{ID}")) & (F.col(f"d.{KEY}") == F.col(f"g.{KEY}")), "left_anti")
    rows = docs.select(F.col(f"`{id_column}`").alias(ID), row_key(id_column, text_column).alias(KEY))
    if rows.groupBy(ID, KEY).count().where("count > 1").limit(1).count():  # else whole texts would move for nothing
        kept = kept.dropDuplicates([id_column, KEY])
    return without(kept, [KEY])
