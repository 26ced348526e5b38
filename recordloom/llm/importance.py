"""Quality classifier by importance resampling over hashed n-grams.

Two bag-of-n-gram models share one hashed feature space: the *target* model counts the n-grams of documents
labelled good and not toxic, the *raw* model those of all documents. The log ratio of both, summed over a
document, is its log importance weight; documents are resampled without replacement by Gumbel top-k.

Features are hashed word 1- and 2-grams, the first six bytes of longer words, and 1- and 3-grams of the form of
words (case, repetition of the word before, the punctuation that follows). A ratio that the counts do not settle
(within ``SURE`` standard deviations, or closer to even than ``EVEN``) counts as even, so that long ordinary
documents neither gain nor lose by chance. It is settled by the labelled documents on both sides, as a phrase
that only an unlabelled group of copies holds is rare in the target whatever its quality.

k is not fixed: it is the number of documents whose weight reaches a cut, and the cut is the one that separates
good from bad best on labelled documents held out of the target model. Weights are kept as whole numbers, so that
every pass and every retried task gets the same.

Defined results: without labels of both kinds everything is kept. Null, empty and wordless texts have weight 0
(nothing speaks against them). Rows with the same id and text get the same draw, so both stay or both go. A label
whose id is null is ignored; of several labels of one id the worst counts. Columns are those of the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import tables
from recordloom.llm.arrays import U64, Words, mix, row_key, steps, utf8
from recordloom.session import new_work_dir, written

BITS = 19
SIZE = 2 << BITS
#: Buckets whose counts travel together.
CHUNK = 1 << 10
UNIT = 256  # weights are multiples of 1 / UNIT nats
SURE, EVEN = 4.0, 0.5
#: Nats of weight that outweigh one unit of Gumbel noise, times UNIT.
SHARPNESS = 8
#: Labelled documents used at most, picked by a hash of their id.
LABELS = 20_000
KEY = "__row_key"
COUNTS = ("bucket", "raw", "target", "other")
UNKNOWN = (-1, False)
_CUT_LIMIT = 1 << 40


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of some texts: their two buckets and number of the text, once for each text that has the feature.

    A text counts once because one that repeats a word a thousand times is one observation, not a thousand.
    """
    count = len(words.starts)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    if not count:
        return text, text, text
    h, raw = words.hashes, words.raw
    stop = np.repeat(words.offsets[1:], words.counts)
    following = np.minimum(np.append(words.starts[1:], len(raw)), stop)
    upper = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw >= 65) & (raw <= 90), out=upper[1:])
    capitals = upper[words.ends] - upper[words.starts]
    title = upper[words.starts + 1] - upper[words.starts]
    shape = np.where((capitals > 1) & (capitals * 2 > words.ends - words.starts), 2, title)
    alike = np.zeros(count, np.int64)
    alike[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    gap = words.spans(words.ends, np.minimum(following, words.ends + 8))
    form = mix(gap + (shape * 2 + alike).astype(U64))
    pair = text[1:] == text[:-1]
    triple = pair[1:] & pair[:-1]
    long = np.flatnonzero(words.ends - words.starts > 6)
    numbers = [
        (h, text),
        (mix(h[:-1] * U64(3) + h[1:])[pair], text[1:][pair]),
        (mix(words.spans(words.starts[long], words.starts[long] + 6) + U64(5)), text[long]),
        (mix(form + U64(7)), text),
        (mix(mix(form[:-2] + U64(11)) + mix(form[1:-1] + U64(13)) * U64(3) + form[2:])[triple], text[2:][triple]),
    ]
    both = np.sort(np.concatenate([(n >> U64(64 - 2 * BITS)).astype(np.int64) + (t << (2 * BITS)) for n, t in numbers]))
    both = both[np.append(True, both[1:] != both[:-1])]
    low = (1 << BITS) - 1
    return both & low, (both >> BITS & low) + (1 << BITS), both >> (2 * BITS)


@dataclass
class Model:
    """Log importance weight of every bucket, in units of 1 / UNIT nats.

    A feature has one bucket in either half of the table. It weighs what the more even of the two says, so that a
    rare feature that shares one bucket with a telling one stays even.
    """

    weights: np.ndarray

    def score(self, words: Words) -> np.ndarray:
        one, two, text = features(words)
        a, b = self.weights[one], self.weights[two]
        weight = np.where(a * b > 0, np.sign(a) * np.minimum(np.abs(a), np.abs(b)), 0)
        # whole numbers below 2**53: exact in any order of addition
        return np.bincount(text, weight, len(words.counts)).astype(np.int64)


def _counter(labels, id_column: str, text_column: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = labels.value
        counts = np.zeros((3, SIZE), np.int64)
        raw, target, other = counts
        for batch in steps(batches, text_column):
            one, two, text = features(Words(*utf8(batch.column(text_column))))
            kind = np.array([good.get(i, UNKNOWN) for i in batch.column(id_column).to_pylist()], np.int64)[:, 0][text]
            for bucket in (one, two):
                for table, some in ((raw, bucket), (target, bucket[kind == 1]), (other, bucket[kind == 0])):
                    np.add.at(table, some, 1)
        filled = np.flatnonzero(raw.reshape(-1, CHUNK).any(axis=1))
        for at in range(0, len(filled), 64):
            part = filled[at : at + 64]
            data = [counts[:, c * CHUNK : (c + 1) * CHUNK].tobytes() for c in part.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(data, pa.binary())], names=["chunk", "counts"])

    return count


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of buckets from the counts of their chunks, which come in order of the chunks."""
    chunk, total = None, np.zeros((3, CHUNK), np.int64)

    def out() -> pa.RecordBatch:
        some = np.flatnonzero(total[0])
        columns = [pa.array(chunk * CHUNK + some), *[pa.array(t[some]) for t in total]]
        return pa.RecordBatch.from_arrays(columns, names=list(COUNTS))

    for batch in batches:
        for own, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
            if own != chunk:
                if chunk is not None:
                    yield out()
                chunk, total = own, np.zeros((3, CHUNK), np.int64)
            total += np.frombuffer(counts.as_buffer(), np.int64).reshape(3, CHUNK)
    if chunk is not None:
        yield out()


def sample_labels(labels: DataFrame, id_column: str, limit: int = LABELS, seed: int = 1) -> dict:
    """At most ``limit`` labelled ids: id -> (1 if good and not toxic else 0, held out for the cut)."""
    good = F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0))
    ids = labels.where(F.col(f"`{id_column}`").isNotNull()).groupBy(F.col(f"`{id_column}`").alias("id")).agg(good.alias("good"))
    draw = F.xxhash64("id", F.lit(seed))
    picked = ids.select("id", "good", draw.alias("draw")).orderBy("draw", "id").limit(limit).collect()
    return {r["id"]: (r["good"], r["draw"] % 4 == 0) for r in picked}


def _one_of_each(docs: DataFrame, labels: dict) -> dict:
    """Leave one labelled document of each group of copies: those that share a smallest hashed word 3-gram."""
    ids = docs.sparkSession.sparkContext.broadcast(set(labels))

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            batch = batch.filter(pa.array([i in ids.value for i in batch.column("id").to_pylist()], pa.bool_()))
            _, text, number = Words(*utf8(batch.column("text"))).windows(3)
            some, first = np.unique(text, return_index=True)
            columns = [np.minimum.reduceat(mix(number + U64(s)), first).view(np.int64) if len(some) else np.zeros(0, np.int64) for s in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(some)), *map(pa.array, columns)], names=["id", "a", "b"])

    kind = docs.schema["id"].dataType.simpleString()
    found = {r["id"]: (r["a"], r["b"]) for r in docs.mapInArrow(smallest, f"id {kind}, a long, b long").collect()}  # as many as labels
    seen, kept = set(), {}
    for i, label in labels.items():
        if i in found and not seen & {(0, found[i][0]), (1, found[i][1])}:
            seen |= {(0, found[i][0]), (1, found[i][1])}
            kept[i] = label
    return kept


def fit(docs: DataFrame, labels: dict, *, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Count both models over all documents and take their log ratio."""
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    training = spark.sparkContext.broadcast({i: x for i, x in _one_of_each(read, labels).items() if not x[1]})
    # a task hands over its counts in chunks of the table, which are added up as they stream by
    counted = read.mapInArrow(_counter(training, "id", "text"), "chunk int, counts binary")
    dealt = counted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").sortWithinPartitions("chunk")
    table = tables.settled(dealt.mapInArrow(_summed, ", ".join(f"{c} long" for c in COUNTS)), new_work_dir(spark, "features"))
    raw, target, other = table.agg(*[F.sum(c) for c in COUNTS[1:]]).first()
    weights = np.zeros(SIZE, np.int32)
    if target and other:
        share = target / (target + other)
        ratio = F.expr(f"ln((target + 0.5D) / (raw * {target / raw!r}D + 0.5D))")
        # what the labels say by themselves: a bucket only unlabelled copies use says nothing about quality
        surprise = [f"if({c} > 0, {c} * ln({c} / ((target + other) * {p!r}D)), 0D)" for c, p in (("target", share), ("other", 1 - share))]
        settled = F.expr(f"2 * ({surprise[0]} + {surprise[1]})") > SURE**2
        agrees = (F.col("ratio") > 0) == F.expr(f"target * {1 - share!r}D > other * {share!r}D")
        told = table.withColumn("ratio", ratio).where(settled & (F.abs("ratio") > EVEN) & agrees).select("bucket", "ratio").toArrow()
        weights[told["bucket"].to_numpy()] = np.rint(told["ratio"].to_numpy() * UNIT)  # SIZE rows at most
    return Model(weights)


def _gumbel(key: np.ndarray) -> np.ndarray:
    uniform = (mix(key.astype(np.int64).view(U64)) >> U64(11)).astype(np.float64) / float(1 << 53)
    return np.rint(-np.log(-np.log(np.clip(uniform, 1e-16, 1 - 1e-16))) * UNIT).astype(np.int64)


def _scored(model, batch: pa.RecordBatch, text_column: str) -> tuple[np.ndarray, np.ndarray]:
    score = model.score(Words(*utf8(batch.column(text_column))))
    return score, score * SHARPNESS + _gumbel(batch.column(KEY).to_numpy(zero_copy_only=False))


def _cut(good: np.ndarray, bad: np.ndarray) -> int:
    """The lowest weight that parts good from bad best; minus infinity if there is nothing to part."""
    if not len(good) or not len(bad):
        return -_CUT_LIMIT
    tried = np.unique(np.concatenate([good, bad]))
    kept = 1 - np.searchsorted(np.sort(good), tried) / len(good)
    gone = np.searchsorted(np.sort(bad), tried) / len(bad)
    return int(tried[np.argmax(kept + gone)])


def _kth_largest(keys: DataFrame, k: int) -> int:
    """The k-th largest of the whole numbers in column ``key``, found by four counts of 16 bits each."""
    number = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order
    prefix, known = 0, 0
    for shift in (48, 32, 16, 0):
        part = F.shiftrightunsigned(number, shift).bitwiseAND(F.lit(0xFFFF))
        rows = keys if not known else keys.where(F.shiftrightunsigned(number, shift + 16) == F.lit(prefix))
        for value, count in sorted(((r[0], r[1]) for r in rows.groupBy(part.alias("part")).count().collect()), reverse=True):
            if count >= k:
                prefix, known = (prefix << 16) | value, known + 16
                break
            k -= count
    unsigned = prefix ^ (1 << 63)
    return unsigned - (1 << 64) if unsigned >= 1 << 63 else unsigned


def resample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_limit: int = LABELS,
    score_column: str | None = None,
) -> DataFrame:
    """The documents that importance resampling picks, with the columns of the input.

    ``labels`` has ``id_column``, quality (1 or 0) and toxic (1 or 0). ``score_column`` adds the log importance
    weight in nats, in place of a column of that name.
    """
    spark = docs.sparkSession
    known = sample_labels(labels, id_column, label_limit)
    # a plain array: workers need no copy of this package
    weights = spark.sparkContext.broadcast(fit(docs, known, id_column=id_column, text_column=text_column).weights)
    ids = spark.sparkContext.broadcast(known)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            score, key = _scored(Model(weights.value), batch, "text")
            of = [ids.value.get(i) for i in batch.column("id").to_pylist()]
            label = pa.array([x[0] if x and x[1] else None for x in of], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(score), pa.array(key), label], names=["score", "key", "label"])

    read = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"), row_key(id_column, text_column).alias(KEY))
    keys = written(read.mapInArrow(weigh, "score long, key long, label long"), new_work_dir(spark, "importance"))
    held = keys.where("label IS NOT NULL").select("score", "label").toArrow()  # label_limit rows at most
    score, good = held["score"].to_numpy(), held["label"].to_numpy() == 1
    cut = _cut(score[good], score[~good])
    k = keys.where(F.col("score") >= cut).count()
    least = _kth_largest(keys, k) if k else 1 << 62
    names = [c for c in docs.columns if not score_column or c.lower() != score_column.lower()]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text_column):
            score, key = _scored(Model(weights.value), batch, text_column)
            columns = [batch.column(c) for c in names] + [pa.array(score / UNIT)] * bool(score_column)
            out = pa.RecordBatch.from_arrays(columns, names=[*names, *[score_column] * bool(score_column)])
            yield out.filter(pa.array(key >= least))

    kept = docs.select([F.col(f"`{c}`") for c in names]).schema
    kept = kept.add(score_column, "double") if score_column else kept
    carried = [F.col(f"`{c}`") for c in dict.fromkeys([*names, text_column])]
    return docs.select(*carried, row_key(id_column, text_column).alias(KEY)).mapInArrow(pick, kept)
