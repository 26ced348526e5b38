"""Streams that count per target in the state store, and streams of prompts."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from recordloom.errors import ConfigurationError
from recordloom.formats import Field, FormatSpec
from recordloom.params import RunParams
from recordloom.streaming import generation, targets
from recordloom.streaming.records import ROCKSDB, read_responses, stream_records

STORE = "spark.sql.streaming.stateStore.providerClass"
WORD = FormatSpec("word", "A word.", (Field("word", "string"), Field("size", "integer")))


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)
    yield
    spark.conf.set(STORE, before)


def arrive(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(path)


def test_targets_take_their_first_records(spark, tmp_path, rocksdb, monkeypatch):
    monkeypatch.setattr(targets, "PARTS", 3)
    schema = "target_id string, num_samples bigint, batch_id bigint, pos int"
    rows = [(t, n, b, p) for t, n in (("hot", 25), ("few", 2), ("none", 0), (None, 3)) for b in range(12) for p in range(3 if t == "hot" else 1)]
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for low, high in ((0, 5), (5, 9), (9, 12)):  # the stream ends and goes on
        arrive(spark, [r for r in rows if low <= r[2] < high], schema, source)
        stream = read_responses(spark, source, spark.createDataFrame([], schema).schema)
        stream_records(targets.cap_stream(stream), out, state).awaitTermination()
    got = sorted(spark.read.parquet(out).collect(), key=repr)
    expected = [r for t, n in (("hot", 25), ("few", 2), (None, 3)) for r in sorted(r for r in rows if r[0] == t)[:n]]
    assert [tuple(r) for r in got] == [tuple(r) for r in sorted(got, key=repr)] and {tuple(r) for r in got} == set(expected)
    assert len(got) == len(expected)


def test_the_cap_needs_its_state_store(spark):
    stream = spark.readStream.format("rate").load()
    before = spark.conf.get(STORE)
    if before != ROCKSDB:
        with pytest.raises(ConfigurationError):
            targets.cap_stream(stream, "value", "value", ("timestamp",))


def counted_model(folder):
    def answer(system, human):
        with open(os.path.join(folder, human), "a") as log:  # a byte per call
            log.write("x")
        if human == "never":
            raise TimeoutError("no answer")
        return '[{"word": "%s", "size": 1}, {"word": "b", "size": 2}, {"word": "b", "size": 2}, {"word": 3}]' % human, "STOP", None

    return answer


def test_prompts_are_answered_once(spark, tmp_path):
    calls, source, out, state = (str(tmp_path / n) for n in ("calls", "in", "out", "state"))
    os.mkdir(calls)
    params = RunParams(max_retries=0, retry_delay=0.0)
    schema = "target_id string, human string"

    def run():
        stream = read_responses(spark, source, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
        generation.stream_generation(stream, WORD, counted_model(calls), out, state, params, concurrency=2, prompts_per_task=2).awaitTermination()

    arrive(spark, [(f"t{i}", f"w{i}") for i in range(9)] + [("gone", "never")], schema, source)
    run()
    arrive(spark, [("t3", "w3"), ("t3", "other"), ("new", "w9")], schema, source)
    run()
    run()
    made = {name: os.path.getsize(os.path.join(calls, name)) for name in os.listdir(calls)}
    assert made == {**{f"w{i}": 1 for i in range(10)}, "never": 1}
    got = sorted((r.target_id, r.pos, r.word, r["size"]) for r in spark.read.parquet(f"{out}/records").collect())
    expected = [(t, p, w, n) for t, h in [(f"t{i}", f"w{i}") for i in range(9)] + [("new", "w9")] for p, w, n in ((0, h, 1), (1, "b", 2))]
    assert got == sorted(expected)


def test_a_micro_batch_that_broke_off_goes_on(spark, tmp_path, monkeypatch):
    """The driver ends between the calls and the records: the repeated micro-batch asks nothing again."""
    calls, source, out, state = (str(tmp_path / n) for n in ("calls", "in", "out", "state"))
    os.mkdir(calls)
    params = RunParams(max_retries=0, retry_delay=0.0)
    schema = "target_id string, human string"
    arrive(spark, [(f"t{i}", f"w{i}") for i in range(5)], schema, source)

    def run():
        stream = read_responses(spark, source, spark.createDataFrame([], schema).schema)
        return generation.stream_generation(stream, WORD, counted_model(calls), out, state, params, concurrency=1, prompts_per_task=1)

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(generation, "resolve_attempts", broken)
    with pytest.raises(StreamingQueryException):
        run().awaitTermination()
    monkeypatch.undo()
    run().awaitTermination()
    assert {name: os.path.getsize(os.path.join(calls, name)) for name in os.listdir(calls)} == {f"w{i}": 1 for i in range(5)}
    assert spark.read.parquet(f"{out}/records").where(F.col("pos") == 0).count() == 5


def test_only_unfinished_slices_are_asked_again(spark, tmp_path, monkeypatch):
    """The driver ends while slices are answered: what was written before is not asked again, by default concurrency."""
    calls, source, out, state = (str(tmp_path / n) for n in ("calls", "in", "out", "state"))
    os.mkdir(calls)
    schema = "target_id string, human string"
    arrive(spark, [(f"t{i}", f"w{i}") for i in range(40)], schema, source)
    whole = generation.generate

    def run():
        stream = read_responses(spark, source, spark.createDataFrame([], schema).schema)
        params = RunParams(max_retries=0, retry_delay=0.0)
        generation.stream_generation(stream, WORD, counted_model(calls), out, state, params, prompts_per_task=1).awaitTermination()

    def once(*given, **named):
        monkeypatch.setattr(generation, "generate", broken)
        return whole(*given, **named)

    def broken(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(generation, "generate", once)
    with pytest.raises(StreamingQueryException):
        run()
    assert 0 < len(os.listdir(calls)) < 40
    monkeypatch.undo()
    run()
    assert {name: os.path.getsize(os.path.join(calls, name)) for name in os.listdir(calls)} == {f"w{i}": 1 for i in range(40)}
    assert spark.read.parquet(f"{out}/records").where(F.col("pos") == 0).count() == 40
