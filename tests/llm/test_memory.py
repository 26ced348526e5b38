"""What the stages of the pipeline hold at once."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from recordloom.llm import arrays, importance
from recordloom.llm.minhash import document_frequencies
from recordloom.session import BATCH_BYTES, small_batches

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    before = spark.conf.getAll.get(SETTING)
    spark.conf.unset(SETTING)
    yield
    spark.conf.set(SETTING, before) if before else spark.conf.unset(SETTING)


def test_every_stage_bounds_its_batches(spark, unset, tmp_path):
    texts = [(i, f"doc{i} " + "some words of a text that is long " * 100, "en", "s", 3500) for i in range(4000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "none of it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(SETTING)
        stage(spark, docs.limit(10), str(tmp_path))
        found = [r.size for r in docs.mapInArrow(sizes, "size long").collect()]
        assert len(found) > 4 and max(found) < 1.1 * BATCH_BYTES


def test_a_size_the_session_sets_stays(spark, unset):
    spark.conf.set(SETTING, "1m")
    small_batches(spark)
    assert spark.conf.get(SETTING) == "1m"


def test_what_an_operator_kept_goes_when_another_begins():
    batch = pa.RecordBatch.from_pydict({"text": ["a text", None]})
    try:
        kept = arrays.per_worker("one", lambda: [1])
        assert list(arrays.steps([batch], "text", keeps=True)) and arrays.per_worker("one", list) is kept
        assert list(arrays.steps([batch], "text")) and arrays.per_worker("one", list) == []
    finally:
        arrays.forget()


def test_counting_a_batch_needs_little_beside_its_tables():
    text = " ".join(f"Word{i * 7919 % 5003}" for i in range(30_000))
    batch = pa.RecordBatch.from_pydict({"id": [*range(40)], "text": [text[i : i + 50_000] for i in range(40)]})
    count = importance._counter(SimpleNamespace(value={}), "id", "text")
    raw = 0
    tracemalloc.start()
    for out in count([batch]):
        raw += sum(np.frombuffer(c.as_buffer(), np.int64).reshape(3, -1)[0].sum() for c in out.column("counts"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert raw and peak < 3 * importance.SIZE * 8 + (32 << 20)


def test_steps_of_any_size_count_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(f"word{i} and word{i % 7} " * 400,) for i in range(200)], "text string").coalesce(1)
    small = document_frequencies(docs)
    monkeypatch.setattr(arrays.steps, "__defaults__", (1 << 12,))
    assert (document_frequencies(docs) == small).all()
