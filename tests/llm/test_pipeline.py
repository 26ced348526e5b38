"""The pipeline over a small corpus with planted cases, and its stages against plain Python."""

import json

import numpy as np
import pytest

import corpus_pipeline
from recordloom.llm.queries import ORACLES, QUERIES
from tests.llm.test_llm_documents import lowered, prose


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rng = np.random.default_rng(8)
    common = [f"word{i}" for i in range(400)]

    def text(seed, n=12):
        w = prose(seed, n * 5)
        return " ".join(" ".join([*w[i * 5 : i * 5 + 5], *rng.choice(common, 5)]).capitalize() + "." for i in range(n))

    passage, item = text(9001, 6), text(9002, 3)
    docs, labels = {}, []
    for i in range(300):
        docs[i] = text(i)
        if i % 6 == 0:
            docs[i] += " You stupid idiot. " * 2
        labels.append((i, 1, int(i % 6 == 0)))
    docs |= {1000 + i: docs[1] for i in range(5)}
    docs |= {1100 + i: docs[7].replace("word", "Word", 1) + f" tail{i}." for i in range(4)}
    docs |= {2000 + i: text(2000 + i) + "\n" + passage for i in range(4)}
    docs |= {3000: text(3000, 4) + " " + item, 3001: None, 3002: ""}
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs, passage


def test_stages(spark, corpus, tmp_path):
    folder, docs, passage = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns, after = frame.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, folder).write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        after[name] = {r.doc_id: r for r in frame.collect()}
        if name != "token_ids":
            assert frame.columns == columns
    toxic = {i for i in range(300) if i % 6 == 0}
    assert set(after["quality"]) == set(docs) - toxic
    copies = set(range(1000, 1005)) | set(range(1100, 1104))
    assert set(after["near_duplicates"]) == set(docs) - toxic - copies
    cut = after["repeated_passages"]
    assert set(cut) == set(after["near_duplicates"])
    assert passage in cut[2000].text and all(len(set(lowered(passage)) & set(lowered(cut[2000 + i].text))) < 40 for i in (1, 2, 3))
    assert all(cut[i].text == docs[i] for i in cut if not 2000 < i < 2004)
    assert all(r.n_chars == len(r.text) for r in cut.values() if r.text is not None)
    assert set(after["benchmark_passages"]) == set(cut) - {3000}
    last = after["token_ids"]
    assert set(last) == set(cut) - {3000} and last[3002].ids == [] and last[1].n_tokens == len(last[1].ids)
    ran = corpus_pipeline.run(spark, folder)
    assert {r.doc_id: r.ids for r in ran.collect()} == {i: r.ids for i, r in last.items()}


def test_every_operator_has_a_query(spark, corpus):
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == json.loads('["quality", "near_duplicates", "repeated_passages", "benchmark_passages", "token_ids"]')
