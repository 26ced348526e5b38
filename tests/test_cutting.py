"""Records cut from splits against whole files."""

import csv
import io
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.errors import ConfigurationError, LoaderError
from recordloom.sources import cutting
from recordloom.sources.files import read_csv_docs, read_json_docs

CONF = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=["7", "60", "1000000"])
def splits(spark, request):
    before = spark.conf.get(CONF)
    spark.conf.set(CONF, request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield
    spark.conf.unset("spark.sql.files.minPartitionNum")
    spark.conf.set(CONF, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def plain_modes(text, mode):
    """The mode behind each line, character by character."""
    state, out = ("in" if mode else "start"), []
    for line in text.split("\n"):
        for c in line:
            if state == "start":
                state = "in" if c == '"' else "start" if c == "," else "bare"
            elif state == "in":
                state = "quote" if c == '"' else "in"
            elif state == "quote":
                state = "in" if c == '"' else "start" if c == "," else "bare"
            elif c == ",":
                state = "start"
        if state != "in":
            state = "start"
        out.append(int(state == "in"))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='ab",\n\r ', max_size=60), st.integers(0, 1))
def test_modes_of_csv_lines(text, mode):
    effect = cutting.CsvRows().effect(pa.array(text.split("\n")))
    assert effect.run(mode, 0)[0].tolist() == plain_modes(text, mode)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='a"\\,[]{} ', max_size=60), st.integers(0, 1), st.integers(0, 3))
def test_modes_of_json_pieces(text, mode, depth):
    state, at, out, skip = mode, depth, [], False
    for piece in text.split(","):
        skip = False  # a comma is no escape
        for c in piece:
            if skip:
                skip = False
            elif c == "\\":
                skip = True
            elif c == '"':
                state ^= 1
            elif state == 0:
                at += (c in "[{") - (c in "]}")
        out.append((state, at))
    after, depths = cutting.JsonElements().effect(pa.array(text.split(","))).run(mode, depth)
    assert list(zip(after.tolist(), depths.tolist(), strict=True)) == out


def csv_text(rng, rows, sep=",", end="\n", name="name"):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=sep, lineterminator=end)
    writer.writerow(["id", name, "x"])
    for i in range(rows):
        value = "".join(rng.choice(["a", '"', sep, "\n", "\r\n", " ", "é", "'", "\\"]) for _ in range(rng.randint(0, 12)))
        writer.writerow([i, value, rng.choice(["", "x", f"x{sep}y"])])
        if rng.random() < 0.1:
            out.write(end)
    return out.getvalue()


@pytest.mark.parametrize("sep, end", [(",", "\n"), (";", "\r\n")])
def test_split_csv_equals_whole_files(spark, tmp_path, splits, sep, end):
    rng = random.Random(sep)
    title = "name" if spark.conf.get(CONF) == "7" or end != "\n" else " na\nme "
    for name in "ab":
        (tmp_path / f"{name}.csv").write_bytes(csv_text(rng, 40, sep, end, title).encode())
    got = read_csv_docs(spark, str(tmp_path), sep=sep, split=True)
    whole = read_csv_docs(spark, str(tmp_path), sep=sep).collect()
    assert sorted((r.source, r.text) for r in got.collect()) == sorted((r.source, r.text) for r in whole)
    rows = {}
    for r in whole:
        rows.setdefault(r.source, []).append((r.row, r.text))
    ordered = {source: [t for _, t in sorted(found)] for source, found in rows.items()}
    assert {(r.source, r.row): r.text for r in got.collect()} == {(s, i): t for s, texts in ordered.items() for i, t in enumerate(texts)}


def test_split_csv_odd_files(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text('\n\nx,,x\n1,2,3,4\n5\n\n"open,\nto the\nend')
    (tmp_path / "b.csv").write_text("y\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text('q\na"b\n"c"d\n')
    got = {(r.source[-5:], r.row): r.text for r in read_csv_docs(spark, str(tmp_path), split=True).collect()}
    assert got == {
        ("a.csv", 0): "x0: 1\n_c1: 2\nx2: 3",
        ("a.csv", 1): "x0: 5\n_c1: \nx2: ",
        ("a.csv", 2): "x0: open,\nto the\nend\n_c1: \nx2: ",
        ("d.csv", 0): 'q: a"b',
        ("d.csv", 1): 'q: "c"d',
    }
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    assert read_csv_docs(spark, str(tmp_path / "none"), split=True).collect() == []
    with pytest.raises(ConfigurationError):
        read_csv_docs(spark, str(tmp_path), split=True, encoding="utf-16")


def test_a_header_that_is_longer_than_a_split(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text('"na\nme\n\n of it",b\n1,2\n')
    if int(spark.conf.get(CONF)) < 20:
        with pytest.raises(LoaderError):
            read_csv_docs(spark, str(tmp_path), split=True)
    else:
        assert [r.text for r in read_csv_docs(spark, str(tmp_path), split=True).collect()] == ["na\nme\n\n of it: 1\nb: 2"]


def value(rng, depth=0):
    kind = rng.randint(0, 7 if depth < 3 else 4)
    if kind < 3:
        return "".join(rng.choice(['"', "\\", ",", "[", "]", "{", "}", "a", "\n", "é"]) for _ in range(rng.randint(0, 8)))
    if kind < 5:
        return rng.choice([1, -2.5, True, 0])
    if kind == 5:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {f"k{i},": value(rng, depth + 1) for i in range(rng.randint(0, 3))}


@pytest.mark.parametrize("indent", [None, 2])
def test_split_json_equals_whole_files(spark, tmp_path, splits, indent):
    rng = random.Random(7)
    for name in "ab":
        (tmp_path / f"{name}.json").write_text(" \n" + json.dumps([value(rng) for _ in range(30)], indent=indent, ensure_ascii=False) + "\n")
    (tmp_path / "none.json").write_text("[ ]")
    (tmp_path / "one.json").write_text('["x"]')

    def rows(**how):
        return sorted((r.source, int(r.metadata["seq_num"]), r.row, r.text) for r in read_json_docs(spark, str(tmp_path), "$[*]", **how).collect())

    assert rows(split=True) == rows()


def test_split_json_with_a_bad_element(spark, tmp_path, splits):
    (tmp_path / "a.json").write_text('[{"t": "a"}, {"t": b}, {"u": 1}, {"t": "c"}]')
    got = read_json_docs(spark, str(tmp_path), "$[*].t", split=True).orderBy(F.col("metadata")["seq_num"]).collect()
    assert [(r.text, r.metadata.get("error"), r.metadata["seq_num"]) for r in got] == [("a", None, "0"), (None, "invalid JSON", "1"), ("c", None, "3")]
    with pytest.raises(ConfigurationError):
        read_json_docs(spark, str(tmp_path), "$.x[*]", split=True)


def test_many_splits_are_joined_in_order(spark, tmp_path, splits, monkeypatch):
    monkeypatch.setattr(cutting, "BROADCAST_SPLITS", 0)
    (tmp_path / "a.csv").write_text(csv_text(random.Random(1), 30))
    got = sorted(r.text for r in read_csv_docs(spark, str(tmp_path), split=True).collect())
    assert got == sorted(r.text for r in read_csv_docs(spark, str(tmp_path)).collect())


def test_effects_put_together():
    effect = cutting.Effect((np.array([0, 1, 1, 0]), np.array([1, 0, 1, 0])), (np.array([1, 0, 0, 2]), np.array([5, 0, 7, 0])))
    assert [x.tolist() for x in effect.run(0, 0)] == [[0, 1, 1, 0], [1, 1, 8, 8]]
    assert [x.tolist() for x in effect.run(1, 3)] == [[1, 0, 1, 0], [8, 8, 8, 8]]


def test_splits_are_put_together_without_their_counts(monkeypatch):
    """Read from the wrong mode, brackets in strings let depths drift: their counts stay with their split."""
    monkeypatch.setattr(cutting, "MOST_COUNTS", 50)
    pieces = [('[' if not i else '') + '{"a":"{"}' for i in range(3000)]
    cutter, halves = cutting.JsonElements(), (pieces[:1000], pieces[1000:])
    rows = lambda at, some: {"file": ["f"] * len(some), "block": [at] * len(some), "value": some}
    batches = [pa.RecordBatch.from_pydict(rows(at, half[i : i + 70])) for at, half in enumerate(halves) for i in range(0, len(half), 70)]
    summed = pa.Table.from_batches(list(cutting._summed_up(cutter)(iter(batches))))
    begun = cutting._put_together(cutter)(summed.drop_columns(["ends"])).to_pylist()
    assert [(r["block"], r["mode"], r["depth"]) for r in begun] == [(0, 0, 0), (1, 0, 1)]
    ends = summed.column("ends").to_pylist()
    assert [cutting.Ends.up_to(e[0], 1 - r["depth"]) for e, r in zip(ends, begun, strict=True)] == [1000, 2000]
    effect = cutter.effect(pa.array(halves[1]))
    after, depths = effect.run(1, 0)
    for depth in (-5, 0, 17, 1500):
        assert cutting.Ends.up_to(ends[1][1], depth) == int(((after == 0) & (depths <= depth)).sum())
