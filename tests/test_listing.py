"""Folders that tasks list and read: the same documents as by Spark's readers, with no names on the driver.

Empty files differ: Spark's readers pass over them, here they are documents without text.
"""

from __future__ import annotations

import gzip

import pytest

from recordloom.sources import directory, files, listing
from recordloom.sources.directory import ReadOptions, read_documents, read_many
from recordloom.sources.files import read_text_docs

CONTENTS = {
    "a.txt": b"one\r\ntwo\n",
    "empty.txt": b"",
    "b [1] {x} 100%.TXT": "é 日 + x".encode(),
    "bad.txt": b"a\xffb",
    "packed.log.gz": gzip.compress(b"packed"),
    ".hidden.txt": b"no",
    "_not.txt": b"no",
    "_k=v.txt": b"yes",
    "deep/er/c.md": b"#  x \n\n y",
    "deep/_no/c.md": b"no",
    "p.html": b"<title>T</title><p>x &amp; y</p>",
    "x.xml": b"<r>1 &lt; 2</r>",
    "l.jsonl": b'\xef\xbb\xbf{"text":"l1"}\r\n\n{"text":"l2"}\rnot\n{"text":"l3"}',
    "j.json": b'{"text": "j"}',
    "a.csv": b'h,i\n"1,\n2", x \n\n3\n4,5,6\n',
    "b.csv": b"h\r\nq\r\n\"r\r\ns\"\r\n",
    "head.csv": b"h,i\n",
    "s.pdf": b"%PDF",
    "t.log": b"as text",
    "none": b"no ending",
}
HOW = ReadOptions(json_path="$.text", csv={"mixed_headers": True})


@pytest.fixture
def folder(tmp_path):
    for name, content in CONTENTS.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(content)
    (tmp_path / "in" / "gone.txt").symlink_to(tmp_path / "nothing")
    return f"{tmp_path}/in"


def rows(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


@pytest.fixture
def by_spark(monkeypatch):
    """Switches the listing by tasks off."""

    def switch():
        for module in (directory, listing):
            monkeypatch.setattr(module, "local_folders", lambda *_: None)

    return switch


@pytest.mark.parametrize("recursive", [False, True])
def test_same_documents_as_by_sparks_readers(spark, folder, by_spark, recursive):
    def found():
        documents, quarantine = read_documents(spark, folder, recursive, unsupported="text", how=HOW)
        return rows(documents, "source", "text", "metadata.source"), rows(quarantine, "source", "extension", "length", "reason")

    (own, own_quarantine) = found()
    by_spark()
    (documents, quarantine) = found()
    empty = f"file://{folder}/empty.txt"
    assert sorted([*documents, (empty, "", empty)], key=repr) == own
    assert own_quarantine == quarantine


def test_folders_that_name_a_value_are_gone_through(spark, tmp_path, by_spark):
    (tmp_path / "in" / "key=1").mkdir(parents=True)
    (tmp_path / "in" / "key=1" / "a.txt").write_text("value")
    own = rows(read_documents(spark, f"{tmp_path}/in")[0], "source", "text")
    by_spark()
    assert own == rows(read_documents(spark, f"{tmp_path}/in")[0], "source", "text") != []


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_same_texts_as_by_sparks_reader(spark, folder, by_spark, encoding):
    own = rows(read_text_docs(spark, folder, encoding), "source", "row", "text")
    by_spark()
    by_reader = rows(read_text_docs(spark, folder, encoding), "source", "row", "text")
    assert own == sorted([*by_reader, (f"file://{folder}/empty.txt", 0, "")], key=repr)


def test_files_of_folders_do_not_come_to_the_driver(spark, folder):
    documents, quarantine = read_documents(spark, folder, recursive=True, how=HOW)
    many, _ = read_many(spark, [folder, f"{folder}/deep/er"], how=HOW)
    for frame in (documents, quarantine, many, read_text_docs(spark, folder)):
        assert not [f for f in frame.inputFiles() if "/in/" in f and not f.endswith(".gz")]


def test_large_files_of_lines_are_left_to_spark(spark, folder, monkeypatch):
    expected = rows(read_documents(spark, folder, how=HOW)[0], "source", "text")
    monkeypatch.setattr(listing, "SMALL_FILE", 10)
    documents, _ = read_documents(spark, folder, how=HOW)
    assert rows(documents, "source", "text") == expected
    assert any(f.endswith(".csv") for f in documents.inputFiles())


def test_documents_of_one_folder_are_not_shuffled_to_its_name(spark, folder):
    documents, _ = read_many(spark, [f"{folder}/deep/er"], how=HOW)
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
