import datetime
import json
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from recordloom.errors import ConfigurationError, LoaderError
from recordloom.formats import Field, FormatSpec
from recordloom.operators.documents import extract_texts
from recordloom.sinks.writers import bad_lines, convert_jsonl, read_jsonl, save, selected_formats, write_csv, write_jsonl
from recordloom.sources.directory import ReadOptions, _extension_of_name, extension_of, read_documents, read_many
from recordloom.sources.files import (
    pages_to_docs,
    read_csv_docs,
    read_html_docs,
    read_json_docs,
    parquet_to_docs,
    read_text_docs,
)
from workloads import files
from workloads.fixtures import write_files


def put(folder, **files):
    for name, content in files.items():
        path = folder / name.replace("__", "/").replace("_dot_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(folder)


def by_name(frame):
    return {(r.source.rsplit("/", 1)[-1], r.row): r.text for r in frame.collect()}


def test_text_files(spark, tmp_path):
    folder = put(tmp_path, a_dot_txt=" one\n two\n", b_dot_txt="é")
    docs = read_text_docs(spark, folder)
    assert docs.columns == ["source", "row", "text", "metadata"]
    assert by_name(docs) == {("a.txt", 0): " one\n two\n", ("b.txt", 0): "é"}
    assert by_name(read_text_docs(spark, folder, clean=True))["a.txt", 0] == "one two"
    assert docs.head().metadata["source"] == docs.head().source


def test_other_encodings(spark, tmp_path):
    folder = put(tmp_path, a_dot_txt="é ñ".encode("latin-1"))
    assert by_name(read_text_docs(spark, folder, "latin-1")) == {("a.txt", 0): "é ñ"}
    put(tmp_path, a_dot_txt="é日".encode("utf-16"))
    assert by_name(read_text_docs(spark, folder, "UTF-16")) == {("a.txt", 0): "é日"}
    with pytest.raises(ConfigurationError):
        read_text_docs(spark, folder, "klingon")


def test_xml_and_html(spark, tmp_path):
    folder = put(
        tmp_path, x__a_dot_xml="<?xml version='1.0'?><r><a>1 &lt; 2</a>\n <b/>x</r>",
        h__a_dot_html="<title>T</title><body><p>hi<script>no()</script></p>", h__b_dot_html="<p>x",
    )
    assert by_name(read_text_docs(spark, f"{folder}/x", clean=True, markup=True)) == {("a.xml", 0): "1 < 2 x"}
    pages = read_html_docs(spark, f"{folder}/h")
    assert by_name(pages) == {("a.html", 0): "T hi", ("b.html", 0): "x"}
    titles = {r.source[-6:]: r.metadata.get("title") for r in pages.collect()}
    assert titles == {"a.html": "T", "b.html": None}


def test_pages(spark):
    pages = spark.createDataFrame([("https://a.b/", "<b>x</b>"), ("file:///x", "y"), (None, "z")], "url string, html string")
    assert [(r.source, r.text) for r in pages_to_docs(pages).collect()] == [("https://a.b/", "x")]


def test_csv(spark, tmp_path):
    folder = put(tmp_path, c__a_dot_csv='name, note \nx,"a ""q"", \nb"\ny,\n', s__a_dot_csv="a;b\n'x;y';2\n")
    rows = read_csv_docs(spark, f"{folder}/c").orderBy("row").collect()
    assert [r.text for r in rows] == ['name: x\nnote: a "q", \nb', "name: y\nnote: "]
    other = read_csv_docs(spark, f"{folder}/s", sep=";", quote="'").collect()
    assert [r.text for r in other] == ["a: x;y\nb: 2"]


def test_csv_headers_are_not_mixed_up(spark, tmp_path):
    folder = put(tmp_path, a_dot_csv="x,y\n1,2\n", b_dot_csv="y,x\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_docs(spark, folder).collect()
    put(tmp_path, c_dot_csv="x,y\n5,6\n", **{"d e_dot_csv": "z\n7\n"})
    mixed = read_csv_docs(spark, folder, mixed_headers=True)
    assert sorted(r.text for r in mixed.collect()) == ["x: 1\ny: 2", "x: 5\ny: 6", "y: 3\nx: 4", "z: 7"]
    documents, _ = read_documents(spark, folder, how=ReadOptions(csv={"mixed_headers": True}))
    assert documents.count() == 4



def test_json(spark, tmp_path):
    folder = put(
        tmp_path, j__a_dot_json='{"b": [{"t": "x"}, {"t": 994.0, "s": null}, {"u": 1}], "a": "é"}', j__b_dot_json="{broken",
        l__a_dot_jsonl='{"t": "x", "n": {"z": 1, "a": [2]}}\n\nbad\n{"t": null}\n',
    )
    whole = by_name(read_json_docs(spark, f"{folder}/j"))
    assert whole == {("a.json", 0): '{"b":[{"t":"x"},{"t":994.0,"s":null},{"u":1}],"a":"é"}', ("b.json", 0): None}
    assert by_name(read_json_docs(spark, f"{folder}/j/a.json", "$.a")) == {("a.json", 0): "é"}
    elements = read_json_docs(spark, f"{folder}/j/a.json", "$.b[*]").collect()
    assert [(r.metadata["seq_num"], r.text) for r in elements] == [
        ("0", '{"t":"x"}'), ("1", '{"t":994.0,"s":null}'), ("2", '{"u":1}'),
    ]
    assert [r.text for r in read_json_docs(spark, f"{folder}/j/a.json", "$.b[*].t").collect()] == ["x", "994.0"]
    lines = read_json_docs(spark, f"{folder}/l", "$.n", lines=True).orderBy("row").collect()
    assert [(r.text, r.metadata.get("error")) for r in lines] == [('{"z":1,"a":[2]}', None), (None, "invalid JSON")]
    with pytest.raises(ConfigurationError):
        read_json_docs(spark, folder, "$.a[*].b[*]")


def test_parquet(spark, tmp_path):
    stamp = datetime.datetime(2024, 5, 6, 7, 8, 9, 120000)
    rows = [(1, "x", 0.5, stamp, [1]), (2, None, None, datetime.datetime(2024, 1, 1), None)]
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame(rows, "id int, t string, f double, ts timestamp, l array<int>").coalesce(1).write.parquet(path)
    first, second = parquet_to_docs(spark, path).orderBy("row").collect()
    assert json.loads(first.text) == {"id": 1, "t": "x", "f": 0.5, "ts": "2024-05-06T07:08:09.120", "l": [1]}
    assert json.loads(second.text)["t"] is None
    assert first.metadata["ts"] == "2024-05-06T07:08:09.120000" and second.metadata["ts"] == "2024-01-01T00:00:00"
    assert (first.row, first.metadata["row"], first.metadata["l"]) == (0, "0", "[1]")
    with pytest.warns(UserWarning, match="nope"):
        narrow = parquet_to_docs(spark, path, "t", ["id", "nope"])
    assert [(r.text, sorted(r.metadata)) for r in narrow.orderBy("row").collect()] == [
        ("x", ["id", "row", "source"]), (None, ["id", "row", "source"]),
    ]
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:int,t:str" in plan and "ts#" not in plan and "l#" not in plan
    assert extract_texts(narrow).count() == 1
    with pytest.raises(LoaderError):
        parquet_to_docs(spark, path, "nope")


@pytest.fixture
def mixed(spark, tmp_path):
    put(
        tmp_path, a_dot_txt="one", B_dot_TXT="two", c_dot_md="three  x", d_dot_json='{"k": "four"}', e_dot_pdf="%PDF",
        f_dot_log="six", g="seven", sub__h_dot_txt="eight", sub__i_dot_log="nine", j_dot_csv="k\nten\n",
    )
    spark.createDataFrame([("eleven",)], "k string").coalesce(1).write.parquet(str(tmp_path / "table"))
    part = next(p for p in os.listdir(tmp_path / "table") if p.endswith(".parquet"))
    (tmp_path / "k.parquet").write_bytes((tmp_path / "table" / part).read_bytes())
    return str(tmp_path)


HOW = ReadOptions(json_path="$.k", parquet={"content_column": "k"})
TOP = {"one", "two", "three x", "four", "k: ten", "eleven"}


def test_folders(spark, mixed):
    documents, quarantine = read_documents(spark, mixed, how=HOW)
    assert {r.text for r in documents.collect()} == TOP
    assert {(r.source.rsplit("/", 1)[-1], r.extension) for r in quarantine.collect()} == {
        ("e.pdf", ".pdf"), ("f.log", ".log"), ("g", ""),
    }
    documents, quarantine = read_documents(spark, mixed, recursive=True, unsupported="text", how=HOW)
    assert {r.text for r in documents.collect()} >= TOP | {"six", "seven", "eight", "nine"}
    assert [r.extension for r in quarantine.where("source not like '%/table/%'").collect()] == [".pdf"]
    documents, quarantine = read_documents(spark, mixed, glob="[ac].*", how=HOW)
    assert {r.text for r in documents.collect()} == {"one", "three x"} and quarantine.isEmpty()
    with pytest.raises(LoaderError):
        read_documents(spark, mixed, unsupported="error", how=HOW)


def test_extensions_are_those_of_the_standard_library(spark):
    names = ["a.txt", "a.tar.GZ", ".bashrc", "a", "..x", "a..txt", ".a.txt", "x.y/b", "é.Md"]
    frame = spark.createDataFrame([(f"file:/d.e/{n}",) for n in names], "p string")
    got = [r.e for r in frame.select(extension_of(F.col("p")).alias("e")).collect()]
    expected = [pathlib.PurePosixPath(f"/d.e/{n}").suffix.lower() for n in names]
    assert got == expected and [_extension_of_name(f"/d.e/{n}") for n in names] == expected


def test_single_files_and_bad_sources(spark, mixed):
    assert [r.text for r in read_documents(spark, f"{mixed}/B.TXT")[0].collect()] == ["two"]
    documents, quarantine = read_documents(spark, f"{mixed}/f.log")
    assert documents.isEmpty() and [r.extension for r in quarantine.collect()] == [".log"]
    assert [r.text for r in read_documents(spark, f"{mixed}/f.log", unsupported="text")[0].collect()] == ["six"]
    for wrong in (f"{mixed}/none", "https://a.b/c"):
        with pytest.raises(ConfigurationError):
            read_documents(spark, wrong)
    with pytest.raises(LoaderError):
        read_documents(spark, f"{mixed}/e.pdf", unsupported="error")
    with pytest.raises(ConfigurationError):
        read_documents(spark, mixed, unsupported="ignore")


def test_many_sources(spark, mixed, tmp_path_factory):
    broken = tmp_path_factory.mktemp("broken") / "x.parquet"
    broken.write_bytes(b"not parquet")
    sources = [
        f"{mixed}/B.TXT", f"{mixed}/none.txt", f"{mixed}/sub", f"{mixed}/a.txt", str(broken), f"{mixed}/j.csv", f"{mixed}/a.txt",
        "http://a.b",
    ]
    documents, errors = read_many(spark, sources)
    assert sorted((r.source_pos, r.text) for r in documents.collect()) == [
        (0, "two"), (2, "eight"), (3, "one"), (5, "k: ten"), (6, "one"),
    ]
    assert {r.source_pos for r in errors.collect()} == {1, 4, 7}
    documents, errors = read_many(spark, [])
    assert documents.isEmpty() and errors.isEmpty()


ROW = FormatSpec("row", "", (Field("col_a", "integer"), Field("col_b", "string"), Field("col_c", "float", False)))


@pytest.fixture
def rows(spark):
    data = [(1, ' x "y", \n', 1.5), (2, "é", None), (3, "", 2.0)]
    return spark.createDataFrame(data, "col_a bigint, col_b string, col_c double")


def lines_of(path):
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    return "".join(open(os.path.join(path, p), encoding="utf-8", newline="").read() for p in parts)


def test_jsonl_and_csv_text(spark, rows, tmp_path):
    write_jsonl(rows, str(tmp_path / "j"), order=["col_a"], files=1)
    assert [json.loads(line) for line in lines_of(tmp_path / "j").splitlines()] == [
        {"col_a": 1, "col_b": ' x "y", \n', "col_c": 1.5}, {"col_a": 2, "col_b": "é", "col_c": None},
        {"col_a": 3, "col_b": "", "col_c": 2.0},
    ]
    write_csv(rows.withColumn("more", F.lit(1)), str(tmp_path / "c"), ["col_b", "col_a", "new"], ["col_a"], 1)
    assert lines_of(tmp_path / "c") == 'col_b,col_a,new\n" x ""y"", \n",1,\né,2,\n,3,\n'


def test_save(spark, rows, tmp_path):
    base = str(tmp_path / "deep" / "out")
    paths = save(rows, base, ["all", "csv"], ROW.field_names)
    assert paths == {f: f"{base}.{f}" for f in ("jsonl", "csv", "parquet")}
    assert spark.read.parquet(paths["parquet"]).schema.simpleString() == "struct<col_a:bigint,col_b:string,col_c:double>"
    assert sorted(r.col_a for r in read_jsonl(spark, paths["jsonl"], ROW).collect()) == [1, 2, 3]
    with pytest.warns(UserWarning):
        assert save(rows.limit(0), base + "x", ["csv"]) == {}
    with pytest.warns(UserWarning):
        assert save(rows, base + "y", []) == {}
    assert not os.path.exists(base + "x.csv")
    assert selected_formats(["parquet", "csv", "csv"]) == ["csv", "parquet"]
    with pytest.raises(ConfigurationError):
        selected_formats(["xls"])


def test_bad_lines_and_conversion(spark, tmp_path):
    put(tmp_path, a_dot_jsonl='{"col_a":1,"col_b":"x"}\n{"col_a":2\n\n[3]\n{"col_a":4} x\n{"col_a":5,"col_c":1}\n')
    path = f"{tmp_path}/a.jsonl"
    got = sorted((r.col_a, r.col_b, r.col_c) for r in read_jsonl(spark, path, ROW).collect())
    assert [g[0] for g in got] == [1, 5] and got[1][2] == 1.0
    assert {r.line for r in bad_lines(spark, path).collect()} == {'{"col_a":2', "", "[3]", '{"col_a":4} x'}
    with pytest.warns(UserWarning):
        report = convert_jsonl(spark, path, ROW, f"{tmp_path}/out", ["all"], expected=3)
    assert report.head().asDict() == {"loaded": 2, "expected": 3, "matches": False}
    assert spark.read.parquet(f"{tmp_path}/out.parquet").count() == 2
    assert not os.path.exists(f"{tmp_path}/out.jsonl")
    assert convert_jsonl(spark, path, ROW, f"{tmp_path}/out", ["csv"], expected=2).head().matches
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_jsonl(spark, f"{tmp_path}/none.jsonl", ROW)


def test_tables_with_different_columns(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(f"{tmp_path}/x/one.parquet")
    spark.createDataFrame([("s",)], "a string").coalesce(1).write.parquet(f"{tmp_path}/x/two.parquet")
    spark.createDataFrame([(2, 3)], "b int, c int").coalesce(1).write.parquet(f"{tmp_path}/x/three.parquet")
    files = [next(iter((tmp_path / "x" / n).glob("part-*.parquet"))) for n in ("one.parquet", "two.parquet", "three.parquet")]
    half = tmp_path / "half cut.parquet"
    half.write_bytes(files[0].read_bytes()[:-30])
    sources = [str(f) for f in files] + [str(half)]
    documents, errors = read_many(spark, sources)
    assert sorted((r.source_pos, r.text) for r in documents.collect()) == [(0, '{"a":1}'), (1, '{"a":"s"}'), (2, '{"b":2,"c":3}')]
    assert [(r.source_pos, r.source) for r in errors.collect()] == [(3, f"file://{half}")]
    documents, quarantine = read_documents(spark, str(tmp_path), recursive=True)
    assert documents.count() == 3
    assert "half cut.parquet" in {r.source.rsplit("/", 1)[-1] for r in quarantine.collect()}


def test_names_are_spelled_as_they_are(spark, tmp_path):
    (tmp_path / "my note+1 %é.txt").write_text("n")
    (tmp_path / "other.log").write_text("o")
    documents, quarantine = read_documents(spark, str(tmp_path), glob="my note*")
    assert [r.source for r in documents.collect()] == [f"file://{tmp_path}/my note+1 %é.txt"]
    documents, quarantine = read_documents(spark, str(tmp_path))
    assert [r.source for r in quarantine.collect()] == [f"file://{tmp_path}/other.log"]


def test_encodings_only_python_has(spark, tmp_path):
    for name, text in (("cp1252", "naïve €"), ("gb18030", "漢字"), ("shift_jis", "テキスト"), ("utf-8-sig", "bom")):
        (tmp_path / f"{name}.txt").write_bytes(text.encode(name))
        assert [r.text for r in read_text_docs(spark, f"{tmp_path}/{name}.txt", name).collect()] == [text]


def test_json_array_is_written_without_a_sort(spark, monkeypatch):
    """All lines of the array come to one task, which passes them on and holds none."""
    monkeypatch.setattr(type(spark.range(1)), "sortWithinPartitions", None)
    got = files.json_array_docs(spark, "/root/testdata/sf0.001")
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count() + 1
    assert got.where("text IS NULL").count() == 0 and got.where("""text = '{"note":"]","at":[]}'""").count() == 1


def test_files_of_a_single_partition_are_written_by_many_tasks(spark):
    rows = spark.range(200).coalesce(1).select(F.concat(F.lit("f-"), "id", F.lit(".txt")).alias("name"), F.col("id").cast("string").alias("content"))
    context, group = spark.sparkContext, "files-by-many-tasks"
    context.setJobGroup(group, group)
    try:
        folder = write_files(rows, "many")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = {stage for job in tracker.getJobIdsForGroup(group) for stage in tracker.getJobInfo(job).stageIds}
    assert max(tracker.getStageInfo(stage).numTasks for stage in stages if tracker.getStageInfo(stage)) > 1
    assert len(os.listdir(folder.removeprefix("file://"))) == 200
