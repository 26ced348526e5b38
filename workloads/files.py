"""Queries that write the driver's tables as files of each kind and read them back as documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.formats import Field, FormatSpec
from recordloom.session import new_work_dir
from recordloom.sinks.writers import bad_lines, convert_jsonl, read_jsonl, save, write_csv, write_jsonl
from recordloom.sources.directory import ReadOptions, read_documents, read_many
from recordloom.sources.files import read_csv_docs, read_html_docs, read_json_docs, read_text_docs
from workloads.documents import sql_clean, sql_page_text, sql_page_title
from workloads.fixtures import table, write_files

if TYPE_CHECKING:
    import pyarrow as pa

Query = Callable[[SparkSession, str], DataFrame]

ROWS_PER_FILE = 50

PART = FormatSpec(
    "part",
    "A part.",
    (
        Field("p_partkey", "integer"),
        Field("p_name", "string"),
        Field("p_brand", "string"),
        Field("p_size", "integer"),
        Field("p_retailprice", "float"),
        Field("note", "string", False),
    ),
)


def _file_name() -> Column:
    return F.substring_index("source", "/", -1).alias("file")


def _named(rows: DataFrame, name: Column, content: Column) -> DataFrame:
    return rows.select(name.alias("name"), content.alias("content"))


def _numbered(prefix: str, key: str, extension: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(extension))


def text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text file per document."""
    documents = table(spark, sf_dir, "documents")
    folder = write_files(_named(documents, _numbered("doc-", "doc_id", ".txt"), F.col("text")), "txt")
    return read_text_docs(spark, folder).select(_file_name(), "row", "text")


def md_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Markdown file per conversation turn, read with its whitespace collapsed."""
    turns = table(spark, sf_dir, "conversations").withColumn("id", F.concat_ws("-", "conv_id", "turn"))
    content = F.concat(F.lit("#  "), "role", F.lit("\n\n"), "text", F.lit("\n"))
    folder = write_files(_named(turns, _numbered("turn-", "id", ".md"), content), "md")
    return read_text_docs(spark, folder, clean=True).select(_file_name(), "text")


def xml_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An XML file per benchmark text, read without its tags."""
    content = F.concat(F.lit('<?xml version="1.0"?>\n<item id="1"><t>'), "text", F.lit("</t> <u>&lt;end&gt;</u></item>"))
    rows = table(spark, sf_dir, "benchmark")
    folder = write_files(_named(rows, _numbered("item-", "item_id", ".xml"), content), "xml")
    return read_text_docs(spark, folder, clean=True, markup=True).select(_file_name(), "text")


def html_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An HTML file per page."""
    folder = write_files(
        _named(table(spark, sf_dir, "pages"), _numbered("page-", "page_id", ".html"), F.col("html")), "html"
    )
    return read_html_docs(spark, folder).select(_file_name(), "text", F.col("metadata")["title"].alias("title"))


def csv_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as CSV rows, with commas, quotes and line breaks in them."""
    priority = F.concat(F.lit('say "'), "o_orderpriority", F.lit('",\nthen'))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", priority.alias("note"), "o_totalprice")
    path = new_work_dir(spark, "csv")
    write_csv(orders, path)
    return read_csv_docs(spark, path).select("text")


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a comment that has quotes, commas, brackets and line breaks in it."""
    way = F.col("l_linenumber") % 4
    note = (
        F.when(way == 0, F.concat(F.lit('a "'), "l_returnflag", F.lit('",\nthen [x], ""')))
        .when(way == 1, F.concat(F.lit("{\\"), "l_returnflag", F.lit("\r\n,\n\n")))
        .when(way == 2, F.lit(None))
        .otherwise(F.col("l_returnflag"))
    )
    rows = table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", note.alias("note"), "l_linenumber", "l_quantity")


def csv_split_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files of all order lines, written and read in many tasks, and one of parts with another header."""
    path = new_work_dir(spark, "csv")
    write_csv(_line_items(spark, sf_dir), f"{path}/lines")
    write_csv(_parts(spark, sf_dir), f"{path}/parts", order=["p_partkey"], files=1)
    documents = read_csv_docs(spark, [f"{path}/lines", f"{path}/parts"], split=True)
    place = F.when(F.col("text").startswith("p_partkey"), F.col("row"))  # parts were written in order
    return documents.select(place.alias("row"), "text")


def json_array_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array of all order lines, read in many tasks."""
    path = new_work_dir(spark, "array")
    items = _line_items(spark, sf_dir).select(F.struct("l_orderkey", F.struct("note", F.array("l_linenumber").alias("at")).alias("of")).alias("item"))
    line = F.to_json("item", {"ignoreNullFields": "false"})
    lines = items.select(F.concat(F.lit(" "), line, F.lit(",")).alias("value"))

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines of one file as they come: an opening bracket, elements with a comma behind each, a last one and the end."""
        import pyarrow as pa

        def one(value: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([value], pa.string())], names=["value"])

        yield one("[")
        yield from batches
        yield one('{"l_orderkey":0,"of":{"note":"]","at":[]}}]')

    lines.repartition(1).mapInArrow(bracketed, "value string").write.text(path)
    return read_json_docs(spark, path, "$[*].of", split=True).select("text")


def tsv_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tab-separated file per fifty parts, each read as one document."""
    line = F.struct("p_partkey", F.concat_ws("\t", "p_partkey", "p_name", "p_size").alias("line"))
    files = (
        table(spark, sf_dir, "part")
        .groupBy(F.floor(F.col("p_partkey") / ROWS_PER_FILE).alias("id"))
        .agg(F.array_join(F.array_sort(F.collect_list(line))["line"], "\n").alias("rows"))
    )
    content = F.concat(F.lit("key\tname\tsize\n"), "rows", F.lit("\n"))
    folder = write_files(_named(files, _numbered("parts-", "id", ".tsv"), content), "tsv")
    return read_text_docs(spark, folder, clean=True).select(_file_name(), "text")


def tsv_row_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tab-separated rows, each read as one document."""
    path = new_work_dir(spark, "tsv-rows")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    part.write.options(header="true", sep="\t").csv(path)
    return read_csv_docs(spark, path, sep="\t", multi_line=False).select("text")


def json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON file per fifty parts; each element of its list is a document."""
    item = F.struct("p_partkey", "p_name", "p_retailprice")
    files = (
        table(spark, sf_dir, "part")
        .groupBy(F.floor(F.col("p_partkey") / ROWS_PER_FILE).alias("id"))
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
    )
    content = F.to_json(F.struct(F.struct("items").alias("data")))
    folder = write_files(_named(files, _numbered("parts-", "id", ".json"), content), "json")
    rows = read_json_docs(spark, folder, "$.data.items[*]")
    return rows.select(_file_name(), F.col("metadata")["seq_num"].cast("bigint").alias("seq_num"), "text")


def jsonl_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON line per event; the number in its properties is the document."""
    path = new_work_dir(spark, "jsonl")
    props = F.from_json("props", "k bigint").alias("props")
    table(spark, sf_dir, "events").select("event_id", props).write.json(path)
    return read_json_docs(spark, path, "$.props.k", lines=True).groupBy("text").agg(F.count("*").alias("documents"))


def _mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts and pages under names of eight kinds, some in a subfolder, some unreadable."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    ending = F.element_at(
        F.array(*[F.lit(e) for e in (".txt", ".MD", ".json", ".jsonl", ".rst", ".pdf", ".log", "")]),
        (F.col("doc_id") % 8 + 1).cast("int"),
    )
    kind = F.col("doc_id") % 8
    content = F.when(kind.isin(2, 3), F.to_json(F.struct("text"))).otherwise(F.col("text"))
    place = F.when(F.col("doc_id") % 3 == 0, F.lit("more/")).otherwise(F.lit(""))
    name = F.concat(place, F.lit("doc-"), F.col("doc_id").cast("string"), ending)
    return _named(texts, name, content)


HOW = ReadOptions(json_path="$.text")


def dir_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files of many kinds, with subfolders; unknown kinds are read as text."""
    folder = write_files(_mixed_files(spark, sf_dir), "mixed")
    documents, _ = read_documents(spark, folder, recursive=True, unsupported="text", how=HOW)
    return documents.select(_file_name(), "text")


def quarantined_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the top folder that are of no known kind."""
    folder = write_files(_mixed_files(spark, sf_dir), "mixed")
    _, quarantine = read_documents(spark, folder, how=HOW)
    return quarantine.select(_file_name(), "extension", "length", "reason")


def many_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder, a missing path and a Parquet table as one set of documents, with what failed."""
    turns = table(spark, sf_dir, "conversations").withColumn("id", F.concat_ws("-", "conv_id", "turn"))
    folder = write_files(_named(turns, _numbered("turn-", "id", ".txt"), F.col("text")), "many")
    how = ReadOptions(parquet={"content_column": "text", "metadata_columns": []})
    sources = [folder, f"{folder}/missing.txt", f"{sf_dir}/benchmark.parquet", "https://example.com/page"]
    documents, errors = read_many(spark, sources, how=how)
    return documents.select("source_pos", "text").unionByName(
        errors.select("source_pos", F.col("error").alias("text"))
    )


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records, with texts that need quoting and some NULLs."""
    way = F.col("p_partkey") % 4
    note = (
        F.when(way == 0, F.concat(F.lit('  a "quoted", '), "p_name"))
        .when(way == 1, F.lit("ñ 日本 \\ /"))
        .when(way == 2, F.lit(" two\nlines "))
    )
    part = table(spark, sf_dir, "part").withColumn("note", note).withColumn("p_size", F.col("p_size").cast("bigint"))
    return part.select(*PART.field_names)


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "out")
    write_jsonl(_parts(spark, sf_dir), path, order=["p_partkey"])
    return read_jsonl(spark, path, PART)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three formats saved at once, the CSV read back. CSV has no NULL: missing texts come back as such."""
    paths = save(_parts(spark, sf_dir), new_work_dir(spark, "out"), ["all", "csv"], PART.field_names)
    reader = spark.read.schema(PART.schema).options(
        header="true", escape='"', multiLine="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    )
    return reader.csv(paths["csv"])


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = save(_parts(spark, sf_dir), new_work_dir(spark, "out"), ["parquet"], PART.field_names)
    return spark.read.parquet(paths["parquet"])


def _lines_with_errors(spark: SparkSession, sf_dir: str) -> str:
    """JSON lines of parts, every seventh of them broken in one of three ways."""
    line = F.to_json(F.struct(*PART.field_names), {"ignoreNullFields": "false"})
    key = F.col("p_partkey")
    broken = (
        F.when(key % 21 == 0, F.concat(line, F.lit(" x")))
        .when(key % 21 == 7, F.substring(line, F.lit(1), F.length(line) - 1))
        .when(key % 21 == 14, F.lit("[1, 2]"))
        .otherwise(line)
    )
    path = new_work_dir(spark, "lines")
    _parts(spark, sf_dir).select(broken.alias("value")).write.text(path)
    return path


def jsonl_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad_lines(spark, _lines_with_errors(spark, sf_dir)).groupBy("line").agg(F.count("*").alias("lines"))


def jsonl_good_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_jsonl(spark, _lines_with_errors(spark, sf_dir), PART)


def converted_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with bad ones among them converted; the count differs from the number of parts."""
    expected = table(spark, sf_dir, "part").count()
    path = _lines_with_errors(spark, sf_dir)
    return convert_jsonl(spark, path, PART, new_work_dir(spark, "out"), ["all"], expected)


def converted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the converted CSV and Parquet files hold, record by record, beside the counts of the conversion."""
    base = new_work_dir(spark, "out")
    report = convert_jsonl(spark, _lines_with_errors(spark, sf_dir), PART, base, ["all"])
    reader = spark.read.schema(PART.schema).options(
        header="true", escape='"', multiLine="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    )
    found = {"csv": reader.csv(f"{base}.csv"), "parquet": spark.read.parquet(f"{base}.parquet")}
    rows = [f.select(F.lit(name).alias("format"), *PART.field_names) for name, f in found.items()]
    counted = report.select(F.lit("loaded").alias("format"), F.col("loaded").alias("p_partkey"))
    return rows[0].unionByName(rows[1]).unionByName(counted, allowMissingColumns=True)


def _every_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns under names of every kind of file that is read, in folders of two levels."""
    turns = table(spark, sf_dir, "conversations").withColumn("id", F.expr("conv_id * 100 + turn"))
    kinds = (".txt", ".md", ".rst", ".tsv", ".xml", ".html", ".HTM", ".csv", ".json", ".jsonl", ".bin")
    kind = F.col("id") % len(kinds)
    safe = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    quoted = F.concat(F.lit('text,"no"\n"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('",1\n'))
    other = F.concat(F.lit("no\n2\n"), "id", F.lit("\n"))
    content = (
        F.when(kind == 4, F.concat(F.lit("<r><t>"), safe, F.lit("</t></r>")))
        .when(kind.isin(5, 6), F.concat(F.lit("<title>T</title><p>"), safe, F.lit("</p>")))
        .when((kind == 7) & (F.col("turn") == 0), other)
        .when(kind == 7, quoted)
        .when(kind.isin(8, 9), F.to_json(F.struct("text")))
        .otherwise(F.col("text"))
    )
    ending = F.element_at(F.array(*[F.lit(k) for k in kinds]), (kind + 1).cast("int"))
    place = F.when(F.col("turn") % 2 == 0, F.lit("deep/er/")).otherwise(F.lit(""))
    return _named(turns, F.concat(place, F.lit("turn-"), F.col("id").cast("string"), ending), content)


def dir_all_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with files of every kind, CSV files of two headers and unlike Parquet tables among them; unknown ones stay out."""
    folder = write_files(_every_kind(spark, sf_dir), "kinds")
    _unlike_tables(spark, sf_dir, f"{folder}/tables")
    how = ReadOptions(json_path="$.text", csv={"mixed_headers": True})
    documents, quarantine = read_documents(spark, folder, recursive=True, glob="[!_]*", how=how)
    left_out = quarantine.select(_file_name(), F.lit(None).cast("string").alias("text"))
    # part files have names of Spark's own
    name = F.regexp_replace(F.substring_index("source", "/", -1), r"^part-.*\.parquet$", "part.parquet").alias("file")
    return documents.select(name, "text").unionByName(left_out)


def _unlike_tables(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Three Parquet tables in one folder: one column has another type in each, or is missing."""
    items = table(spark, sf_dir, "benchmark")
    items.select("item_id", "text").write.parquet(f"{path}/a")
    items.select(F.concat(F.lit("i"), "item_id").alias("item_id"), (F.col("item_id") / 4).alias("share")).write.parquet(f"{path}/b")
    items.select(F.length("text").alias("size")).write.parquet(f"{path}/c")


def many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlike Parquet tables, named one by one and through a folder, as one set of documents; each row has its own columns."""
    folder = new_work_dir(spark, "tables")
    _unlike_tables(spark, sf_dir, folder)
    documents, _ = read_many(spark, [f"{folder}/b", f"{folder}/a", f"{folder}/c"])
    keys = F.array_join(F.array_sort(F.array_except(F.map_keys("metadata"), F.array(F.lit("source"), F.lit("row")))), ",")
    return documents.select("source_pos", "text", keys.alias("columns"))


def many_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of which some cannot be read: files that are no Parquet, a missing path, an unknown kind, a page."""
    items = table(spark, sf_dir, "benchmark")
    folder = write_files(_named(items, _numbered("item-", "item_id", ".parquet"), F.col("text")), "broken")
    items.select("item_id", "text").coalesce(1).write.mode("append").parquet(folder)
    other = write_files(_named(items.where("item_id = 1"), _numbered("item-", "item_id", ".pdf"), F.col("text")), "other")
    sources = [folder, f"{other}/item-1.pdf", f"{folder}/gone.csv", "https://example.com/"]
    how = ReadOptions(parquet={"content_column": "text", "metadata_columns": []})
    documents, errors = read_many(spark, sources, how=how)
    reason = F.when(F.col("source").endswith(".parquet"), "not a table").otherwise(F.col("error"))
    failed = errors.select("source_pos", F.substring_index("source", "/", -1).alias("name"), reason.alias("text"))
    return documents.select("source_pos", F.lit("row").alias("name"), "text").unionByName(failed)


QUERIES: dict[str, Query] = {
    "text_docs": text_docs,
    "md_docs": md_docs,
    "xml_docs": xml_docs,
    "html_docs": html_docs,
    "csv_docs": csv_docs,
    "csv_split_docs": csv_split_docs,
    "json_array_docs": json_array_docs,
    "tsv_docs": tsv_docs,
    "tsv_row_docs": tsv_row_docs,
    "json_docs": json_docs,
    "jsonl_docs": jsonl_docs,
    "dir_docs": dir_docs,
    "quarantined_files": quarantined_files,
    "many_docs": many_docs,
    "jsonl_roundtrip": jsonl_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "jsonl_bad_lines": jsonl_bad_lines,
    "jsonl_good_lines": jsonl_good_lines,
    "converted_jsonl": converted_jsonl,
    "converted_files": converted_files,
    "dir_all_kinds": dir_all_kinds,
    "many_tables": many_tables,
    "many_errors": many_errors,
}

# ---------------------------------------------------------------------------------------------------
# The same results in SQL.

MIXED = """mixed AS (
  SELECT doc_id, text, doc_id % 8 AS kind, doc_id % 3 = 0 AS deeper,
    'doc-' || doc_id || CASE doc_id % 8 WHEN 0 THEN '.txt' WHEN 1 THEN '.MD' WHEN 2 THEN '.json' WHEN 3 THEN '.jsonl'
      WHEN 4 THEN '.rst' WHEN 5 THEN '.pdf' WHEN 6 THEN '.log' ELSE '' END AS file
  FROM documents
)"""

PARTS = """parts AS (
  SELECT p_partkey, p_name, p_brand, p_size::BIGINT AS p_size, p_retailprice,
    CASE p_partkey % 4 WHEN 0 THEN '  a "quoted", ' || p_name WHEN 1 THEN 'ñ 日本 \\ /'
      WHEN 2 THEN ' two' || chr(10) || 'lines ' END AS note
  FROM part
)"""

UNLIKE = """
  SELECT 1 AS source_pos, to_json({'item_id': item_id, 'text': text})::VARCHAR AS text, 'item_id,text' AS columns FROM benchmark
  UNION ALL SELECT 0, to_json({'item_id': 'i' || item_id, 'share': item_id / 4.0::DOUBLE})::VARCHAR, 'item_id,share' FROM benchmark
  UNION ALL SELECT 2, to_json({'size': length(text)})::VARCHAR, 'size' FROM benchmark"""

LINES = """lines AS (
  SELECT l_orderkey, l_linenumber, l_quantity, CASE l_linenumber % 4 WHEN 0 THEN 'a "' || l_returnflag || '",' || chr(10) || 'then [x], ""'
    WHEN 1 THEN '{\\' || l_returnflag || chr(13) || chr(10) || ',' || chr(10) || chr(10) WHEN 2 THEN NULL ELSE l_returnflag END AS note
  FROM lineitem
)"""

LINE = """to_json({'p_partkey': p_partkey, 'p_name': p_name, 'p_brand': p_brand, 'p_size': p_size,
  'p_retailprice': p_retailprice, 'note': note})::VARCHAR"""

ORACLES: dict[str, str] = {
    "text_docs": "SELECT 'doc-' || doc_id || '.txt' AS file, 0::BIGINT AS row, text FROM documents",
    "md_docs": f"""SELECT 'turn-' || conv_id || '-' || turn || '.md' AS file,
  {sql_clean("'# ' || role || ' ' || text")} AS text FROM conversations""",
    "xml_docs": f"""SELECT 'item-' || item_id || '.xml' AS file, {sql_clean("text || ' <end>'")} AS text FROM benchmark""",
    "html_docs": f"""SELECT 'page-' || page_id || '.html' AS file, {sql_page_text('html')} AS text,
  {sql_page_title('html')} AS title FROM pages""",
    "csv_docs": """SELECT 'o_orderkey: ' || o_orderkey || chr(10) || 'note: say "' || o_orderpriority || '",' || chr(10)
  || 'then' || chr(10) || 'o_totalprice: ' || o_totalprice AS text FROM orders""",
    "csv_split_docs": f"""WITH {LINES}, {PARTS}
SELECT NULL::BIGINT AS row, 'l_orderkey: ' || l_orderkey || chr(10) || 'note: ' || regexp_replace(coalesce(note, ''), '\\s+$', '') || chr(10)
  || 'l_linenumber: ' || l_linenumber || chr(10) || 'l_quantity: ' || l_quantity AS text FROM lines
UNION ALL SELECT row_number() OVER (ORDER BY p_partkey) - 1, 'p_partkey: ' || p_partkey || chr(10) || 'p_name: ' || trim(p_name) || chr(10) || 'p_brand: '
  || p_brand || chr(10) || 'p_size: ' || p_size || chr(10) || 'p_retailprice: ' || p_retailprice || chr(10) || 'note: '
  || trim(coalesce(note, ''), ' ' || chr(10)) FROM parts""",
    "json_array_docs": f"""WITH {LINES}
SELECT to_json({{'note': note, 'at': [l_linenumber]}})::VARCHAR AS text FROM lines UNION ALL SELECT '{{"note":"]","at":[]}}'""",
    "tsv_docs": """SELECT 'parts-' || id || '.tsv' AS file,
  'key' || chr(9) || 'name' || chr(9) || 'size ' || string_agg(p_partkey || chr(9) || p_name || chr(9) || p_size, ' '
  ORDER BY p_partkey) AS text
FROM (SELECT *, p_partkey // 50 AS id FROM part) GROUP BY id""",
    "tsv_row_docs": """SELECT 'p_partkey: ' || p_partkey || chr(10) || 'p_name: ' || p_name || chr(10) || 'p_size: '
  || p_size AS text FROM part""",
    "json_docs": """SELECT 'parts-' || (p_partkey // 50) || '.json' AS file, p_partkey % 50 AS seq_num,
  to_json({'p_partkey': p_partkey, 'p_name': p_name, 'p_retailprice': p_retailprice})::VARCHAR AS text FROM part""",
    "jsonl_docs": """SELECT json_extract_string(props, '$.k') AS text, count(*) AS documents FROM events GROUP BY 1""",
    "dir_docs": f"""WITH {MIXED}
SELECT file, CASE WHEN kind IN (1, 4) THEN {sql_clean('text')} ELSE text END AS text FROM mixed WHERE kind <> 5""",
    "quarantined_files": f"""WITH {MIXED}
SELECT file, CASE kind WHEN 5 THEN '.pdf' WHEN 6 THEN '.log' ELSE '' END AS extension,
  octet_length(encode(text))::BIGINT AS length, 'unsupported_format' AS reason
FROM mixed WHERE kind IN (5, 6, 7) AND NOT deeper""",
    "many_docs": """SELECT 0 AS source_pos, text FROM conversations
UNION ALL SELECT 2, text FROM benchmark
UNION ALL SELECT 1, 'path not found' UNION ALL SELECT 3, 'fetching pages is not supported'""",
    "jsonl_roundtrip": f"WITH {PARTS} SELECT * FROM parts",
    "csv_roundtrip": f"WITH {PARTS} SELECT * FROM parts",
    "parquet_roundtrip": f"WITH {PARTS} SELECT * FROM parts",
    "jsonl_bad_lines": f"""WITH {PARTS}, lines AS (SELECT p_partkey % 21 AS way, {LINE} AS line FROM parts)
SELECT line, count(*) AS lines FROM (
  SELECT CASE way WHEN 0 THEN line || ' x' WHEN 7 THEN line[:-2] ELSE '[1, 2]' END AS line
  FROM lines WHERE way IN (0, 7, 14)) GROUP BY line""",
    "jsonl_good_lines": f"WITH {PARTS} SELECT * FROM parts WHERE p_partkey % 7 <> 0",
    "converted_jsonl": """SELECT count(*) FILTER (p_partkey % 7 <> 0) AS loaded, count(*) AS expected,
  count(*) FILTER (p_partkey % 7 <> 0) = count(*) AS matches FROM part""",
    "converted_files": f"""WITH {PARTS}
SELECT format, parts.* FROM parts, (VALUES ('csv'), ('parquet')) f(format) WHERE p_partkey % 7 <> 0
UNION ALL SELECT 'loaded', count(*), NULL, NULL, NULL, NULL, NULL FROM parts WHERE p_partkey % 7 <> 0""",
    "dir_all_kinds": f"""WITH turns AS (SELECT *, conv_id * 100 + turn AS id, (conv_id * 100 + turn) % 11 AS kind FROM conversations)
SELECT 'turn-' || id || ['.txt', '.md', '.rst', '.tsv', '.xml', '.html', '.HTM', '.csv', '.json', '.jsonl', '.bin'][kind + 1] AS file,
  CASE WHEN kind IN (1, 2, 3, 4) THEN {sql_clean('text')} WHEN kind IN (5, 6) THEN 'T ' || {sql_clean('text')}
    WHEN kind = 7 AND turn = 0 THEN 'no: ' || row WHEN kind = 7 THEN 'text: ' || trim(text) || chr(10) || 'no: 1'
    WHEN kind = 10 THEN NULL ELSE text END AS text
FROM (SELECT *, unnest(CASE WHEN kind = 7 AND turn = 0 THEN [2, id] ELSE [0] END) AS row FROM turns)
UNION ALL SELECT 'part.parquet', text FROM ({UNLIKE})""",
    "many_tables": f"SELECT source_pos, text, columns FROM ({UNLIKE})",
    "many_errors": """SELECT 0 AS source_pos, 'row' AS name, text FROM benchmark
UNION ALL SELECT 0, 'item-' || item_id || '.parquet', 'not a table' FROM benchmark
UNION ALL SELECT 1, 'item-1.pdf', 'unsupported file format' UNION ALL SELECT 2, 'gone.csv', 'path not found'
UNION ALL SELECT 3, '', 'fetching pages is not supported'""",
}
