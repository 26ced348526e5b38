"""Readers that turn files into a documents table.

Every reader returns ``source STRING, row BIGINT, text STRING, metadata MAP<STRING,STRING>``. ``row`` is 0
for one-document files, the row number for Parquet, and elsewhere a number that grows in file order.

Readers of text, HTML, JSON and CSV files also take a table of files as ``paths``, such as
:func:`recordloom.sources.listing.list_folders` makes, which tasks open.
"""

from __future__ import annotations

import codecs
import sys
import warnings
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.errors import ConfigurationError, LoaderError
from recordloom.functions.json_text import parse_json_strict
from recordloom.functions.sql import named
from recordloom.functions.text import (
    HTML_TITLE,
    clean_whitespace,
    decode_entities,
    is_web_url,
    strip,
    stripped,
    visible_markup,
)
from recordloom.operators.once import computed_once
from recordloom.session import prepare
from recordloom.sources import listing
from recordloom.sources.cutting import CsvRows, JsonElements, pieces_of, records

# The decoding of other encodings goes to the executors as it is.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DOCUMENT_SCHEMA = "source string, row bigint, text string, metadata map<string,string>"

# Names of encodings as Python and as Spark know them.
ENCODINGS = {
    "utf-8": "UTF-8",
    "utf8": "UTF-8",
    "ascii": "US-ASCII",
    "us-ascii": "US-ASCII",
    "latin-1": "ISO-8859-1",
    "latin1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
    "utf-16": "UTF-16",
    "utf-16le": "UTF-16LE",
    "utf-16be": "UTF-16BE",
    "utf-32": "UTF-32",
}

def one_spelling(path: Column) -> Column:
    """A path as the library spells it everywhere: characters as they are, local files as ``file:///…``."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def file_path() -> Column:
    """Path of the file a row was read from. (The metadata column has it percent-encoded.)"""
    return one_spelling(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def spark_encoding(name: str) -> str | None:
    """Spark's name of an encoding, None if only Python has it."""
    known = ENCODINGS.get(name.lower().replace("_", "-"))
    if known is None:
        try:
            codecs.lookup(name)
        except LookupError:
            raise ConfigurationError(f"unknown encoding '{name}'") from None
    return known


def _decoded(encoding: str):
    """Bytes to text by one of Python's encodings; bytes that mean nothing become U+FFFD."""

    @F.pandas_udf("string")
    def decode(contents: pd.Series) -> pd.Series:
        return contents.map(lambda c: None if c is None else bytes(c).decode(encoding, "replace"))

    return decode


def _metadata(**entries: Column) -> Column:
    """Map of the entries that are not NULL."""
    pairs = F.map_from_arrays(
        F.array(*[F.lit(k) for k in entries]), F.array(*[v.cast("string") for v in entries.values()])
    )
    return F.map_filter(pairs, lambda _, v: v.isNotNull())


def _whole_files(
    spark: SparkSession, paths: str | Sequence[str] | DataFrame, encoding: str, options: dict[str, str] | None
) -> DataFrame:
    """``(source, content)``, one row per file."""
    charset = spark_encoding(encoding)
    listed = paths if isinstance(paths, DataFrame) else listing.listed_folder(spark, paths, options)

    def texts(named: list[str]) -> DataFrame:
        files = spark.read.options(**(options or {})).text(named, wholetext=True)
        return files.select(file_path().alias("source"), F.col("value").alias("content"))

    if listed is None:
        paths = [paths] if isinstance(paths, str) else list(paths)
    if charset == "UTF-8":
        return texts(paths) if listed is None else listing.texts(listed, texts)
    if listed is None:
        files = spark.read.format("binaryFile").options(**(options or {})).load(paths).withColumn("source", one_spelling(F.col("path")))
    else:
        files = listing.contents(listed)
    text = F.decode("content", charset) if charset else _decoded(encoding)("content")
    return files.select("source", text.alias("content"))


def read_text_docs(
    spark: SparkSession,
    paths: str | Sequence[str] | DataFrame,
    encoding: str = "utf-8",
    clean: bool = False,
    markup: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One document per file. ``clean`` collapses whitespace, ``markup`` takes tags out first (XML)."""
    files = _whole_files(spark, paths, encoding, options)
    if markup:
        files = _with_visible_text(files, "content")
    text = F.col("text" if markup else "content")
    return files.select(
        "source",
        F.lit(0).cast("bigint").alias("row"),
        (clean_whitespace(text) if clean else text).alias("text"),
        _metadata(source=F.col("source")).alias("metadata"),
    )


def _with_visible_text(rows: DataFrame, markup: str, title: str | None = None) -> DataFrame:
    """Add ``text``, the visible text of a markup column, and, under a name, the title of the page.

    Done in steps whose results are computed once, whatever is later filtered on.
    """
    steps = rows.withColumn("text", visible_markup(F.col(markup)))
    steps = steps.withColumn("text", F.expr(decode_entities("text")))
    steps = steps.withColumn("text", clean_whitespace(F.col("text")))
    if title is None:
        return computed_once(steps, ["text"])
    heading = steps.withColumn(title, F.regexp_extract(markup, HTML_TITLE, 1))
    heading = heading.withColumn(title, F.expr(decode_entities(named(title))))
    steps = heading.withColumn(title, clean_whitespace(F.col(title)))
    return computed_once(steps, ["text", title])


def read_html_docs(
    spark: SparkSession,
    paths: str | Sequence[str] | DataFrame,
    encoding: str = "utf-8",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One document per page: visible text, with the title in the metadata."""
    return _page_documents(_whole_files(spark, paths, encoding, options), "source", "content")


def _page_documents(pages: DataFrame, source: str, html: str) -> DataFrame:
    page = pages.select(F.col(source).alias("source"), F.col(html).alias("html"))
    title = F.col("title")
    return _with_visible_text(page, "html", "title").select(
        "source",
        F.lit(0).cast("bigint").alias("row"),
        "text",
        _metadata(source=F.col("source"), title=F.when(title != "", title)).alias("metadata"),
    )


def pages_to_docs(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Documents of crawled pages; rows without a web URL are left out."""
    return _page_documents(pages.where(is_web_url(F.col(url))), url, html)


def _files_by_header(spark: SparkSession, paths: Sequence[str], options: dict[str, str] | None) -> list[list[str]]:
    """Files with the same first line, each group as a list of paths.

    One row per file comes back, with its name and first line; the file names are what a reader given the same
    paths would list on the driver too.
    """
    lines = (
        spark.read.options(**(options or {}))
        .text(list(paths))
        .where(F.col("_metadata.file_block_start") == 0)  # the first line is in the first part of a file
        .select(file_path().alias("file"), F.monotonically_increasing_id().alias("place"), "value")
    )
    groups: dict[str, list[str]] = {}
    for row in lines.groupBy("file").agg(F.min_by("value", "place").alias("value")).toLocalIterator():
        groups.setdefault(row.value, []).append(row.file)
    return [sorted(files) for _, files in sorted(groups.items())]


def read_csv_docs(
    spark: SparkSession,
    paths: str | Sequence[str] | DataFrame,
    sep: str = ",",
    quote: str = '"',
    encoding: str = "utf-8",
    multi_line: bool = True,
    mixed_headers: bool = False,
    split: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One document per row: ``column: value`` lines.

    All files of one call share a header; a different one is an error, not a mix-up. ``mixed_headers``
    looks up the header of every file first, which reads the files as text, and then reads those with the
    same header together. ``multi_line`` allows line breaks in quoted values but keeps a file in one
    task; turn it off for large files without them.

    ``split`` reads large files in many tasks, line breaks in values or not (see :mod:`recordloom.sources.cutting`), and
    gives the same rows; every file has its own header, and ``row`` counts from 0 in each file. UTF-8 only. Files of a
    table with ``mixed_headers`` are read that way, too.
    """
    if isinstance(paths, DataFrame):
        split = split or (mixed_headers and multi_line and spark_encoding(encoding) in ("UTF-8", "US-ASCII"))
        if not split:
            paths = listing.names_of(paths)
    else:
        paths = [paths] if isinstance(paths, str) else list(paths)
    if split:
        if spark_encoding(encoding) not in ("UTF-8", "US-ASCII"):
            raise ConfigurationError("CSV files are read in splits as UTF-8")
        return _split_csv_docs(spark, paths, sep, quote, options)
    if mixed_headers:
        groups = _files_by_header(spark, paths, options)
        frames = [
            read_csv_docs(spark, files, sep, quote, encoding, multi_line, options=options)
            for files in groups
        ]
        return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], DOCUMENT_SCHEMA)
    charset = spark_encoding(encoding)
    if charset is None:
        raise ConfigurationError(f"CSV files are read as one of {', '.join(ENCODINGS)}")
    rows = (
        spark.read.options(**(options or {}))
        .option("enforceSchema", "false")
        .csv(
            paths,
            header=True,
            sep=sep,
            quote=quote,
            escape=quote,
            multiLine=multi_line,
            encoding=charset,
            inferSchema=False,
        )
    )
    lines = [
        F.concat(F.lit(f"{name.strip()}: "), strip(F.coalesce(F.col(named(name)), F.lit("")))) for name in rows.columns
    ]
    return rows.select(
        file_path().alias("source"),
        F.monotonically_increasing_id().alias("row"),
        F.concat_ws("\n", *lines).alias("text"),
        _metadata(source=file_path()).alias("metadata"),
    )


def _pieces(spark: SparkSession, paths: str | Sequence[str] | DataFrame, cutter, options: dict[str, str] | None) -> DataFrame:
    """``(file, block, value)`` of files that are cut; small ones of a table are a single split."""

    def by_spark(named: str | Sequence[str]) -> DataFrame:
        return pieces_of(spark, named, cutter, file_path(), options)

    if not isinstance(paths, DataFrame):
        return by_spark(paths)
    return listing.lines(paths, by_spark, cutter.separator)


#: Headers that are sent to every task; beyond that number rows are joined with them by a shuffle.
BROADCAST_HEADERS = 10_000


def _split_csv_docs(spark: SparkSession, paths: Sequence[str] | DataFrame, sep: str, quote: str, options: dict[str, str] | None) -> DataFrame:
    """Rows of CSV files that are read in splits; no name of a file or column comes to the driver."""
    found, splits = records(_pieces(spark, paths, CsvRows(sep, quote), options), CsvRows(sep, quote))
    if splits.where("block = 0 AND names IS NULL AND ends_open").limit(1).count():
        raise LoaderError("a header with line breaks is longer than a split (spark.sql.files.maxPartitionBytes)")
    headers = splits.where("names IS NOT NULL").select("head", "names", "crlf").dropDuplicates(["head"])
    size = headers.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("names")).alias("width")).first()
    if not size.n:
        return spark.createDataFrame([], DOCUMENT_SCHEMA)
    rows = found.where("number > 0").join(F.broadcast(headers) if size.n <= BROADCAST_HEADERS else headers, "head")
    line = F.when(F.endswith("text", F.lit("\r")), F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    line = F.when(F.col("crlf"), F.replace(line, F.lit("\r\n"), F.lit("\n"))).otherwise(line)
    columns = ", ".join(f"c{i} string" for i in range(size.width))
    # the same reading of quotes, blanks and surplus values as of whole files
    parsed = F.from_csv(line, columns, {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true", "maxColumns": str(max(20480, size.width + 1))})
    rows = computed_once(rows.withColumn("values", parsed), ["values"])
    values = F.array(*[F.col(f"values.c{i}") for i in range(size.width)])
    rows = rows.select("file", "number", "names", values.alias("values"))
    lines = F.transform("names", lambda name, i: F.concat(strip(name), F.lit(": "), strip(F.coalesce(F.get("values", i), F.lit("")))))
    return rows.select(
        F.col("file").alias("source"),
        (F.col("number") - 1).alias("row"),
        F.array_join(lines, "\n").alias("text"),
        _metadata(source=F.col("file")).alias("metadata"),
    )


def _json_documents(texts: DataFrame, path: str) -> DataFrame:
    """Documents at ``path`` in JSON texts ``(source, row, content)``.

    ``path`` is JSONPath; one ``[*]`` yields a document per element. Strings are taken as they are, other
    values as compact JSON with their keys in the given order; nulls give no document. A text that is not
    JSON gives a document with NULL text and an ``error``.
    """
    prepare(texts.sparkSession)
    head, star, tail = path.partition("[*]")
    if "[*]" in tail:
        raise ConfigurationError("a JSON path may contain one [*]")
    valid = F.expr(parse_json_strict(stripped("content"))).isNotNull()
    checked = computed_once(texts.withColumn("__valid", valid), ["__valid"])
    if star:
        elements = F.from_json(F.get_json_object("content", head), "array<string>")
        found = checked.select(
            "source", "row", "__valid", F.posexplode_outer(F.when(F.col("__valid"), elements)).alias("__pos", "text")
        )
        if tail:
            found = found.withColumn("text", F.get_json_object("text", f"${tail}"))
    else:
        value = F.when(F.col("__valid"), F.get_json_object("content", path))
        found = checked.withColumn("__pos", F.lit(None).cast("int")).withColumn("text", value)
    return (
        computed_once(found, ["text"])
        .where(~F.col("__valid") | F.col("text").isNotNull())
        .select(
            "source",
            "row",
            "text",
            _metadata(
                source=F.col("source"),
                seq_num=F.col("__pos"),
                error=F.when(~F.col("__valid"), F.lit("invalid JSON")),
            ).alias("metadata"),
        )
    )


def read_json_docs(
    spark: SparkSession,
    paths: str | Sequence[str] | DataFrame,
    path: str = "$",
    lines: bool = False,
    encoding: str = "utf-8",
    split: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Documents at a JSON path of each file, or of each line with ``lines``.

    ``split`` reads large files in many tasks, each of which is one JSON array, without ever holding one as a
    whole (see :mod:`recordloom.sources.cutting`); the path begins with ``$[*]``. An element that is not JSON
    gives a document with NULL text and an ``error``, the others are read. UTF-8 only.
    """
    if split:
        if lines or not path.startswith("$[*]") or spark_encoding(encoding) not in ("UTF-8", "US-ASCII"):
            raise ConfigurationError("JSON arrays are read in splits as UTF-8, with a path that begins with $[*]")
        return _split_json_docs(spark, paths, path.removeprefix("$[*]"), options)
    if not lines:
        texts = _whole_files(spark, paths, encoding, options).withColumn("row", F.lit(0).cast("bigint"))
        return _json_documents(texts, path)
    if spark_encoding(encoding) != "UTF-8":
        raise ConfigurationError("JSON Lines are read as UTF-8")

    def content(named: list[str]) -> DataFrame:
        read = spark.read.options(**(options or {})).text(named)
        return read.select(file_path().alias("file"), F.lit(0).cast("bigint").alias("block"), "value")

    if isinstance(paths, DataFrame):
        rows = listing.lines(paths, content)
    else:
        rows = content([paths] if isinstance(paths, str) else list(paths))
    texts = rows.select(F.col("file").alias("source"), F.monotonically_increasing_id().alias("row"), F.col("value").alias("content"))
    return _json_documents(texts.where(strip(F.col("content")) != ""), path)


def _split_json_docs(spark: SparkSession, paths: str | Sequence[str] | DataFrame, tail: str, options: dict[str, str] | None) -> DataFrame:
    """Documents of the elements of JSON arrays that are read in splits."""
    found, _ = records(_pieces(spark, paths, JsonElements(), options), JsonElements())
    text = F.when(F.col("number") == 0, F.regexp_replace("text", r"^\s*\[", "")).otherwise(F.col("text"))
    text = F.when(F.col("last"), F.regexp_replace(text, r"\]\s*$", "")).otherwise(text)
    elements = found.select(F.col("file").alias("source"), F.col("number").alias("row"), "last", text.alias("content"))
    empty = (F.col("row") == 0) & F.col("last") & (strip(F.col("content")) == "")
    documents = _json_documents(elements.where(~empty).drop("last"), f"${tail}")
    place = F.create_map(F.lit("seq_num"), F.col("row").cast("string"))
    return documents.select("source", F.lit(0).cast("bigint").alias("row"), "text", F.map_concat("metadata", place).alias("metadata"))


def _iso(name: str, data_type: T.DataType) -> Column:
    """A column as metadata text; timestamps in ISO form, with a fraction only if there is one."""
    value = F.col(named(name))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        seconds = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        fraction = F.date_format(value, ".SSSSSS")
        return F.when(fraction == ".000000", seconds).otherwise(F.concat(seconds, fraction))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def rows_to_docs(
    rows: DataFrame,
    source: Column,
    row: Column,
    content_column: str | None = None,
    metadata_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Table rows as documents: one column as text, or the whole row as JSON.

    Metadata has source, row number and the given columns, by default all but the content column.
    Unknown metadata columns are warned of and left out. A NULL content gives a NULL text.
    """
    types = {f.name: f.dataType for f in rows.schema.fields}
    if content_column is not None and content_column not in types:
        raise LoaderError(f"content column '{content_column}' not found; columns: {', '.join(types)}")
    if metadata_columns is None:
        kept = [c for c in types if c != content_column]
    else:
        kept = [c for c in metadata_columns if c in types]
        missing = [c for c in metadata_columns if c not in types]
        if missing:
            warnings.warn(f"metadata columns not found: {missing}", stacklevel=2)
    if content_column is not None:
        text = F.col(named(content_column)).cast("string")
    else:
        text = F.to_json(
            F.struct(*[F.col(named(c)) for c in types]),
            {
                "ignoreNullFields": "false",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS",
            },
        )
    entries = {"source": source, "row": row} | {c: _iso(c, types[c]) for c in kept}
    metadata = F.map_from_arrays(
        F.array(*[F.lit(k) for k in entries]), F.array(*[v.cast("string") for v in entries.values()])
    )
    return rows.select(source.alias("source"), row.alias("row"), text.alias("text"), metadata.alias("metadata"))


def parquet_to_docs(
    spark: SparkSession,
    paths: str | Sequence[str],
    content_column: str | None = None,
    metadata_columns: Sequence[str] | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One document per Parquet row; only the columns asked for are read. See :func:`rows_to_docs`."""
    rows = spark.read.options(**(options or {})).parquet(*([paths] if isinstance(paths, str) else paths))
    return rows_to_docs(rows, file_path(), F.col("_metadata.row_index"), content_column, metadata_columns)
