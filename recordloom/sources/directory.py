"""Folders and lists of sources: the reader is chosen by file extension."""

from __future__ import annotations

import fnmatch
import re
import sys
import urllib.parse
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.errors import ConfigurationError, LoaderError
from recordloom.sources.files import (
    DOCUMENT_SCHEMA,
    one_spelling,
    read_csv_docs,
    read_html_docs,
    read_json_docs,
    parquet_to_docs,
    read_text_docs,
)
from recordloom.sources.listing import extension_of, list_folders, local_folders

# The look at Parquet footers goes to the executors as it is.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# File extensions that are read, and how.
EXTENSIONS = {
    ".txt": "text",
    ".md": "cleaned",
    ".rst": "cleaned",
    ".tsv": "cleaned",
    ".xml": "markup",
    ".html": "html",
    ".htm": "html",
    ".csv": "csv",
    ".json": "json",
    ".jsonl": "jsonl",
    ".parquet": "parquet",
}

# Extensions of documents whose text needs a parser library; they are never read as text.
BINARY_EXTENSIONS = (
    ".pdf", ".epub", ".odt", ".rtf", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx",
)

#: Named sources that are sent to every task; beyond that number documents are joined with them by a shuffle.
BROADCAST_PLACES = 10_000

UNSUPPORTED_POLICIES = ("text", "error", "quarantine")

QUARANTINE_SCHEMA = "source string, extension string, length bigint, reason string"


@dataclass(frozen=True)
class ReadOptions:
    """How files of the different kinds are read.

    ``merge_schema`` looks at the columns of every Parquet file, which may differ: files with the same columns
    are read together, each with its own columns only. Without it all files are taken to be one table.
    """

    encoding: str = "utf-8"
    json_path: str = "$"
    merge_schema: bool = True
    csv: dict[str, Any] = field(default_factory=dict)
    parquet: dict[str, Any] = field(default_factory=dict)


def _extension_of_name(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    stem, dot, ending = name.rpartition(".")
    return f".{ending.lower()}" if stem and dot and ending else ""


def _glob_of(extensions: Sequence[str]) -> str:
    """Glob of file names with one of the extensions, in upper or lower case letters."""
    endings = ("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in ext) for ext in extensions)
    return "{" + ",".join(f"*{ending}" for ending in endings) + "}"


def _is_url(path: str) -> bool:
    return urllib.parse.urlparse(path).scheme in ("http", "https")


def _status(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """``(kind, qualified path)`` with kind ``file`` or ``directory``; None if the path does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return None
    status = fs.getFileStatus(hadoop_path)
    return ("directory" if status.isDirectory() else "file"), status.getPath().toUri().toString()


def _read_kind(
    spark: SparkSession, kind: str, paths: str | Sequence[str] | DataFrame, how: ReadOptions, options: dict[str, str]
) -> DataFrame:
    if kind == "text":
        return read_text_docs(spark, paths, how.encoding, options=options)
    if kind == "cleaned":
        return read_text_docs(spark, paths, how.encoding, clean=True, options=options)
    if kind == "markup":
        return read_text_docs(spark, paths, how.encoding, clean=True, markup=True, options=options)
    if kind == "html":
        return read_html_docs(spark, paths, how.encoding, options=options)
    if kind == "csv":
        return read_csv_docs(spark, paths, **{"encoding": how.encoding, **how.csv}, options=options)
    if kind == "parquet":
        return parquet_to_docs(spark, paths, **how.parquet, options=options)
    return read_json_docs(
        spark, paths, how.json_path, lines=kind == "jsonl", encoding=how.encoding if kind == "json" else "utf-8",
        options=options,
    )


def _check_policy(unsupported: str) -> None:
    if unsupported not in UNSUPPORTED_POLICIES:
        raise ConfigurationError(f"unsupported must be one of {UNSUPPORTED_POLICIES}")


def list_files(spark: SparkSession, path: str | Sequence[str], recursive: bool = False, glob: str | None = None) -> DataFrame:
    """``(source, extension, length)`` of the files of a folder; contents are not read."""
    folders = local_folders(spark, path)
    if folders:
        files = list_folders(spark, folders, recursive)
    else:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", str(recursive).lower())
            .load([path] if isinstance(path, str) else list(path))
            .select("path", "length")
            .select(one_spelling(F.col("path")).alias("source"), extension_of(F.col("path")).alias("extension"), "length")
        )
    return files if glob is None else files.where(_matches(F.col("source"), glob))


def _matches(path: Column, glob: str) -> Column:
    """Whether the file name matches a glob."""
    return F.substring_index(path, "/", -1).rlike(f"^{fnmatch.translate(glob)}".replace(r"\Z", "$").replace(r"\z", "$"))


def _union(frames: Sequence[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Columns of Parquet files as text, or why a file cannot be read; only footers are looked at."""
    import pyarrow.fs
    import pyarrow.parquet

    for batch in batches:
        columns, errors = [], []
        for path in batch["source"]:
            found = error = None
            try:
                if path.startswith("file:"):
                    system, place = pyarrow.fs.LocalFileSystem(), path.removeprefix("file://")
                else:
                    system, place = pyarrow.fs.FileSystem.from_uri(urllib.parse.quote(path, safe=":/@%"))
            except Exception:  # a file system only Spark knows: nothing can be told
                found = ""
            if found is None:
                try:
                    with system.open_input_file(place) as file:
                        found = pyarrow.parquet.read_schema(file).remove_metadata().to_string()
                except Exception as problem:
                    error = f"{type(problem).__name__}: {problem}".split("\n")[0]
            columns.append(found)
            errors.append(error)
        yield pd.DataFrame({"source": batch["source"], "columns": columns, "error": errors})


def _read_tables(
    spark: SparkSession, listed: DataFrame, how: ReadOptions
) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    """Documents of the listed Parquet files, one scan per set of columns, and the files that cannot be read.

    Footers are read by a distributed job. File names come back, as they do to any reader of a folder.
    """
    sources = listed.select("source").distinct()
    probed = sources.repartition(spark.sparkContext.defaultParallelism).mapInPandas(_footers, "source string, columns string, error string")
    groups: dict[str, list[str]] = {}
    errors: list[tuple[str, str]] = []
    for row in probed.toLocalIterator():
        if row.error is not None:
            errors.append((row.source, row.error))
        else:
            groups.setdefault(row["columns"] if how.merge_schema else "", []).append(row.source)
    frames = []
    for paths in (sorted(p) for p in groups.values()):
        try:
            frames.append(_read_kind(spark, "parquet", paths, how, {}))
        except Exception as problem:  # a content column that is not there, say
            errors += [(path, str(problem).split("\n")[0]) for path in paths]
    return frames, errors


def read_documents(
    spark: SparkSession,
    path: str,
    recursive: bool = False,
    glob: str | None = None,
    unsupported: str = "quarantine",
    how: ReadOptions | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Documents of a file or folder, and the quarantine of files that were not read.

    The folder is listed once; each kind of file is read by one scan (Parquet: one per set of columns). ``unsupported`` says
    what becomes of other files: read as ``text`` (parser formats excepted), ``error``, or ``quarantine``, whose
    rows are ``(source, extension, length, reason)``; Parquet files that cannot be read are there too.
    """
    _check_policy(unsupported)
    how = how or ReadOptions()
    if _is_url(path):
        raise ConfigurationError("fetching pages is not supported; give crawled pages to pages_to_docs")
    status = _status(spark, path)
    if status is None:
        raise ConfigurationError(f"path not found: {path}")
    if status[0] == "file":
        return _read_files(spark, {_extension_of_name(path): [path]}, unsupported, how)
    documents, listed, labels, errors = _read_folders(spark, [path], recursive, glob, unsupported, how)
    others = listed.where(~F.col("extension").isin(*EXTENSIONS))
    quarantined = others
    if "other" in labels and unsupported == "error":
        raise LoaderError(f"unsupported file format: {others.head().source}")
    if "other" in labels and unsupported == "text":
        quarantined = others.where(F.col("extension").isin(*BINARY_EXTENSIONS))
    quarantined = quarantined.withColumn("reason", F.lit("unsupported_format"))
    if errors:
        unread = spark.createDataFrame(errors, "source string, reason string")
        quarantined = quarantined.unionByName(listed.join(unread, "source").select(quarantined.columns))
    return documents, quarantined


def _read_folders(
    spark: SparkSession, paths: Sequence[str], recursive: bool, glob: str | None, unsupported: str, how: ReadOptions
) -> tuple[DataFrame, DataFrame, set[str], list[tuple[str, str]]]:
    """Documents of folders, their files, the extensions found, and the files that cannot be read.

    Local folders are listed once, by tasks; scans of others list them again for each kind.
    """
    listed = list_files(spark, paths, recursive, glob)
    by_tasks = local_folders(spark, paths) is not None
    # At most one row per known extension comes back, plus one for all others.
    label = F.when(F.col("extension").isin(*EXTENSIONS), F.col("extension")).otherwise(F.lit("other"))
    labels = {r.label for r in listed.select(label.alias("label")).distinct().collect()}
    folder = {"recursiveFileLookup": str(recursive).lower()}
    kinds: dict[str, list[str]] = {}
    for ext, kind in EXTENSIONS.items():
        if ext in labels:
            kinds.setdefault(kind, []).append(ext)
    frames: list[DataFrame] = []
    errors: list[tuple[str, str]] = []
    for kind, extensions in kinds.items():
        if kind == "parquet":
            tables, errors = _read_tables(spark, listed.where(F.col("extension").isin(*extensions)), how)
            frames += tables
        elif by_tasks:
            frames.append(_read_kind(spark, kind, listed.where(F.col("extension").isin(*extensions)), how, {}))
        else:
            frames.append(_read_kind(spark, kind, paths, how, {**folder, "pathGlobFilter": _glob_of(extensions)}))
    if "other" in labels and unsupported == "text" and by_tasks:
        others = listed.where(~F.col("extension").isin(*EXTENSIONS, *BINARY_EXTENSIONS))
        frames.append(read_text_docs(spark, others, how.encoding))
    elif "other" in labels and unsupported == "text":
        ending = extension_of(F.col("source"))
        everything = read_text_docs(spark, paths, how.encoding, options=folder)
        frames.append(everything.where(~ending.isin(*EXTENSIONS, *BINARY_EXTENSIONS)))
    documents = _union(frames, spark, DOCUMENT_SCHEMA)
    return (documents if glob is None else documents.where(_matches(F.col("source"), glob))), listed, labels, errors


def _read_files(
    spark: SparkSession, by_extension: dict[str, list[str]], unsupported: str, how: ReadOptions
) -> tuple[DataFrame, DataFrame]:
    """Documents and quarantine of single files, one scan per extension."""
    frames, left_out = [], []
    for ext, paths in by_extension.items():
        kind = EXTENSIONS.get(ext)
        if kind is None and unsupported == "text" and ext not in BINARY_EXTENSIONS:
            kind = "text"
        if kind is not None:
            frames.append(_read_kind(spark, kind, paths, how, {}))
        elif unsupported == "error":
            raise LoaderError(f"unsupported file format: {paths[0]}")
        else:
            left_out += paths
    quarantine = spark.createDataFrame([], QUARANTINE_SCHEMA)
    if left_out:
        quarantine = list_files(spark, left_out).withColumn("reason", F.lit("unsupported_format"))
    return _union(frames, spark, DOCUMENT_SCHEMA), quarantine


def _folders_above(path: Column, recursive: bool) -> Column:
    """A path and the folders it may have been read through: the one it is in, or all above it."""
    parts = F.split(path, "/")
    shortest = F.lit(1) if recursive else F.size(parts) - 1
    return F.transform(F.sequence(shortest, F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def _covered(path: str, folders: set[str], recursive: bool) -> bool:
    """Whether a path lies in one of the folders that are read anyway."""
    above = path.rsplit("/", 1)[0]
    while above:
        if above in folders:
            return True
        above = above.rpartition("/")[0] if recursive else ""
    return False


def read_many(
    spark: SparkSession,
    sources: Sequence[str],
    recursive: bool = False,
    unsupported: str = "quarantine",
    how: ReadOptions | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Documents of several files and folders with their ``source_pos``, and ``(source_pos, source, error)``.

    A source that cannot be read contributes no documents and stops nothing; a file of a folder that cannot be read
    is named in the errors by its path. All folders share the scans of their kinds, and so do all files of a kind;
    the number of plans depends on kinds, headers and sets of columns, not on the number of sources.
    """
    _check_policy(unsupported)
    how = how or ReadOptions()
    errors: list[tuple[int, str, str]] = []
    places: list[tuple[int, str]] = []
    folders: dict[str, str] = {}
    files: dict[str, dict[str, str]] = {}

    def look(source: str) -> tuple[str, str] | None:
        if _is_url(source):
            raise ConfigurationError("fetching pages is not supported")
        return _status(spark, source)

    with ThreadPoolExecutor(min(32, len(sources) or 1)) as pool:  # one look at each source the caller names
        looks = [pool.submit(look, source) for source in sources]
    for position, (source, seen) in enumerate(zip(sources, looks, strict=True)):
        problem = seen.exception()
        if problem is not None or seen.result() is None:
            errors.append((position, source, str(problem or "path not found").split("\n")[0]))
            continue
        kind, uri = seen.result()
        uri = re.sub("^file:/+", "file:///", urllib.parse.unquote(uri)).rstrip("/")
        ext = _extension_of_name(source)
        if kind == "directory":
            folders[uri] = source
        elif ext not in EXTENSIONS and (unsupported != "text" or ext in BINARY_EXTENSIONS):
            errors.append((position, source, "unsupported file format"))
            continue
        else:
            files.setdefault(ext, {})[uri] = source
        places.append((position, uri))

    frames: list[DataFrame] = []
    unread: list[tuple[str, str]] = []
    outer = {u: s for u, s in folders.items() if not (recursive and _covered(u, set(folders), True))}
    if outer:
        documents, _, _, unread = _read_folders(spark, list(outer.values()), recursive, None, unsupported, how)
        frames.append(documents)
    for ext, named in files.items():
        paths = sorted(s for u, s in named.items() if not _covered(u, set(outer), recursive))
        if not paths:
            continue
        if EXTENSIONS.get(ext) == "parquet":
            tables, bad = _read_tables(spark, list_files(spark, paths), how)
            frames += tables
            unread += bad
            continue
        own = replace(how, csv={"mixed_headers": True, **how.csv}) if ext == ".csv" else how
        frames.append(_read_files(spark, {ext: paths}, unsupported, own)[0])
    documents = _union(frames, spark, DOCUMENT_SCHEMA)
    # The caller's own list of paths: as small as the argument. One folder may hold all documents, which a shuffle by
    # its name would put into one task.
    place = spark.createDataFrame(places, "source_pos int, __uri string")
    if len(places) <= BROADCAST_PLACES:
        place = F.broadcast(place)
    reached = documents.withColumn("__uri", F.explode(_folders_above(F.col("source"), recursive)))
    position_of = {uri: position for position, uri in reversed(places)}
    for path, reason in unread:
        above = [u for u in (path, *_parents(path, recursive)) if u in position_of]
        errors.append((position_of[above[0]] if above else -1, path, reason))
    failures = spark.createDataFrame(sorted(errors), "source_pos int, source string, error string")
    return reached.join(place, "__uri").drop("__uri"), failures


def _parents(path: str, recursive: bool) -> list[str]:
    """The folders a path may have been read through, nearest first."""
    parts = path.split("/")
    return ["/".join(parts[:n]) for n in range(len(parts) - 1, 0 if recursive else len(parts) - 2, -1)]
