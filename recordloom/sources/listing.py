"""Folders listed and their files read by tasks.

Spark's readers list a folder on the driver, every scan anew, and give 32 small files to a task. A folder that all
machines see under the same local path is listed here level by level, into a table of files that is written once; the
files of a kind are rows of that table, and tasks open them. The driver sees neither names nor contents. Folders of
other file systems, files in one of Hadoop's compressed forms and large files of lines are left to Spark's readers.
"""

from __future__ import annotations

import itertools
import os
import re
import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.session import new_work_dir, written

# The listing and reading goes to the executors as it is.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries of a folder, and bytes of content, that a task hands over at once.
ENTRIES, CONTENT_BYTES = 10_000, 4 << 20
#: Tasks per core that look at files or read them, and bytes of content for which there is a further task.
TASKS, TASK_BYTES = 4, 64 << 20
#: Files of lines up to this size are read whole by a task; larger ones Spark reads in splits.
SMALL_FILE = 8 << 20

# Fixed value: endings by which Spark's text reader knows compressed files.
PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst|passthrough)$"


def extension_of(path: Column) -> Column:
    """Lower-case extension of a path with its dot, or an empty string."""
    name = F.substring_index(path, "/", -1)
    return F.lower(F.regexp_extract(name, r".(\.[^.]+)$", 1))


def local_folders(spark: SparkSession, paths: str | Sequence[str]) -> list[str] | None:
    """The paths as the local file system names them; None unless all of them are folders there."""
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.getUri().getScheme() != "file" or not fs.exists(hadoop_path) or not fs.getFileStatus(hadoop_path).isDirectory():
            return None
        found.append(fs.makeQualified(hadoop_path).toUri().getPath())
    return found or None


def _is_read(name: str) -> bool:
    """Whether Spark's readers look at a file or folder of that name."""
    hidden = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
    return not hidden or name.startswith(("_metadata", "_common_metadata"))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is in folders, as it comes."""
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            with os.scandir(folder) as found:
                read = (e for e in found if _is_read(e.name))
                while some := list(itertools.islice(read, ENTRIES)):
                    columns = [pa.array([e.path for e in some], pa.string()), pa.array([e.is_dir() for e in some], pa.bool_())]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "folder"])


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = {}
        for path in batch.column("path").to_pylist():
            try:
                sizes[path] = os.stat(path).st_size
            except FileNotFoundError:  # gone, or a link to nothing: Spark's readers pass these over, too
                continue
        columns = [pa.array([f"file://{p}" for p in sizes], pa.string()), pa.array(list(sizes.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["source", "length"])


def list_folders(spark: SparkSession, folders: Sequence[str], recursive: bool = False) -> DataFrame:
    """``(source, extension, length)`` of the files of local folders, written once.

    Without ``recursive``, of the folders within only those that name a value (``key=value``) are gone through.
    """
    base = new_work_dir(spark, "listing")
    tasks = spark.sparkContext.defaultParallelism * TASKS
    here = spark.createDataFrame([(f,) for f in dict.fromkeys(folders)], "path string")
    levels = []
    while True:
        levels.append(f"{base}/level-{len(levels)}")
        found = written(here.mapInArrow(_entries, "path string, folder boolean"), levels[-1])
        within = found.where("folder").select("path")
        if not recursive:
            within = within.where(F.contains(F.substring_index("path", "/", -1), F.lit("=")))
        if within.isEmpty():
            break
        here = within.repartition(tasks, "path")
    everything = spark.read.schema(found.schema).parquet(*levels)
    files = everything.where("NOT folder").select("path").distinct().repartition(tasks, "path")
    files = files.mapInArrow(_lengths, "source string, length bigint")
    return written(files.select("source", extension_of(F.col("source")).alias("extension"), "length"), f"{base}/files")


def listed_folder(spark: SparkSession, paths: str | Sequence[str], options: dict[str, str] | None) -> DataFrame | None:
    """The files of a single folder that a reader was given; None if its files are for Spark's readers."""
    options = options or {}
    if not isinstance(paths, str) or set(options) - {"recursiveFileLookup"}:
        return None
    folders = local_folders(spark, paths)
    return list_folders(spark, folders, options.get("recursiveFileLookup") == "true") if folders else None


def names_of(listed: DataFrame) -> list[str]:
    """Paths of files for one of Spark's readers; what means something in a pattern is escaped."""
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", row.source) for row in listed.select("source").sort("source").toLocalIterator()]


def _opened(rows_of: Callable[[bytes], list[bytes]]):
    """Files to ``(source, value)``: the rows that the content of each gives, a few megabytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, values, size = [], [], 0

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], names=["source", "value"])

        for batch in batches:
            for source in batch.column("source").to_pylist():
                with open(source.removeprefix("file://"), "rb") as file:
                    rows = rows_of(file.read())
                names += [source] * len(rows)
                values += rows
                size += sum(map(len, rows)) + 64 * len(rows)
                if size >= CONTENT_BYTES:
                    yield table()
                    names, values, size = [], [], 0
        if names:
            yield table()

    return run


def _read(listed: DataFrame, n_bytes: int, rows_of: Callable[[bytes], list[bytes]]) -> DataFrame:
    tasks = max(listed.sparkSession.sparkContext.defaultParallelism * TASKS, n_bytes // TASK_BYTES)
    return listed.select("source").repartition(tasks, "source").mapInArrow(_opened(rows_of), "source string, value binary")


def _sums(listed: DataFrame, left: Column) -> tuple[int, bool]:
    """Bytes of the files, and whether some are left to Spark."""
    row = listed.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.coalesce(F.max(left), F.lit(False)).alias("left")).first()
    return row.bytes, row.left


def contents(listed: DataFrame) -> DataFrame:
    """``(source, content)``: all bytes of each file."""
    n_bytes, _ = _sums(listed, F.lit(False))
    return _read(listed, n_bytes, lambda content: [content]).withColumnRenamed("value", "content")


def texts(listed: DataFrame, by_spark: Callable[[list[str]], DataFrame]) -> DataFrame:
    """``(source, content)``: the text of each UTF-8 file. ``by_spark`` does the same for named, compressed files."""
    packed = F.col("source").rlike(PACKED)
    n_bytes, some = _sums(listed, packed)
    plain = _read(listed.where(~packed) if some else listed, n_bytes, lambda content: [content])
    found = plain.select("source", F.col("value").cast("string").alias("content"))
    return found.unionByName(by_spark(names_of(listed.where(packed)))) if some else found


def _cut(separator: str | None) -> Callable[[bytes], list[bytes]]:
    """Lines as Spark's text reader cuts them: nothing stands behind the last separator, and no mark before the first."""
    pattern = re.compile(re.escape(separator.encode()) if separator else rb"\r\n|\r|\n")

    def rows_of(content: bytes) -> list[bytes]:
        rows = pattern.split(content.removeprefix(b"\xef\xbb\xbf"))
        return rows if rows[-1] else rows[:-1]

    return rows_of


def lines(listed: DataFrame, by_spark: Callable[[list[str]], DataFrame], separator: str | None = None) -> DataFrame:
    """``(file, block, value)``: lines of UTF-8 files in order. ``by_spark`` does the same for named files, compressed or large."""
    left = F.col("source").rlike(PACKED) | (F.col("length") > SMALL_FILE)
    n_bytes, some = _sums(listed, left)
    small = _read(listed.where(~left) if some else listed, n_bytes, _cut(separator))
    found = small.select(F.col("source").alias("file"), F.lit(0).cast("bigint").alias("block"), F.col("value").cast("string").alias("value"))
    return found.unionByName(by_spark(names_of(listed.where(left)))) if some else found
