"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from recordloom.errors import ConfigurationError


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the parsing expressions rely on.

    Repeated keys in a JSON object keep the last value instead of failing the whole text.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


#: Bytes of rows that Spark hands to Python at once, unless the session says otherwise.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that carry texts: Spark's own 64 MB stand in the executor and in the worker, for each
    task, some with room to grow, both ways. A session that sets a size keeps it."""
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


_local_root: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is taken only for a local master with that setting unset; it is kept in mind per
    application, as the setting itself cannot be changed while a session runs.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ConfigurationError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_root:
        _local_root[application] = tempfile.mkdtemp(prefix="recordloom-")
    return _local_root[application]


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A path under :func:`work_root` that no other run uses."""
    return f"{work_root(spark)}/recordloom/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table and return it as read back: computed once, with no lineage behind it."""
    frame.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def written_once(make: Callable[[], DataFrame], path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """The table at a path; computed and written unless it is there."""
    spark = SparkSession.active()
    return spark.read.parquet(path) if is_written(spark, path) else written(make(), path, partition_by)
