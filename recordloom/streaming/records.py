"""Responses that keep arriving: records appended as they come, each once."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from recordloom.errors import GenerationError
from recordloom.formats import FormatSpec
from recordloom.operators.dedup import cap_unique
from recordloom.operators.validate import valid_records
from recordloom.plans.records import validated_items
from recordloom.session import is_written, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RESPONSE_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("content", T.StringType())])


def read_responses(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RESPONSE_SCHEMA,
    source_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of responses from a folder that files are added to."""
    reader = spark.readStream.format(source_format).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def unique_stream(
    responses: DataFrame,
    spec: FormatSpec,
    bool_as_int: bool = True,
    event_time: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Valid records of a response stream, the first of each hash to arrive.

    The state is one hash per unique record; keep it in RocksDB (``spark.sql.streaming.stateStore.providerClass``
    = :data:`ROCKSDB`) where it may outgrow memory. With an ``event_time`` column and a
    ``watermark`` delay it is kept only that long, and repeats further apart come through again.
    """
    if event_time is not None and watermark is not None:
        records = valid_records(validated_items(responses.withWatermark(event_time, watermark), spec, bool_as_int), spec)
        return records.dropDuplicatesWithinWatermark(["hash"])
    return valid_records(validated_items(responses, spec, bool_as_int), spec).dropDuplicates(["hash"])


def stream_records(
    records: DataFrame, out: str, checkpoint: str, out_format: str = "parquet", once: bool = True
) -> StreamingQuery:
    """Append a record stream to a folder, exactly once. ``once`` stops after what is there now."""
    options = {"ignoreNullFields": "false"} if out_format == "json" else {}
    writer = (
        records.writeStream.format(out_format)
        .options(**options)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_first(
    records: DataFrame, n: int, out: str, checkpoint: str, poll_seconds: float = 0.2, once: bool = True
) -> int:
    """Append records until there are ``n``, then stop the stream; returns how many there are.

    Each micro-batch is written to a folder of its own name, so a repeated micro-batch replaces itself, and adds its
    first records in arrival order up to what is still missing. How many there are is kept in one small row per
    micro-batch beside the state of the query; only the last one is read.
    """
    spark = records.sparkSession
    full = threading.Event()
    counts = f"{checkpoint}/accepted"

    def accepted(before: int | None = None) -> int:
        done = [number for number in _numbers(spark, counts) if before is None or number < before]
        return spark.read.parquet(f"{counts}/{max(done)}").first().records if done else 0

    def append(batch: DataFrame, micro_batch: int) -> None:
        so_far = accepted(micro_batch)
        if so_far >= n:
            # Run through all the same: the state behind the stream is stored with the micro-batch.
            batch.write.format("noop").mode("overwrite").save()
            full.set()
            return
        kept = written(batch, f"{checkpoint}/arrived/{micro_batch}")
        added = written(cap_unique(kept, n - so_far, stored=True), f"{out}/micro_batch={micro_batch}").count()
        written(spark.createDataFrame([(so_far + added,)], "records long"), f"{counts}/{micro_batch}")
        if so_far + added >= n:
            full.set()

    writer = records.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).outputMode("append")
    query = (writer.trigger(availableNow=True) if once else writer).start()
    while not query.awaitTermination(poll_seconds):
        if full.is_set():
            query.stop()
            break
    if query.exception() is not None:
        raise GenerationError(str(query.exception()))
    return accepted()


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the micro-batches whose count was written to the end."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(folder)] if system.exists(folder) else []
    return [int(name) for name in names if name.isdigit() and is_written(spark, f"{path}/{name}")]
