"""Model calls over prompts that keep arriving: every prompt is answered once, also across restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from recordloom.formats import FormatSpec
from recordloom.operators.dedup import dedup_first
from recordloom.operators.generate import ModelFn, generate
from recordloom.operators.prompts import system_prompt
from recordloom.operators.responses import explode_items, resolve_attempts
from recordloom.operators.validate import valid_records, validate_items
from recordloom.params import RunParams
from recordloom.plans.generation import PROMPTS_PER_TASK
from recordloom.plans.slices import Slices
from recordloom.session import is_written, written, written_once

KEY = "target_id"


def stream_generation(
    prompts: DataFrame,
    spec: FormatSpec,
    model_fn: ModelFn,
    out: str,
    checkpoint: str,
    params: RunParams | None = None,
    concurrency: int | None = None,
    prompts_per_task: int = PROMPTS_PER_TASK,
    once: bool = True,
) -> StreamingQuery:
    """Answer a stream of prompts (``target_id``, ``human`` and what :func:`generate` reads) and append the records.

    A prompt that comes again is not answered again: its key is in the state of the stream. The prompts of a
    micro-batch are written down in slices of bounded size before any is answered, and the calls of a slice when all
    have been made, so a micro-batch that is repeated after a restart calls the model for unfinished slices only.
    Under ``out``: ``calls/<micro-batch>/jobs=<first slice>-<last>`` and ``records/micro_batch=<number>`` (target_id, pos, the fields,
    hash), whose repeated writing changes nothing.
    """
    params = params or RunParams()
    spark = prompts.sparkSession
    answers = Slices(spark, concurrency or spark.sparkContext.defaultParallelism, prompts_per_task)

    def answer(batch: DataFrame, number: int) -> None:
        asked_at = f"{out}/asked/{number}"
        if is_written(spark, asked_at):
            # Run through all the same: the keys seen so far are stored with the micro-batch.
            batch.write.format("noop").mode("overwrite").save()
        else:
            kept = written(batch, f"{out}/arrived/{number}")
            jobs = max(1, -(-kept.count() // answers.per_job))
            written(kept.withColumn("job", F.expr(f"pmod(xxhash64({KEY}), {jobs})")).repartition("job"), asked_at, ["job"])
        # a micro-batch of nothing new leaves no file to read the columns from
        asked = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("job", T.LongType())])).parquet(asked_at)
        parts = answers.answer(
            asked,
            f"{out}/calls/{number}",
            lambda slices, tasks: generate(
                asked.where(slices).drop("job"), model_fn, params.max_retries, params.retry_delay, (KEY,), tasks,
                system=system_prompt(spec), params=params,
            ),
        )
        if not parts:
            return
        decided = resolve_attempts(spark.read.parquet(*parts), params.max_retries, (KEY,))
        items = explode_items(decided.select(KEY, "outcome", "items"))
        valid = valid_records(validate_items(items, spec).drop("item"), spec)
        valid = dedup_first(valid, (KEY, "hash"), ("pos",))
        written(valid.select(KEY, "pos", *[F.col(f"`{n}`") for n in spec.field_names], "hash"), f"{out}/records/micro_batch={number}")

    fresh = prompts.dropDuplicates([KEY])
    writer = fresh.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
