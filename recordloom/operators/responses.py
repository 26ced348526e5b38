"""Model responses: status of a call, deciding call of a batch, JSON parsing, items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.json_text import opening_kind, parse_json_strict
from recordloom.functions.sql import named
from recordloom.functions.text import strip, strip_fences
from recordloom.operators.once import computed_once
from recordloom.session import prepare

# Call status
OK, EMPTY, SAFETY, ERROR = "OK", "EMPTY", "SAFETY", "ERROR"
# Parse status of an OK call
PARSED, PARSE_ERROR, NOT_A_LIST = "PARSED", "PARSE_ERROR", "NOT_A_LIST"
# Outcome of a batch
SUCCEEDED, FAILED = "SUCCEEDED", "FAILED"


def call_status(content: Column, finish_reason: Column, error: Column) -> Column:
    """Status of one call. A safety stop counts only when there is no content."""
    blank = F.coalesce(strip(content) == "", F.lit(True))
    return (
        F.when(error.isNotNull(), F.lit(ERROR))
        .when(blank & F.coalesce(finish_reason == "SAFETY", F.lit(False)), F.lit(SAFETY))
        .when(blank, F.lit(EMPTY))
        .otherwise(F.lit(OK))
    )


def classify_responses(responses: DataFrame) -> DataFrame:
    """Add ``status`` to rows with ``content``, ``finish_reason`` and ``error``."""
    return responses.withColumn("status", call_status(F.col("content"), F.col("finish_reason"), F.col("error")))


def parse_responses(responses: DataFrame, content: str = "content") -> DataFrame:
    """Add ``parse_status`` and ``items`` (array of variants, NULL unless ``PARSED``).

    The fence is removed, the rest must be one whole JSON value; a single object becomes a list of one.
    """
    prepare(responses.sparkSession)
    parsed = (
        responses.select("*", F.expr(strip_fences(named(content))).alias("__text"))
        .select("*", F.expr(parse_json_strict("__text")).alias("__value"))
        .select("*", F.expr(f"CASE WHEN __value IS NOT NULL THEN {opening_kind('__text')} END").alias("__kind"))
    )
    status = (
        f"CASE WHEN __kind IS NULL THEN '{PARSE_ERROR}' WHEN __kind IN ('object', 'array') THEN '{PARSED}' "
        f"ELSE '{NOT_A_LIST}' END"
    )
    items = (
        "CASE __kind WHEN 'object' THEN array(__value) "
        "WHEN 'array' THEN try_variant_get(__value, '$', 'array<variant>') END"
    )
    shaped = parsed.select(*responses.columns, F.expr(status).alias("parse_status"), F.expr(items).alias("items"))
    return computed_once(shaped, ["parse_status", "items"])


def resolve_attempts(calls: DataFrame, max_retries: int, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """One row per batch: the call that decides it.

    ``calls`` has one row per call with ``attempt`` and ``call`` counted from 1. Up to ``max_retries + 1``
    attempts of up to ``max_retries + 1`` calls each are considered. A parsed call decides the batch as
    ``SUCCEEDED``, even with no valid item in it. A safety stop, the last call of an attempt without
    content, and an unparsable response in the last attempt decide it as ``FAILED``. Batches whose calls
    decide nothing yet are left out.

    Only deciding rows enter the window, of which the planner keeps one per task and batch before the
    shuffle, so neither long retry histories nor one batch with many calls gather in one task.
    """
    last = max_retries + 1
    considered = classify_responses(calls.where((F.col("attempt") <= last) & (F.col("call") <= last)))
    parsed = parse_responses(
        considered.withColumn("__ok_content", F.when(F.col("status") == OK, F.col("content"))), "__ok_content"
    )
    status, parse_status = F.col("status"), F.col("parse_status")
    outcome = (
        F.when((status == OK) & (parse_status == PARSED), F.lit(SUCCEEDED))
        .when(status == SAFETY, F.lit(FAILED))
        .when((status != OK) & (F.col("call") == last), F.lit(FAILED))
        .when((status == OK) & (F.col("attempt") == last), F.lit(FAILED))
    )
    first = Window.partitionBy(*keys).orderBy("attempt", "call")
    return (
        parsed.withColumn("outcome", outcome)
        .where(F.col("outcome").isNotNull())
        .withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") == 1)
        .withColumn("parse_status", F.when(status == OK, parse_status))
        .drop("__rank", "__ok_content")
    )


def explode_items(parsed: DataFrame, items: str = "items") -> DataFrame:
    """One row per item, with its position ``pos`` from 0 and the variant ``item``.

    Batches without items (failed, or an empty list) keep one row with NULL ``pos``.
    """
    kept = [c for c in parsed.columns if c not in (items, "content")]
    return parsed.select(*kept, F.posexplode_outer(items).alias("pos", "item"))
