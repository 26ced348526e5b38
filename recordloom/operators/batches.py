"""Batch level results: counts, runs of failures, item offsets, run totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.dedup import dedup_first, unique_per_batch
from recordloom.operators.running import with_run_length, with_totals_before
from recordloom.params import failure_limit


def batch_validity(outcomes: DataFrame, group: Sequence[str] = (), batch: str = "batch_id") -> DataFrame:
    """Valid and skipped items per batch; a batch without items counts 0 for both."""
    return outcomes.groupBy(*group, batch).agg(
        F.count_if(F.col("valid")).alias("valid"), F.count_if(~F.col("valid")).alias("skipped")
    )


def batch_summary(
    outcomes: DataFrame, n: int | None = None, group: Sequence[str] = (), batch: str = "batch_id"
) -> DataFrame:
    """Per batch: ``valid``, ``skipped``, ``new_unique``, ``duplicates``, ``stagnant``.

    ``outcomes`` is an ``item_outcomes`` table; it is read more than once, so store it first. With a
    target of ``n`` unique records the run ends inside the batch that reaches it: later batches are left
    out, and duplicates behind the last record taken are not counted.
    """
    keys = [*group, batch]
    valid = outcomes.where("valid")
    firsts = dedup_first(valid, [*group, "hash"], (batch, "pos"))
    summary = (
        batch_validity(outcomes, group, batch)
        .join(unique_per_batch(firsts, group, batch), keys, "left")
        .withColumn("new_unique", F.coalesce("new_unique", F.lit(0).cast("bigint")))
        .withColumn("duplicates", F.col("valid") - F.col("new_unique"))
    )
    if n is not None:
        summary = _up_to_target(summary, firsts, valid, n, group, batch)
    return summary.withColumn("stagnant", (F.col("valid") > 0) & (F.col("new_unique") == 0))


def _up_to_target(
    summary: DataFrame, firsts: DataFrame, valid: DataFrame, n: int, group: Sequence[str], batch: str
) -> DataFrame:
    """Cut the summary where the ``n``-th unique record was taken.

    Only the one batch per group in which that happens is looked at item by item.
    """
    keys = [*group, batch]
    counted = with_totals_before(summary, batch, {"before": F.col("new_unique")}, group).where(F.col("before") < n)
    take = F.least(F.col("new_unique"), F.lit(n) - F.col("before"))
    reaching = counted.where(F.col("before") + F.col("new_unique") >= n).select(*keys, take.alias("take"))
    # Positions of the unique records in those batches, as a sorted list: bounded by one batch.
    cut = (
        firsts.join(reaching, keys)
        .groupBy(*keys, "take")
        .agg(F.array_sort(F.collect_list("pos")).alias("places"))
        .select(*keys, F.expr("places[cast(take - 1 as int)]").alias("cut"))
    )
    valid_to_cut = (
        valid.join(cut, keys).where(F.col("pos") <= F.col("cut")).groupBy(*keys).agg(F.count("*").alias("valid_to_cut"))
    )
    return (
        counted.withColumn("take", take)
        .join(valid_to_cut, keys, "left")
        .withColumn("duplicates", F.coalesce("valid_to_cut", "valid") - F.col("take"))
        .withColumn("new_unique", F.col("take"))
        .drop("before", "take", "valid_to_cut")
    )


def stagnant_batches(summary: DataFrame) -> DataFrame:
    """Batches with valid items of which none was new."""
    return summary.where("stagnant").drop("stagnant")


def batch_offsets(summary: DataFrame, group: Sequence[str] = (), batch: str = "batch_id") -> DataFrame:
    """Add ``item_offset``: unique records before the batch. Item number = ``item_offset + pos``."""
    return with_totals_before(summary, batch, {"item_offset": F.col("new_unique")}, group)


def consecutive_failures(
    batches: DataFrame, group: Sequence[str] = (), batch: str = "batch_id", ranges: int | None = None
) -> DataFrame:
    """Add ``consecutive_failures``: length of the run of batches without a valid item ending here."""
    return with_run_length(batches, batch, F.col("valid") > 0, "consecutive_failures", group, ranges)


def failure_cutoff(
    batches: DataFrame,
    max_retries: int,
    group: Sequence[str] = (),
    batch: str = "batch_id",
    ranges: int | None = None,
) -> DataFrame:
    """First batch of each group at which too many in a row have failed: ``(group, stop_batch)``.

    Groups that never stop are left out; without groups there is at most one row.
    """
    limit = failure_limit(max_retries)
    stops = consecutive_failures(batches, group, batch, ranges).where(F.col("consecutive_failures") >= limit)
    if group:
        return stops.groupBy(*group).agg(F.min(batch).alias("stop_batch"))
    return stops.agg(F.min(batch).alias("stop_batch")).where(F.col("stop_batch").isNotNull())


def run_summary(summary: DataFrame) -> DataFrame:
    """One row of totals over a :func:`batch_summary`. A batch fails when it has no valid item."""
    return summary.agg(
        F.coalesce(F.sum("new_unique"), F.lit(0)).cast("bigint").alias("unique_records"),
        F.count_if(F.col("valid") > 0).alias("successful_batches"),
        F.count_if(F.col("valid") == 0).alias("failed_batches"),
    )
