"""Uniqueness in arrival order, the cap at N unique records, and the preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.formats import FormatSpec
from recordloom.functions.json_text import indented_json
from recordloom.operators.running import with_totals_before
from recordloom.params import PREVIEW_ROWS
from recordloom.session import new_work_dir, written

ARRIVAL = ("batch_id", "pos")


def dedup_first(
    records: DataFrame, key: Sequence[str] = ("hash",), order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Keep, per key, the record that arrived first.

    ``row_number() = 1`` lets the planner keep one row per key in each map task before the shuffle, so
    a key that holds a third of all rows sends one row per task.
    """
    first = Window.partitionBy(*key).orderBy(*order)
    return records.withColumn("__rank", F.row_number().over(first)).where(F.col("__rank") == 1).drop("__rank")


def unique_per_batch(firsts: DataFrame, group: Sequence[str] = (), batch: str = "batch_id") -> DataFrame:
    """Unique records each batch added: ``(group, batch, new_unique)``."""
    return firsts.groupBy(*group, batch).agg(F.count("*").alias("new_unique"))


def cap_limits(
    firsts: DataFrame,
    n: int | Column,
    group: Sequence[str] = (),
    targets: DataFrame | None = None,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Batches that contribute to the first ``n`` unique records: ``(group, batch, take)``.

    ``take`` is how many of its unique records, in order, the batch contributes. At most ``n`` rows per
    group. ``n`` may be a column of ``targets``, which is joined on ``group``.
    """
    batch = order[0]
    counted = with_totals_before(
        unique_per_batch(firsts, group, batch), batch, {"before": F.col("new_unique")}, group
    )
    if targets is not None:
        counted = counted.join(targets, list(group))
    limit = F.lit(n) if isinstance(n, int) else n
    return counted.where(F.col("before") < limit).select(
        *group, batch, F.least(F.col("new_unique"), limit - F.col("before")).alias("take")
    )


def cap_unique(
    firsts: DataFrame,
    n: int | Column,
    group: Sequence[str] = (),
    targets: DataFrame | None = None,
    order: Sequence[str] = ARRIVAL,
    stored: bool = False,
) -> DataFrame:
    """The first ``n`` unique records in arrival order, per group if one is given.

    Answered through batch counts, so no task holds more than one batch: batches are kept whole up to the one
    where ``n`` is reached. The records are counted before they are cut, so they are written to the working
    folder first unless they are ``stored`` already.
    """
    if not stored:
        firsts = written(firsts, new_work_dir(firsts.sparkSession, "unique"))
    batch_keys = [*group, order[0]]
    limits = cap_limits(firsts, n, group, targets, order)
    in_batch = Window.partitionBy(*batch_keys).orderBy(*order[1:])
    return (
        firsts.join(limits, batch_keys)
        .withColumn("__rank", F.row_number().over(in_batch))
        .where(F.col("__rank") <= F.col("take"))
        .select(*firsts.columns)
    )


def preview(
    records: DataFrame, spec: FormatSpec, rows: int = PREVIEW_ROWS, order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """The first few records in arrival order as indented JSON: ``(*order, preview)``."""
    text = F.expr(indented_json(spec.typed_columns()))
    return records.orderBy(*order).limit(rows).select(*order, text.alias("preview"))
