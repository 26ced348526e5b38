"""Running totals in arrival order that need no single task to see a whole group.

A running total over a long group would send that group to one task. Rows are dealt into ranges of (group, order)
instead, by Spark's own sampling of the keys, whatever their values are: dense numbers, sparse ones or hashes. A
range, which is as large as a shuffle partition, is summed on its own; one narrow row per range and group carries the
totals of the ranges before it; both are added. The ranges are written to the working folder, so that both levels see
the same ones and what is behind the rows is computed once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.sql import named
from recordloom.session import new_work_dir, written


def _in_ranges(rows: DataFrame, order: str, group: Sequence[str], ranges: int | None) -> DataFrame:
    """Rows with the number of their range, which grows with (group, order); rows without an order key are left out."""
    keys = [F.col(named(c)) for c in (*group, order)]
    known = rows.where(keys[-1].isNotNull())
    dealt = known.repartitionByRange(*keys) if ranges is None else known.repartitionByRange(ranges, *keys)
    return written(dealt.withColumn("__range", F.spark_partition_id()), new_work_dir(rows.sparkSession, "ranges"))


def with_totals_before(
    rows: DataFrame,
    order: str,
    totals: Mapping[str, Column],
    group: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add, per name of ``totals``, the sum of its expression over the rows before this one.

    Rows are ordered by the integer column ``order``, unique within ``group``. ``ranges`` is their number, by default
    that of shuffle partitions.
    """
    in_range = Window.partitionBy(*group, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranges_before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    names = list(totals)
    dealt = _in_ranges(rows, order, group, ranges)
    carried = (
        dealt.groupBy(*group, "__range")
        .agg(*[F.sum(totals[n]).alias(f"__sum_{n}") for n in names])
        .select(
            *group,
            "__range",
            *[F.coalesce(F.sum(f"__sum_{n}").over(ranges_before), F.lit(0)).alias(f"__carry_{n}") for n in names],
        )
    )
    local = dealt.select("*", *[F.sum(totals[n]).over(in_range).alias(f"__local_{n}") for n in names])
    return local.join(carried, [*group, "__range"]).select(
        *rows.columns,
        *[(F.col(f"__carry_{n}") + F.coalesce(f"__local_{n}", F.lit(0))).alias(n) for n in names],
    )


def with_run_length(
    rows: DataFrame,
    order: str,
    resets: Column,
    name: str,
    group: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add the number of rows since the last one where ``resets`` holds (0 on such a row).

    Runs go on across ranges: a range hands over its size and the place of its last reset.
    """
    in_range = Window.partitionBy(*group, "__range").orderBy(order)
    ranges_before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    local = (
        _in_ranges(rows, order, group, ranges)
        .withColumn("__place", F.row_number().over(in_range).cast("bigint"))
        .withColumn("__reset_place", F.when(resets, F.col("__place")))
        .withColumn("__last_reset", F.max("__reset_place").over(in_range))
    )
    carried = (
        local.groupBy(*group, "__range")
        .agg(F.count("*").alias("__rows"), F.max("__reset_place").alias("__reset"))
        .withColumn("__start", F.coalesce(F.sum("__rows").over(ranges_before), F.lit(0)))
        .select(
            *group,
            "__range",
            (
                F.col("__start")
                - F.coalesce(F.max(F.col("__start") + F.col("__reset")).over(ranges_before), F.lit(0))
            ).alias("__carry"),
        )
    )
    return local.join(carried, [*group, "__range"]).select(
        *rows.columns,
        F.when(F.col("__last_reset").isNull(), F.col("__place") + F.col("__carry"))
        .otherwise(F.col("__place") - F.col("__last_reset"))
        .alias(name),
    )
