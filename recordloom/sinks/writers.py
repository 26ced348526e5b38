"""JSON Lines, CSV and Parquet output, and conversion of JSON Lines.

An output is a folder of part files, written in parallel.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.errors import ConfigurationError
from recordloom.formats import FormatSpec
from recordloom.functions.json_text import opening_kind, parse_json_strict, variant_field
from recordloom.functions.sql import named
from recordloom.functions.text import strip
from recordloom.operators.once import computed_once
from recordloom.session import new_work_dir, prepare, written

# Names of output formats; ``all`` stands for every one of them.
OUTPUT_FORMATS = ("jsonl", "csv", "parquet")

# Options under which values come back as they were written.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _arranged(records: DataFrame, order: Sequence[str], files: int | None) -> DataFrame:
    """Records in arrival order over the part files, with the order columns left in place."""
    if order:
        records = records.orderBy(*order)
    return records if files is None else records.coalesce(files)


def _columns(records: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    return records if fields is None else records.select(*[F.col(named(f)) for f in fields])


def write_jsonl(
    records: DataFrame,
    path: str,
    fields: Sequence[str] | None = None,
    order: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """One JSON object per line, nulls written out, non-ASCII kept."""
    _columns(_arranged(records, order, files), fields).write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(path)


def write_csv(
    records: DataFrame,
    path: str,
    fields: Sequence[str] | None = None,
    order: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Header and rows in field order; other columns ignored, nulls empty, quotes doubled."""
    if fields is not None:
        known = set(records.columns)
        records = records.withColumns({f: F.lit(None).cast("string") for f in fields if f not in known})
    _columns(_arranged(records, order, files), fields).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_parquet(
    records: DataFrame,
    path: str,
    fields: Sequence[str] | None = None,
    order: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Parquet with the declared types."""
    _columns(_arranged(records, order, files), fields).write.mode("overwrite").parquet(path)


WRITERS: dict[str, Callable[..., None]] = {"jsonl": write_jsonl, "csv": write_csv, "parquet": write_parquet}


def selected_formats(formats: Iterable[str]) -> list[str]:
    """Formats without repeats, ``all`` expanded, in the order of ``OUTPUT_FORMATS``."""
    wanted = set(formats)
    unknown = wanted - {*OUTPUT_FORMATS, "all"}
    if unknown:
        raise ConfigurationError(f"unknown output formats: {sorted(unknown)}")
    return [f for f in OUTPUT_FORMATS if f in wanted or "all" in wanted]


def save(
    records: DataFrame,
    base: str,
    formats: Iterable[str],
    fields: Sequence[str] | None = None,
    order: Sequence[str] = (),
    files: int | None = None,
) -> dict[str, str]:
    """Write ``{base}.{format}`` for each format; returns the paths written.

    The records are computed once: for several formats they are written as a table in the shared working folder
    first, and every format is written from there. Nothing is written for no records or no formats. ``fields`` is
    the header; without it all columns are written.
    """
    chosen = selected_formats(formats)
    if not chosen:
        warnings.warn("no output format given, nothing saved", stacklevel=2)
        return {}
    kept = written(records, new_work_dir(records.sparkSession, "saved")) if len(chosen) > 1 else records
    if kept.isEmpty():
        warnings.warn("no records, nothing saved", stacklevel=2)
        return {}
    paths = {f: f"{base}.{f}" for f in chosen}
    for name, path in paths.items():
        WRITERS[name](kept, path, fields, order, files)
    return paths


def _jsonl_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, __value)``, the value NULL unless the line is one JSON object."""
    prepare(spark)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    parsed = lines.withColumn("__text", strip(F.col("line")))
    value = f"CASE WHEN {opening_kind('__text')} = 'object' THEN {parse_json_strict('__text')} END"
    parsed = parsed.withColumn("__value", F.expr(value))
    return computed_once(parsed.drop("__text"), ["__value"])


def read_jsonl(spark: SparkSession, path: str, spec: FormatSpec) -> DataFrame:
    """Records of a JSON Lines output; lines that are not JSON objects are skipped. A missing path raises."""
    return _jsonl_lines(spark, path).where(F.col("__value").isNotNull()).select(
        *[
            F.expr(variant_field("__value", f.name, f.spark_type.simpleString())).alias(f.name)
            for f in spec.fields
        ]
    )


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines :func:`read_jsonl` skips: ``(file, line)``."""
    return _jsonl_lines(spark, path).where(F.col("__value").isNull()).select("file", "line")


def convert_jsonl(
    spark: SparkSession,
    path: str,
    spec: FormatSpec,
    base: str,
    formats: Iterable[str],
    expected: int | None = None,
) -> DataFrame:
    """Write a JSON Lines output in other formats; one row ``(loaded, expected, matches)``.

    A count other than ``expected`` is warned of, not an error.
    """
    records = written(read_jsonl(spark, path, spec), new_work_dir(spark, "converted"))  # parsed once
    save(records, base, [f for f in selected_formats(formats) if f != "jsonl"], spec.field_names)
    wanted = F.lit(expected).cast("bigint")
    report = records.agg(F.count("*").alias("loaded")).select(
        "loaded", wanted.alias("expected"), F.coalesce(F.col("loaded") == wanted, F.lit(True)).alias("matches")
    )
    if expected is not None and not report.head().matches:
        warnings.warn(f"{path}: count differs from the {expected} records expected", stacklevel=2)
    return report
