"""Checks of custom format definitions, for one file or a folder of any size."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.errors import ConfigurationError
from recordloom.formats import SPARK_TYPES, FormatSpec, custom
from recordloom.functions.json_text import json_kind, opening_kind, parse_json_strict, variant_field
from recordloom.functions.sql import named, quoted
from recordloom.functions.text import stripped
from recordloom.session import prepare

# Kinds of example values that agree with a declared type; null always does.
EXAMPLE_KINDS = {
    "string": ("string", "null"),
    "integer": ("integer", "boolean", "null"),
    "float": ("float", "null"),
    "boolean": ("boolean", "null"),
}


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    """Definition files as ``(file, text)``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
    )


def _finding(severity: str, reason: str) -> str:
    return f"named_struct('severity', '{severity}', 'reason', '{reason}')"


def _field_findings(body: str) -> str:
    """Array of ``(severity, reason)`` for one field definition (a variant), as SQL text."""

    def kind(part: str) -> str:
        return json_kind(variant_field(body, part))

    def text(part: str) -> str:
        return f"CASE WHEN {kind(part)} = 'string' THEN {variant_field(body, part, 'string')} END"

    types = ", ".join(quoted(name) for name in SPARK_TYPES)
    known_type = f"coalesce({text('type')} IN ({types}), false)"
    described = f"coalesce({stripped(text('description'))} <> '', false)"
    agreeing = " ".join(
        f"WHEN '{name}' THEN {kind('example')} IN ({', '.join(quoted(k) for k in kinds)})"
        for name, kinds in EXAMPLE_KINDS.items()
    )
    findings = ", ".join(
        f"CASE WHEN {condition} THEN {_finding(severity, reason)} END"
        for condition, severity, reason in (
            (f"NOT {known_type}", "error", "invalid_type"),
            (f"NOT {described}", "error", "invalid_description"),
            (f"{kind('required')} <> 'boolean'", "error", "invalid_required"),
            (f"NOT (CASE {text('type')} {agreeing} ELSE true END)", "warning", "example_type"),
        )
    )
    return (
        f"CASE WHEN {json_kind(body)} = 'object' THEN filter(array({findings}), f -> f IS NOT NULL) "
        f"ELSE array({_finding('error', 'field_not_an_object')}) END"
    )


def check_format_definitions(definitions: DataFrame) -> DataFrame:
    """Findings ``(file, field, severity, reason)`` for rows of ``(file, text)``.

    ``field`` is NULL for findings about the whole file. A definition without ``error`` rows is usable.
    """
    prepare(definitions.sparkSession)
    whole_file = (
        "CASE WHEN __root IS NULL THEN 'invalid_json' WHEN __kind <> 'object' THEN 'root_not_an_object' "
        f"WHEN coalesce({json_kind('__fields')} <> 'object', true) THEN 'fields_not_an_object' "
        "WHEN size(__map) = 0 THEN 'fields_empty' END"
    )
    parsed = (
        definitions.select("file", F.expr(stripped(named("text"))).alias("__text"))
        .select("*", F.expr(parse_json_strict("__text")).alias("__root"))
        .select(
            "file",
            "__root",
            F.expr(opening_kind("__text")).alias("__kind"),
            F.expr(variant_field("__root", "fields")).alias("__fields"),
            F.expr(variant_field("__root", "fields", "map<string,variant>")).alias("__map"),
        )
        .select("file", "__map", F.expr(whole_file).alias("__finding"))
    )
    # One explode over field entries, or one entry without a field for a finding about the file.
    entries = (
        "CASE WHEN __finding IS NOT NULL THEN array(named_struct('field', cast(NULL as string), 'findings', "
        "array(named_struct('severity', 'error', 'reason', __finding)))) "
        "ELSE transform(map_entries(__map), e -> named_struct('field', e.key, 'findings', "
        f"{_field_findings('e.value')})) END"
    )
    return (
        parsed.select("file", F.expr(f"inline({entries})"))
        .select("file", "field", F.expr("inline(findings)"))
    )


def load_format(
    spark: SparkSession, path: str, constraints: Mapping[str, Callable[[Column], Column]] | None = None
) -> FormatSpec:
    """Format of one definition file; raises with all errors found."""
    try:
        rows = read_definitions(spark, path).limit(2).collect()
    except Exception as error:
        raise ConfigurationError(f"cannot read format definition {path}: {error}") from error
    if len(rows) != 1:
        raise ConfigurationError(f"{path}: expected one definition file, found {len(rows)}")
    findings = check_format_definitions(spark.createDataFrame(rows, "file string, text string"))
    errors = findings.where("severity = 'error'").orderBy("field", "reason").collect()
    if errors:
        listed = ", ".join(f"{e.reason}({e.field})" if e.field is not None else e.reason for e in errors)
        raise ConfigurationError(f"{path}: {listed}")
    stem = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    return custom(json.loads(rows[0].text), stem, constraints)
