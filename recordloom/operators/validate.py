"""Strict checks of items against a format."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.formats import Field, FormatSpec
from recordloom.functions.json_text import item_hash, variant_field
from recordloom.functions.sql import named, quoted
from recordloom.functions.text import stripped
from recordloom.operators.once import kept_where

# Test of the shape (``schema_of_variant``) of a value, by field type.
SHAPE_TESTS = {
    "string": "{0} = 'STRING'",
    "integer": "{0} = 'BIGINT'",
    "float": "({0} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({0}, 'DECIMAL'))",
    "boolean": "{0} = 'BOOLEAN'",
}


def _takes_booleans(field: Field, bool_as_int: bool) -> bool:
    return bool_as_int and field.type in ("integer", "float")


def _fits(i: int, field: Field, bool_as_int: bool) -> str:
    """Whether a value that is there has a shape the field takes."""
    test = SHAPE_TESTS[field.type].format(f"__shape_{i}")
    return f"({test} OR __shape_{i} = 'BOOLEAN')" if _takes_booleans(field, bool_as_int) else test


def _typed(i: int, field: Field, bool_as_int: bool) -> str:
    """Value of the field, NULL unless its shape fits."""
    target = field.spark_type.simpleString()
    test = SHAPE_TESTS[field.type].format(f"__shape_{i}")
    value = f"CASE WHEN {test} THEN try_variant_get(__raw_{i}, '$', {quoted(target)})"
    if _takes_booleans(field, bool_as_int):
        value += f" WHEN __shape_{i} = 'BOOLEAN' THEN cast(try_variant_get(__raw_{i}, '$', 'boolean') as {target})"
    return f"{value} END"


def _reason(i: int, field: Field, spec: FormatSpec, bool_as_int: bool) -> str:
    if field.required:
        missing = f"WHEN __shape_{i} IS NULL THEN {quoted(f'missing:{field.name}')}"
    else:
        missing = f"WHEN __shape_{i} IS NULL OR __shape_{i} = 'VOID' THEN NULL"
    wrong = f"WHEN NOT {_fits(i, field, bool_as_int)} THEN {quoted(f'wrong_type:{field.name}')}"
    constraint = ""
    if field.name in spec.constraints:
        constraint = f"WHEN NOT __holds_{i} THEN {quoted(f'constraint:{field.name}')}"
    return f"CASE {missing} {wrong} {constraint} END"


def _listed(texts: Iterable[str]) -> str:
    """Array of the texts that are not NULL."""
    parts = ", ".join(texts)
    return f"filter(array({parts}), t -> t IS NOT NULL)" if parts else "cast(array() as array<string>)"


def validate_items(items: DataFrame, spec: FormatSpec, bool_as_int: bool = True, item: str = "item") -> DataFrame:
    """Add ``valid``, ``record`` (struct in format order), ``reasons`` and ``warnings``.

    An item is valid when there are no reasons against it. Required fields must be there and have the
    declared type; an integer is taken, and stored as a float, where a float is declared; nothing else is
    converted. With ``bool_as_int`` a JSON boolean passes as 1 or 0 in number fields. Optional fields may
    be missing or null. Extra keys are dropped with a warning, blank required strings only warned of. Rows
    with NULL ``pos`` (batches without items) get NULL in all four columns.
    """
    value = named(item)
    fields = list(enumerate(spec.fields))
    known = ", ".join(quoted(name) for name in spec.field_names)
    keys = f"map_keys(try_variant_get({value}, '$', 'map<string,variant>'))"
    raw = items.select(
        "*",
        *[F.expr(variant_field(value, f.name)).alias(f"__raw_{i}") for i, f in fields],
        F.expr(f"array_sort(array_except({keys}, array({known})))").alias("__extra"),
    )
    # Only an object has fields; the shape of the whole item is looked at if none was found.
    some_field = " OR ".join(f"__raw_{i} IS NOT NULL" for i, _ in fields)
    is_object = f"({some_field} OR coalesce(startswith(schema_of_variant({value}), 'OBJECT'), false))"
    shaped = raw.select(
        "*",
        F.expr(f"pos IS NOT NULL AND {is_object}").alias("__is_object"),
        *[F.expr(f"schema_of_variant(__raw_{i})").alias(f"__shape_{i}") for i, _ in fields],
    )
    typed = shaped.select("*", *[F.expr(_typed(i, f, bool_as_int)).alias(f"__value_{i}") for i, f in fields])
    constrained = [(i, f) for i, f in fields if f.name in spec.constraints]
    if constrained:
        typed = typed.select(
            "*",
            *[
                F.coalesce(spec.constraints[f.name](F.col(f"__value_{i}")), F.lit(False)).alias(f"__holds_{i}")
                for i, f in constrained
            ],
        )
    judged = typed.select(
        "*", *[F.expr(_reason(i, f, spec, bool_as_int)).alias(f"__reason_{i}") for i, f in fields]
    )
    sound = " AND ".join(f"__reason_{i} IS NULL" for i, _ in fields)
    record = ", ".join(f"{quoted(f.name)}, __value_{i}" for i, f in fields)
    reasons = _listed(f"__reason_{i}" for i, _ in fields)
    blanks = _listed(
        f"CASE WHEN {stripped(f'__value_{i}')} = '' THEN {quoted(f'blank:{f.name}')} END"
        for i, f in fields
        if f.type == "string" and f.required
    )
    extra = "transform(__extra, key -> concat('extra:', key))"
    return judged.selectExpr(
        *[named(c) for c in items.columns],
        f"CASE WHEN pos IS NOT NULL THEN __is_object AND {sound} END AS valid",
        f"CASE WHEN __is_object THEN named_struct({record}) END AS record",
        f"CASE WHEN __is_object THEN {reasons} WHEN pos IS NOT NULL THEN array('not_an_object') END AS reasons",
        f"CASE WHEN __is_object THEN concat({blanks}, {extra}) "
        "WHEN pos IS NOT NULL THEN cast(array() as array<string>) END AS warnings",
    )


def _keys(validated: DataFrame) -> list[str]:
    return [c for c in validated.columns if c not in ("item", "valid", "record", "reasons", "warnings")]


def valid_records(validated: DataFrame, spec: FormatSpec) -> DataFrame:
    """Valid items only: their keys, the fields of the format as columns, and ``hash``."""
    fields = {name: named("record", name) for name in spec.field_names}
    records = kept_where(validated, "valid", _keys(validated), fields)
    return records.select("*", F.expr(item_hash(spec.typed_columns())).alias("hash"))


def item_outcomes(validated: DataFrame, spec: FormatSpec) -> DataFrame:
    """What became of each item, narrow: its keys, ``valid`` (NULL for a batch without items), ``hash``."""
    content = item_hash(spec.typed_columns("record"))
    return validated.select(*_keys(validated), "valid", F.expr(f"CASE WHEN valid THEN {content} END").alias("hash"))


def rejects(validated: DataFrame) -> DataFrame:
    """Rejected items with their text and reasons."""
    return kept_where(validated, "NOT valid", _keys(validated), {"raw": "to_json(item)", "reasons": "reasons"})


def warn_items(validated: DataFrame) -> DataFrame:
    """Valid items that carry warnings, one row per warning."""
    return validated.select(*_keys(validated), F.expr("explode(CASE WHEN valid THEN warnings END)").alias("warning"))
