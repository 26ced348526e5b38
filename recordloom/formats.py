"""Record formats: fields, constraints and the words that describe them in prompts."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import types as T

from recordloom.errors import ConfigurationError
from recordloom.functions.sql import named

# Field types of a format and the Spark type each is stored as.
SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
}

# Example value of a field that declares none.
DEFAULT_EXAMPLES: dict[str, Any] = {"string": "sample text", "integer": 123, "float": 1.23, "boolean": True}

NO_EXAMPLE = object()


@dataclass(frozen=True)
class Field:
    """One field of a record."""

    name: str
    type: str
    required: bool = True
    description: str = ""
    example: Any = NO_EXAMPLE

    def __post_init__(self) -> None:
        if self.type not in SPARK_TYPES:
            raise ConfigurationError(f"field '{self.name}': unknown type '{self.type}'")

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.type]

    def example_value(self) -> Any:
        return DEFAULT_EXAMPLES[self.type] if self.example is NO_EXAMPLE else self.example


@dataclass(frozen=True)
class FormatSpec:
    """A flat record format. Field order is the order of output columns."""

    name: str
    description: str
    fields: tuple[Field, ...]
    constraints: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    guidance: str | None = None

    def __post_init__(self) -> None:
        if not self.fields:
            raise ConfigurationError(f"format '{self.name}' has no fields")
        unknown = set(self.constraints) - set(self.field_names)
        if unknown:
            raise ConfigurationError(f"format '{self.name}': constraints on unknown fields {sorted(unknown)}")

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, not f.required) for f in self.fields])

    def example_json(self) -> str:
        """The example list shown in prompts."""
        record = {f.name: f.example_value() for f in self.fields}
        return json.dumps([record], ensure_ascii=False, separators=(",", ":"))

    def typed_columns(self, *parents: str) -> dict[str, tuple[str, str]]:
        """Column (SQL text) and type of each field, in format order; ``parents`` lead to a struct of them."""
        return {f.name: (named(*parents, f.name), f.type) for f in self.fields}


def _strings(*names: str) -> tuple[Field, ...]:
    return tuple(Field(name, "string") for name in names)


# Names, fields and constraints of the built-in formats.
BUILT_IN_FORMATS: dict[str, FormatSpec] = {
    spec.name: spec
    for spec in (
        FormatSpec(
            "pair-class",
            "Two sentences and how the second follows from the first: 0 entailed, 1 undecided, 2 contradicted.",
            (*_strings("premise", "hypothesis"), Field("label", "integer", example=1)),
            {"label": lambda c: c.isin(0, 1, 2)},
            "Use the three labels about equally often and make each decidable from the two sentences alone.",
        ),
        FormatSpec(
            "pair-score",
            "Two sentences and a number from 0.0 (unrelated) to 1.0 (same meaning).",
            (*_strings("sentence1", "sentence2"), Field("score", "float", example=0.5)),
            {"score": lambda c: c.between(0.0, 1.0)},
            "Spread the scores over the whole range and score meaning, not shared words.",
        ),
        FormatSpec(
            "pair",
            "An anchor sentence and a sentence close to it in meaning.",
            _strings("anchor", "positive"),
            {},
            "The second sentence restates or follows from the first without repeating it.",
        ),
        FormatSpec(
            "triplet",
            "An anchor sentence, one close to it in meaning and one that is not.",
            _strings("anchor", "positive", "negative"),
            {},
            "Make the negative plausible by itself and clearly different in meaning from the anchor.",
        ),
        FormatSpec(
            "qa",
            "A passage, a question about it and the answer found in the passage.",
            _strings("context", "question", "answer"),
            {},
            "The passage alone must be enough to answer; keep the answer short and exact.",
        ),
    )
}


def built_in(name: str) -> FormatSpec:
    """The built-in format of that name."""
    try:
        return BUILT_IN_FORMATS[name]
    except KeyError:
        raise ConfigurationError(f"unknown format '{name}'; known: {', '.join(BUILT_IN_FORMATS)}") from None


def custom(
    definition: Mapping[str, Any],
    default_name: str = "custom",
    constraints: Mapping[str, Callable[[Column], Column]] | None = None,
) -> FormatSpec:
    """Format of an already checked definition (see ``operators.definitions``)."""
    name = definition.get("name", default_name)
    return FormatSpec(
        name,
        definition.get("description", f"Records with the structure defined for '{name}'."),
        tuple(
            Field(
                key,
                body["type"],
                body.get("required", True),
                body.get("description", ""),
                body.get("example", NO_EXAMPLE),
            )
            for key, body in definition["fields"].items()
        ),
        constraints or {},
    )
