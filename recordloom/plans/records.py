"""From stored responses to unique records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from recordloom.formats import FormatSpec
from recordloom.operators.batches import batch_summary
from recordloom.operators.dedup import cap_unique, dedup_first
from recordloom.operators.responses import explode_items, parse_responses
from recordloom.operators.validate import item_outcomes, valid_records, validate_items
from recordloom.session import new_work_dir, written


def validated_items(responses: DataFrame, spec: FormatSpec, bool_as_int: bool = True) -> DataFrame:
    """Responses (``batch_id, content``) parsed, exploded and checked; one row per item."""
    return validate_items(explode_items(parse_responses(responses)), spec, bool_as_int)


@dataclass(frozen=True)
class Records:
    """Results over one set of responses; lazy, but for :meth:`summary`."""

    spec: FormatSpec
    validated: DataFrame
    valid: DataFrame
    unique: DataFrame
    group: tuple[str, ...] = ()

    def first(self, n: int | Column, targets: DataFrame | None = None) -> DataFrame:
        """The first ``n`` unique records in arrival order, per group."""
        return cap_unique(self.unique, n, self.group, targets)

    def summary(self, n: int | None = None) -> DataFrame:
        """Counts per batch, up to the ``n``-th unique record.

        Responses are parsed once: a hash and a flag per item are written to the working folder, and
        everything is counted from there.
        """
        path = new_work_dir(self.validated.sparkSession, "outcomes")
        return batch_summary(written(item_outcomes(self.validated, self.spec), path), n, self.group)


def records_from_responses(
    responses: DataFrame, spec: FormatSpec, bool_as_int: bool = True, group: Sequence[str] = ()
) -> Records:
    """Parse, check and deduplicate responses. Uniqueness holds within ``group`` (such as a target)."""
    validated = validated_items(responses, spec, bool_as_int)
    valid = valid_records(validated, spec)
    return Records(spec, validated, valid, dedup_first(valid, [*group, "hash"]), tuple(group))
