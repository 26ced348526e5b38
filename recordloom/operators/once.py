"""Keeping expensive columns from being computed more than once.

A filter on a computed column is moved below the projection that computes it, and the column is then
computed for the filter and again for the result, each mention anew. Parsing is too expensive for that.
A generator over the finished columns is a place filters do not move through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.functions.sql import named, quoted


def computed_once(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; later filters on ``columns`` are applied after these are computed."""
    others = [c for c in rows.columns if c not in columns]
    finished = ", ".join(f"{quoted(c)}, {named(c)}" for c in columns)
    return rows.select(*others, F.expr(f"inline(array(named_struct({finished})))"))


def kept_where(rows: DataFrame, condition: str, keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """``keys`` and ``values`` (SQL text by name) of rows where ``condition`` holds, without filtering first."""
    packed = ", ".join(f"{quoted(name)}, {value}" for name, value in values.items())
    return rows.select(*keys, F.expr(f"inline(CASE WHEN {condition} THEN array(named_struct({packed})) END)"))
