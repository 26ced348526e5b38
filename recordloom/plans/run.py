"""A whole run: records from a query or from documents, saved under a name, with a preview."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.formats import FormatSpec
from recordloom.functions.text import output_name
from recordloom.operators.dedup import preview
from recordloom.operators.generate import ModelFn
from recordloom.params import RunParams
from recordloom.plans.generation import GenerationResult, generate_from_documents, generate_from_query
from recordloom.sinks.writers import save

ARRIVAL = ("target_id", "batch_id", "pos")


@dataclass(frozen=True)
class RunOutput:
    """``result`` of the generation, ``paths`` by format, and a ``preview`` of the first records."""

    result: GenerationResult
    paths: dict[str, str]
    preview: DataFrame


def run_and_save(
    spark: SparkSession,
    spec: FormatSpec,
    model_fn: ModelFn,
    folder: str,
    params: RunParams | None = None,
    query: str | None = None,
    documents: DataFrame | None = None,
    files: int | None = None,
    **run,
) -> RunOutput:
    """Generate ``params.samples`` records, save them in ``params.formats`` under ``folder``, and show some.

    Give either ``query`` or ``documents``. The name is made of ``params.prefix``, the format and the kind of run.
    ``params`` also reach a model function that takes a third argument.
    """
    params = params or RunParams()
    if (query is None) == (documents is None):
        raise ValueError("give either a query or documents")
    if documents is not None:
        result = generate_from_documents(documents, spec, model_fn, params, **run)
    else:
        result = generate_from_query(spark, query, spec, model_fn, params, **run)
    name = spark.range(1).select(output_name(F.lit(params.prefix), F.lit(spec.name), F.lit(documents is not None)).alias("name"))
    base = f"{folder}/{name.first().name}"
    paths = save(result.records, base, params.formats, spec.field_names, ARRIVAL, files)
    return RunOutput(result, paths, preview(result.records, spec, order=ARRIVAL))
