"""From raw documents to token ids in five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import decontaminate, importance, line_dedup, minhash, pieces
from recordloom.session import new_work_dir, small_batches, written

PIECES = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    small_batches(spark)
    return importance.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest id."""
    small_batches(spark)
    return minhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document has; n_chars follows the text."""
    small_batches(spark)
    out = line_dedup.remove_repeats(docs, spans_column=None)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold too much of a test item."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    small_batches(spark)
    model = pieces.Pieces.load(public_tokenizers.path(PIECES))
    return pieces.encode(docs, model, keep=["doc_id"]).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

#: The classifier, the sampled search for near-duplicates and the Viterbi search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), new_work_dir(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
