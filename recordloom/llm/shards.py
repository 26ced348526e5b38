"""Sharding by a two-pass external shuffle, in DataFrame operations only.

First pass: a seeded hash of id and text scatters the records evenly into buckets, as many as make a bucket
``bucket_bytes`` on average. Second pass: each bucket, a task of its own, is put into an order that does not depend
on how it arrived, shuffled by Fisher-Yates (Spark's ``shuffle`` of an array) and written. The buckets one after
the other are the shuffled corpus; it is cut into shards whose row counts differ by one at most (law ``rows``):
position p of N goes to the shard that holds p when the first N mod n of n shards get one row more.

A task that is run again gets the same records, so each record is written once whatever is lost. The same seed,
input and bucket size give the same order.

Defined results: a null text counts as no bytes. An empty table gives no shards. Rows with the same id and text
share a bucket: sizes are even as long as ids are. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.llm.arrays import without
from recordloom.session import new_work_dir

PLACE = ("shard", "slot")
_BUCKET, _AT = "__bucket", "__at"


def _shuffled(docs: DataFrame, id_column: str, text_column: str, seed: int, buckets: int) -> DataFrame:
    """All records with their bucket and their place in it."""
    hashed = F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), F.col(f"`{text_column}`"))
    record = F.struct(hashed.alias("draw"), F.struct([F.col(f"`{c}`") for c in docs.columns]).alias("record"))
    scattered = docs.select(F.pmod(hashed, F.lit(buckets)).cast("int").alias(_BUCKET), record.alias("item"))
    grouped = scattered.repartitionById(buckets, F.col(_BUCKET)).groupBy(_BUCKET).agg(F.collect_list("item").alias("items"))
    ordered = F.array_sort("items", lambda a, b: F.when(a["draw"] < b["draw"], -1).when(a["draw"] > b["draw"], 1).otherwise(0))
    mixed = grouped.select(_BUCKET, F.shuffle(ordered, seed).alias("items"))
    return mixed.select(_BUCKET, F.posexplode("items").alias(_AT, "item")).select(_BUCKET, F.col(_AT).cast("long").alias(_AT), "item.record.*")


def write_shards(
    docs: DataFrame,
    path: str,
    *,
    shards: int,
    seed: int = 17,
    bucket_bytes: int = 8 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Write the shuffled records under ``path``: ``records`` (by bucket) and ``buckets`` (their positions)."""
    docs = without(docs, [*PLACE, _BUCKET, _AT])
    size = F.coalesce(F.octet_length(F.col(f"`{text_column}`")), F.lit(0)).cast("long") + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    _shuffled(docs, id_column, text_column, seed, buckets).write.parquet(f"{path}/records")
    spark = docs.sparkSession
    counts = spark.read.parquet(f"{path}/records").groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # a narrow row for each bucket
    first = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
    all_rows = F.sum("n").over(Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    counts.select(_BUCKET, first, all_rows.alias("rows"), F.lit(shards).alias("shards")).write.parquet(f"{path}/buckets")


def read_shards(spark: SparkSession, path: str, columns: list | None = None) -> DataFrame:
    """The records with shard and slot (from 0 in each shard). ``columns``: expressions over the records (all if None)."""
    records = spark.read.parquet(f"{path}/records")
    wanted = [F.col(f"`{c}`") for c in records.columns if c not in (_BUCKET, _AT)] if columns is None else columns
    joined = records.select(_BUCKET, _AT, *wanted).join(spark.read.parquet(f"{path}/buckets"), _BUCKET)
    names = [c for c in joined.columns if c not in (_BUCKET, _AT, "first", "rows", "shards")]
    at = F.expr(f"first + {_AT}")
    placed = joined.select(*names, at.alias("p"), F.expr("rows div shards").alias("base"), F.expr("rows % shards").alias("longer"))
    # the first ``longer`` shards hold base + 1 rows, the others base
    in_longer = "p < longer * (base + 1)"
    rest = "(p - longer * (base + 1))"
    return placed.select(
        *names,
        F.expr(f"CAST(if({in_longer}, p div (base + 1), longer + {rest} div greatest(base, 1)) AS INT) AS shard"),
        F.expr(f"if({in_longer}, p % (base + 1), {rest} % greatest(base, 1)) AS slot"),
    )


def sharded(docs: DataFrame, shards: int, columns: list | None = None, **options) -> DataFrame:
    """Write shards into the shared working folder and read them back."""
    path = new_work_dir(docs.sparkSession, "shards")
    write_shards(docs, path, shards=shards, **options)
    return read_shards(docs.sparkSession, path, columns)
