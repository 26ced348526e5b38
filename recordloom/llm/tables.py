"""Joins and connected components of large tables, whatever their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.session import new_work_dir, written

#: Keys held by more than one in so many rows are joined apart; there can be no more of them.
HOT_SHARE = 2000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(frame: DataFrame, path: str) -> DataFrame:
    """As ``written``, and the shuffle files of the write go with its end."""
    conf = frame.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return written(frame, path)
    finally:
        conf.set(CLEANUP, before) if before is not None else conf.unset(CLEANUP)


def joined_by_key(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row per key), whose column ``count`` says how many rows have the key.

    Keys that many rows share go to all tasks (at most HOT_SHARE keys exceed their share); the rest is shuffled.
    """
    total = table.agg(F.sum(count).alias("n")).first().n or 0
    hot = F.col(count) * HOT_SHARE > total
    shared = F.broadcast(table.where(hot).drop(count).withColumn("__hot", F.lit(True)))
    marked = rows.join(shared, key, "left")
    here = marked.where("__hot").drop("__hot")
    rest = marked.where("__hot IS NULL").select(rows.columns).join(table.where(~hot).drop(count), key)
    return here.unionByName(rest)


def components(links: DataFrame) -> DataFrame:
    """Connected components of links a - b: node, label (the smallest node it is connected with)."""
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select("b", "a"))
    label = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), new_work_dir(spark, "labels"))
    while True:
        seen = both.join(label, both["b"] == label["node"]).select(F.col("a").alias("node"), "label")
        lowest = label.union(seen).groupBy("node").agg(F.min("label").alias("label"))
        # what the label itself is labelled with: paths halve in each round
        up = label.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = lowest.join(up, "label", "left").select("node", F.coalesce(F.least("above", "label"), "label").alias("label"))
        new = settled(jumped, new_work_dir(spark, "labels"))
        if not new.join(label, ["node", "label"], "left_anti").limit(1).count():
            return new
        label = new
