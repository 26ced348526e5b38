"""Streams in which every target takes its first so many records and no more; the counts live in the state store."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from recordloom.errors import ConfigurationError
from recordloom.streaming.records import ROCKSDB

# The processor goes to the executors as it is.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Into how many parts the records of one target are dealt before they are counted together.
PARTS = 16
COUNT = T.StructType([T.StructField("records", T.LongType())])


class FirstRecords(StatefulProcessor):
    """Passes on the first records of each key in arrival order until there are as many as their ``wanted`` says.

    The state of a key is one number. Of a micro-batch no more rows are held than are still missing.
    """

    def __init__(self, keys: list[str], columns: list[str], wanted: str, order: tuple[str, ...], keep_ms: int | None):
        self.keys, self.columns, self.wanted, self.order, self.keep_ms = keys, columns, wanted, list(order), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.taken = handle.getValueState("taken", COUNT, self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        so_far = self.taken.get()[0] if self.taken.exists() else 0
        first = None
        for more in rows:
            more = more if first is None else pd.concat([first, more])
            missing = max(0, int(more[self.wanted].iloc[0]) - so_far)
            first = more.sort_values(self.order, kind="stable").head(missing)
        if first is not None and len(first):
            self.taken.update((so_far + len(first),))
            # the columns of the key are not among those of the rows
            yield first.assign(**dict(zip(self.keys, key, strict=True)))[self.columns]

    def close(self) -> None:
        pass


def cap_stream(
    records: DataFrame,
    target: str = "target_id",
    wanted: str = "num_samples",
    order: tuple[str, ...] = ("batch_id", "pos"),
    keep_ms: int | None = None,
) -> DataFrame:
    """The first ``wanted`` records of each target, whatever micro-batches they come in.

    Within a micro-batch the order is that of ``order``. Records of one target are dealt into :data:`PARTS` parts
    first, each of which passes on no more than are wanted, so that a target that holds a third of the stream is not
    one task's alone; what is counted together is at most :data:`PARTS` times what is wanted. A target that got
    nothing for ``keep_ms`` milliseconds is forgotten and begins anew. The session's state store must be RocksDB.
    """
    spark = records.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
        raise ConfigurationError(f"set spark.sql.streaming.stateStore.providerClass to {ROCKSDB}")
    columns = records.columns
    part = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(PARTS)).cast("int").alias("__part")
    mode = "processingTime" if keep_ms is not None else "none"

    def first(rows: DataFrame, keys: list[str]) -> DataFrame:
        processor = FirstRecords(keys, columns, wanted, order, keep_ms)
        return rows.groupBy(*keys).transformWithStateInPandas(processor, records.schema, "append", mode)

    return first(first(records.select("*", part), [target, "__part"]), [target])
