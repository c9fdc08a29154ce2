"""Topic to bronze to silver as incremental jobs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fraudlens.functions.columns import ISO_MICROS
from fraudlens.operators import silver
from fraudlens.schemas import ENVELOPE
from fraudlens.session import use_rocksdb
from fraudlens.sources.topics import append_stream, read_table_stream


def land_bronze(
    records: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None
) -> StreamingQuery:
    """Append topic records to bronze, text unchanged."""
    return append_stream(silver.envelope(records), path, checkpoint, fmt, every, "bronze")


def refine_silver(
    spark: SparkSession,
    bronze: str,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append the valid card rows that arrived in bronze since the last run.

    The plan has no shuffle; the checkpoint and the sink's commit log make it exactly-once.
    """
    rows = read_table_stream(spark, bronze, ENVELOPE, fmt, files_per_trigger)
    return append_stream(silver.silver_card(rows), path, checkpoint, fmt, every, "silver")


def dedupe_stream(rows: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """One row per key among those at most ``delay`` apart, the first to arrive.

    The watermark bounds the keys kept in state.
    """
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


class LowestCopy(StatefulProcessor):
    """Holds the copy of lowest (partition, offset) of a key until no other can come any more."""

    def __init__(self, hold_ms: int):
        self.hold_ms = hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lowest = handle.getValueState("lowest", "partition int, offset bigint, row string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows))
        first = found.sort_values(["partition", "offset"]).iloc[0]
        best = (int(first["partition"]), int(first["offset"]), first["row"])
        if not self.lowest.exists():
            self.handle.registerTimer(int(found["at_ms"].min()) + self.hold_ms)
            self.lowest.update(best)
        elif best[:2] < tuple(self.lowest.get())[:2]:
            self.lowest.update(best)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"row": [self.lowest.get()[2]]})
        self.lowest.clear()

    def close(self) -> None:
        pass


def dedupe_lowest(rows: DataFrame, key: str, time: str, hold_seconds: int, delay: str = "10 minutes") -> DataFrame:
    """One row per key, the copy of lowest (partition, offset), in whatever order copies arrive.

    A key's first row is held for ``hold_seconds`` of event time; copies within that compete, and the winner is given
    out when the watermark, ``delay`` behind the newest row, has passed. So the result is that of the batch dedupe for
    all copies at most that far apart, whatever the micro-batches. ``rows`` need ``partition`` and ``offset``.
    Copies of one micro-batch are one call for the key; only keys and not yet given out rows are in the state.
    """
    use_rocksdb(rows.sparkSession)
    exact_time = {"timestampFormat": ISO_MICROS}
    whole = F.to_json(F.struct(*rows.columns), exact_time)
    thin = rows.withWatermark(time, delay).filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), "partition", "offset", F.col(time).alias("at"), F.unix_millis(F.col(time)).alias("at_ms"), whole.alias("row")
    )
    kept = thin.groupBy("key").transformWithStateInPandas(LowestCopy(hold_seconds * 1000), "row string", "append", "eventTime")
    schema = T.StructType(list(rows.schema.fields))
    return kept.select(F.inline(F.array(F.from_json("row", schema, exact_time))))
