"""The newest rows of a stream, kept in a table of bounded size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fraudlens.session import exists
from fraudlens.streaming import rollup


def _version(path: str, epoch: int) -> str:
    return f"{path}/epoch={epoch}"


def keep_newest(
    rows: DataFrame, path: str, checkpoint: str, newest: Callable[[DataFrame], DataFrame], every: str | None = None
) -> StreamingQuery:
    """Start a stream that keeps ``newest(rows kept so far and new rows)`` below ``path``.

    ``newest`` must give the same rows for a table and for what it keeps of the table's parts, as the cuts of
    ``operators.alerts`` do. Each micro-batch is cut first, then merged with the version before it and written as a version
    of its own; a repeated micro-batch replaces its own. Two versions stay, so a reader of the last one is safe.
    """
    schema = rows.schema

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            kept, before = newest(batch), _version(path, epoch - 1)
            if epoch and exists(spark, f"{before}/_SUCCESS"):
                kept = newest(spark.read.schema(schema).parquet(before).unionByName(kept))
            kept.write.mode("overwrite").parquet(_version(path, epoch))
        finally:
            batch.unpersist()
        for name in rollup.names(spark, path):
            if name.startswith("epoch=") and int(name[6:]) < epoch - 1:
                rollup.delete(spark, f"{path}/{name}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_newest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows kept after the last finished micro-batch."""
    epochs = sorted((int(n[6:]) for n in rollup.names(spark, path) if n.startswith("epoch=")), reverse=True)
    for epoch in epochs:
        if exists(spark, f"{_version(path, epoch)}/_SUCCESS"):
            return spark.read.schema(schema).parquet(_version(path, epoch))
    return spark.createDataFrame([], schema)
