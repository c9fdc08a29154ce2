"""A raw CSV as topic messages, in file order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.functions.columns import timestamp_to_iso
from fraudlens.operators.alerts import to_messages
from fraudlens.schemas import RAW_CSV, WIDE_FEATURES
from fraudlens.sources.tables import number_rows, read_csv


def replay_rows(
    spark: SparkSession, path: str, start: int = 0, limit: int = 0, sent_at: Column | None = None
) -> DataFrame:
    """Rows ``[start, start + limit)`` of the file as wide messages; limit 0 is all."""
    rows = number_rows(read_csv(spark, path, RAW_CSV)).filter(F.col("row_id") >= start)
    if limit:
        rows = rows.filter(F.col("row_id") < start + limit)
    sent = F.current_timestamp() if sent_at is None else sent_at
    return rows.select(
        "row_id",
        *WIDE_FEATURES,
        F.col("Class").alias("is_fraud"),
        timestamp_to_iso(sent).alias("event_time"),
    )


def replay_messages(spark: SparkSession, path: str, start: int = 0, limit: int = 0) -> DataFrame:
    """The same rows as (key, value) messages keyed by the row id."""
    return to_messages(replay_rows(spark, path, start, limit), "row_id")
