"""Card tables laid out for their readers (S2, S7): days are folders, cards are buckets.

Features, which look at one card at a time, then need no shuffle: rows of a card are in one bucket wherever they
are. Reports over a period open only its days.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_COLUMN = "event_date"


def save_by_card(df: DataFrame, name: str, path: str, buckets: int = 64) -> None:
    """Write card rows as the table ``name`` at ``path``, replacing it: a folder a day, ``buckets`` files in each.

    One shuffle by card deals the rows, so every task writes one bucket of all days. Rows without a time have a folder
    of their own. ``df`` must not read the table that it replaces.
    """
    rows = df.withColumn(DAY_COLUMN, F.to_date("event_time")).repartition(buckets, "card_id")
    writer = rows.write.mode("overwrite").format("parquet").option("path", path).partitionBy(DAY_COLUMN)
    writer.bucketBy(buckets, "card_id").sortBy("card_id", "event_time").saveAsTable(name)


def read_by_card(spark: SparkSession, name: str) -> DataFrame:
    """The table without its day; operators that group or window by card do not shuffle it."""
    return spark.table(name).drop(DAY_COLUMN)


def read_period(spark: SparkSession, name: str, first: datetime, end: datetime) -> DataFrame:
    """Rows with ``first`` <= event time < ``end``, times of the session's zone; only folders of these days are opened."""
    rows = spark.table(name).filter(F.col(DAY_COLUMN).between(F.lit(first.date()), F.lit(end.date())))
    low, high = (F.lit(t.isoformat(" ")).cast("timestamp") for t in (first, end))
    within = (F.col("event_time") >= low) & (F.col("event_time") < high)
    return rows.filter(within).drop(DAY_COLUMN)
