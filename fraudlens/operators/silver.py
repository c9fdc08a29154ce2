"""Envelope projection, JSON decoding, validity filters, dedupe and reject accounting.

Every function but the batch dedupe and the reject counts works on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.functions.columns import iso_to_timestamp
from fraudlens.schemas import CARD_TX, WIDE_TX


def envelope(records: DataFrame) -> DataFrame:
    """Topic records to bronze rows: key and value as text, the rest as it came."""
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def decode(bronze: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text to typed columns (P2); malformed text gives a row of NULLs.

    The one-element ``inline`` keeps filters from being pushed below the decode, where each of
    them would parse the text again.
    """
    parsed = F.array(F.from_json(F.col("value"), schema))
    return bronze.select(*keep, F.inline(parsed).alias(*schema.fieldNames()))


def card_checks() -> list[tuple[str, Column]]:
    """(reason, passes) in the order rejects are attributed."""
    return [
        ("transaction_id missing", F.col("transaction_id").isNotNull()),
        ("card_id missing", F.col("card_id").isNotNull()),
        ("is_fraud missing", F.col("is_fraud").isNotNull()),
        ("amount not positive", F.coalesce(F.col("amount") > 0, F.lit(False))),
    ]


def wide_checks() -> list[tuple[str, Column]]:
    """(reason, passes) for wide rows (P4); an amount of 0 is valid here."""
    return [
        ("row_id missing", F.col("row_id").isNotNull()),
        ("Amount missing", F.col("Amount").isNotNull()),
        ("Amount negative", F.coalesce(F.col("Amount") >= 0, F.lit(False))),
        ("is_fraud not 0 or 1", F.coalesce(F.col("is_fraud").isin(0, 1), F.lit(False))),
    ]


def _all_pass(checks: list[tuple[str, Column]]) -> Column:
    condition = F.lit(True)
    for _, passes in checks:
        condition = condition & passes
    return condition


def silver_card(bronze: DataFrame) -> DataFrame:
    """Bronze to typed, valid card rows (P2, P3, P5); a bad time is kept as NULL."""
    rows = decode(bronze, CARD_TX).filter(_all_pass(card_checks()))
    return rows.withColumn("event_time", iso_to_timestamp(F.col("event_time")))


def wide_rows(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze to typed, valid wide rows, repeats included."""
    rows = decode(bronze, WIDE_TX, keep).filter(_all_pass(wide_checks()))
    return rows.withColumn("event_time", iso_to_timestamp(F.col("event_time")))


def silver_wide(bronze: DataFrame) -> DataFrame:
    """Wide rows, one per ``row_id``: the one read first by (partition, offset)."""
    rows = wide_rows(bronze, keep=("partition", "offset"))
    return first_per_key(rows, "row_id", ["partition", "offset"]).drop("partition", "offset")


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One whole row per key, the first in ``order``.

    An aggregate rather than a window, so copies are reduced before the shuffle.
    """
    payload = F.struct(*[c for c in df.columns if c != key])
    first = df.groupBy(key).agg(F.min_by(payload, F.struct(*order)).alias("row"))
    return first.select(key, "row.*").select(*df.columns)


def scorable(messages: DataFrame) -> DataFrame:
    """Messages the live scorer accepts: those with an event time and a country."""
    return messages.filter(F.col("event_time").isNotNull() & F.col("country").isNotNull())


def wide_scorable() -> Column:
    """What the wide scorer accepts: rows with an id, an amount and a readable time."""
    return (
        F.col("row_id").isNotNull() & F.col("Amount").isNotNull() & F.col("event_time").isNotNull()
    )


def reject_counts(decoded: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """Rows per first failing check, valid rows as ``accepted``."""
    reason = F.lit("accepted")
    for text, passes in reversed(checks):
        reason = F.when(~passes, F.lit(text)).otherwise(reason)
    return decoded.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
