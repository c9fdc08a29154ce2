"""Column expressions shared by batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def iso_to_timestamp(text: Column) -> Column:
    """ISO-8601 text to timestamp, NULL where it does not parse."""
    return text.try_cast("timestamp")


def timestamp_to_iso(ts: Column) -> Column:
    """Timestamp to ISO-8601 text that keeps the microseconds."""
    return F.date_format(ts, ISO_MICROS)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def elapsed_ms(start: Column, end: Column) -> Column:
    """Milliseconds from ``start`` to ``end``, one decimal."""
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1000.0), 1)


def flag(score: Column, threshold: float) -> Column:
    """True where the score reaches the threshold; a missing score is never flagged."""
    return F.coalesce((score >= F.lit(float(threshold))) & ~F.isnan(score), F.lit(False))


def count_if(condition: Column) -> Column:
    """Rows for which the condition holds, as bigint and 0 for no rows."""
    return F.count(F.when(condition, F.lit(1)))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def one_hot(value: Column, vocabulary: list[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per vocabulary entry; unknown and missing values give all zeros."""
    return {
        f"{prefix}_{entry}": F.coalesce((value == F.lit(entry)).cast("int"), F.lit(0))
        for entry in vocabulary
    }


def class_name(label: Column, positive: str = "Fraude", negative: str = "Normale") -> Column:
    """The class of a label; NULL without one."""
    return F.when(label == 1, F.lit(positive)).when(label == 0, F.lit(negative))
