"""Layer checks: label counts, offsets, profiles, reconciliation and row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.functions.columns import count_if
from fraudlens.operators.ordering import running_totals
from fraudlens.session import stage


def label_counts(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows per label, NULL included (A1)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def raw_label_counts(bronze: DataFrame) -> DataFrame:
    """Rows per label straight from the raw JSON (A1)."""
    label = F.get_json_object("value", "$.is_fraud").alias("is_fraud")
    return label_counts(bronze.select(label))


def partition_offsets(bronze: DataFrame) -> DataFrame:
    """Rows and highest offset per topic partition (A2)."""
    return (
        bronze.groupBy("partition")
        .agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("max_offset"))
        .orderBy("partition")
    )


def feature_profile(gold: DataFrame) -> DataFrame:
    """Rows and mean features per label (A3)."""
    return (
        gold.groupBy("is_fraud")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("amount_ratio"), 2).alias("avg_amount_ratio"),
            F.round(F.avg("is_foreign"), 3).alias("avg_is_foreign"),
            F.round(F.avg("tx_1h"), 2).alias("avg_tx_1h"),
        )
        .orderBy("is_fraud")
    )


def table_profile(df: DataFrame, label: str = "is_fraud", time: str = "event_time") -> DataFrame:
    """Row, column and label counts and the time span, in one pass (A4)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        count_if(F.col(label) == 0).alias("label_0"),
        count_if(F.col(label) == 1).alias("label_1"),
        count_if(F.col(label).isNull()).alias("label_null"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Type and filled rows of every column, in one pass (A4)."""
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    return filled.unpivot([], df.columns, "column_name", "filled").select(
        "column_name", types[F.col("column_name")].alias("data_type"), "filled"
    )


def reconcile(manifest: DataFrame, bronze: DataFrame) -> DataFrame:
    """Source counts against bronze per partition.

    ``manifest`` holds (partition, source_rows).  Status: ok, missing rows, extra rows, repeated
    offsets, or offset gap.
    """
    landed = bronze.groupBy("partition").agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        (F.max("offset") - F.min("offset") + 1).alias("offset_span"),
        F.count_distinct("offset").alias("distinct_offsets"),
    )
    rows = F.coalesce(F.col("bronze_rows"), F.lit(0))
    expected = F.coalesce(F.col("source_rows"), F.lit(0))
    status = (
        F.when(rows < expected, "missing rows")
        .when(F.col("distinct_offsets") < rows, "repeated offsets")
        .when(rows > expected, "extra rows")
        .when(F.col("offset_span") > F.col("distinct_offsets"), "offset gap")
        .otherwise("ok")
    )
    return manifest.join(landed, "partition", "full_outer").select(
        "partition",
        expected.alias("source_rows"),
        rows.alias("bronze_rows"),
        "offset_span",
        "distinct_offsets",
        status.alias("status"),
    )


def offset_ranges(bronze: DataFrame) -> DataFrame:
    """Which offsets are missing and which stand there more than once (J3): a row per range of neighbours.

    ``rows`` is the number of missing offsets, or of surplus rows. Missing are offsets between the lowest and the
    highest of a partition. Places of offsets are running totals and neighbouring ranges meet by their places, so a
    partition of any size is split over tasks.
    """
    counts = bronze.groupBy("partition", "offset").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.filter(F.col("offset").isNotNull())

    def islands(offsets: DataFrame) -> DataFrame:
        placed = running_totals(offsets, ["offset"], {"place": ("sum", F.lit(1))}, by=["partition"])
        return placed.groupBy("partition", (F.col("offset") - F.col("place")).alias("island")).agg(
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.min("place").alias("begin"),
            F.max("place").alias("end"),
            F.sum(F.col("n") - 1).alias("rows"),
        )

    present = stage(islands(counts), "offset-islands")
    before = present.select("partition", (F.col("end") + 1).alias("begin"), (F.col("last_offset") + 1).alias("low"))
    gaps = present.join(before, ["partition", "begin"]).select(
        "partition",
        F.lit("missing").alias("kind"),
        F.col("low").alias("first_offset"),
        (F.col("first_offset") - 1).alias("last_offset"),
        (F.col("first_offset") - F.col("low")).alias("rows"),
    )
    repeated = islands(counts.filter("n > 1"))
    return gaps.unionByName(
        repeated.select("partition", F.lit("repeated").alias("kind"), "first_offset", "last_offset", "rows")
    )


def topic_depth(bronze: DataFrame) -> DataFrame:
    """Messages per topic from offsets: high minus low, and high only."""
    spans = bronze.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("high"), F.min("offset").alias("low")
    )
    return spans.groupBy("topic").agg(
        F.sum(F.col("high") - F.col("low")).alias("depth"), F.sum("high").alias("high_sum")
    )


def layer_counts(layers: dict[str, DataFrame | None]) -> DataFrame:
    """Rows per layer, NULL for a table that does not exist."""
    present = next(df for df in layers.values() if df is not None)
    counts = None
    for name, df in layers.items():
        rows: Column = F.count(F.lit(1))
        if df is None:
            df, rows = present.limit(0), F.max(F.lit(None).cast("bigint"))
        one = df.agg(rows.alias("n")).select(F.lit(name).alias("layer"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def alert_rate(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Depth of both topics and 100 x alerts / transactions, NULL without transactions.

    Both sides come as (rows) counts or topic depths in a column ``n``.
    """
    tx = F.coalesce(transactions.agg(F.sum("n")).scalar(), F.lit(0))
    return alerts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("alerts")).select(
        tx.alias("transactions"),
        "alerts",
        F.round(F.try_divide(F.lit(100.0) * F.col("alerts"), tx), 4).alias("alert_rate"),
    )
