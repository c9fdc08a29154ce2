"""Card and wide transactions derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.functions.columns import timestamp_to_iso
from fraudlens.operators.ordering import with_row_index
from fraudlens.schemas import CARD_TX, COUNTRIES, WIDE_FEATURES, WIDE_TX

TOPIC = "transactions"
WIDE_TOPIC = "transactions_real"
TEST_MERCHANTS = ["click", "error", "purchase", "signup", "view"]
ALERT_SCORE = 0.8
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return events.withColumns(
        {
            "event_time": F.col("ts").cast("timestamp"),
            "k": F.get_json_object("props", "$.k").cast("int"),
        }
    )


def _country(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]), (index + 1).cast("int"))


def _card_columns() -> dict[str, Column]:
    user = F.col("user_id")
    home = F.pmod(user, F.lit(len(COUNTRIES)))
    away = F.when(F.col("k") < 80, home).otherwise(F.pmod(F.col("k"), F.lit(len(COUNTRIES))))
    return {
        "transaction_id": F.col("event_id").cast("string"),
        "card_id": F.concat(F.lit("card_"), user.cast("string")),
        "amount": F.col("value"),
        "merchant_category": F.col("event_type"),
        "country": _country(away),
        "home_country": _country(home),
    }


def card_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean card transactions with a model-free score."""
    second_run = F.lit("2024-01-16 00:00:00").cast("timestamp")
    columns = _card_columns() | {
        "is_fraud": ((F.col("k") >= 90) & (F.col("value") > 40)).cast("int"),
        "score": F.round(F.col("k") / F.lit(99.0), 4),
        "latency_ms": (100 + (F.col("event_id") * 7) % 900).cast("double"),
        "run_id": F.when(F.col("event_time") < second_run, F.lit(1)).otherwise(F.lit(2)),
    }
    return (
        _events(spark, sf_dir)
        .filter(F.col("value") > 0)
        .withColumns(columns)
        .select(*list(columns)[:6], "event_time", *list(columns)[6:], "event_id", "user_id")
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card_tx(spark, sf_dir).filter(F.col("score") >= ALERT_SCORE)


def card_tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card transactions with missing cards, labels and countries and amounts of 0."""

    def every(n: int) -> Column:
        return F.col("event_id") % n == 0

    columns = _card_columns()
    columns["card_id"] = F.when(~every(613), columns["card_id"])
    columns["amount"] = F.when(every(500), F.lit(0.0)).otherwise(columns["amount"])
    columns["country"] = F.when(~every(307), columns["country"])
    columns["is_fraud"] = F.when(~every(401), (F.col("k") >= 90).cast("int"))
    return (
        _events(spark, sf_dir)
        .withColumns(columns)
        .select(
            *columns,
            "event_time",
            F.pmod("user_id", F.lit(3)).cast("int").alias("part"),
            "event_id",
        )
    )


def card_topic(spark: SparkSession, sf_dir: str, offsets: bool = True) -> DataFrame:
    """The dirty transactions as topic records with binary key and JSON value.

    Offsets number the rows of a partition without gaps; without them the event id stands in,
    which spares jobs that do not look at offsets a sort of the table.
    """
    rows = card_tx_raw(spark, sf_dir)
    if offsets:
        rows = with_row_index(rows, ["part", "event_id"], "place")
        starts = rows.groupBy("part").agg(F.min("place").alias("first"))  # three parts
        rows = rows.join(F.broadcast(starts), "part").withColumn(
            "offs", F.col("place") - F.col("first")
        )
    else:
        rows = rows.withColumn("offs", F.col("event_id"))
    message = [
        timestamp_to_iso(F.col(c)).alias(c) if c == "event_time" else F.col(c)
        for c in CARD_TX.fieldNames()
    ]
    return rows.select(
        F.col("card_id").cast("binary").alias("key"),
        F.to_json(F.struct(*message)).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.col("part").alias("partition"),
        F.col("offs").cast("bigint").alias("offset"),
        F.col("event_time").alias("timestamp"),
    )


def wide_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anonymised numeric transactions; the row id is their order."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    vectors = spark.read.schema(EMBEDDINGS).parquet(f"{sf_dir}/embeddings.parquet")

    def value(i: int) -> Column:
        return F.col("embedding")[i - 1].cast("double")

    return vectors.select(
        F.col("vec_id").alias("row_id"),
        *[value(i).alias(f"V{i}") for i in range(1, 29)],
        F.round(F.abs(value(29)) * 100, 2).alias("Amount"),
        (F.col("label") == 0).cast("int").alias("is_fraud"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id")).alias("event_time"),
    )


def wide_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide transactions as topic records; every 50th is sent again one day later, at the odd offset."""
    rows = wide_tx(spark, sf_dir).withColumn("offset", 2 * F.col("row_id"))
    again = rows.filter(F.col("row_id") % 50 == 0).withColumns(
        {
            "offset": F.col("offset") + 1,
            "event_time": F.col("event_time") + F.expr("interval 1 day"),
        }
    )
    message = [
        timestamp_to_iso(F.col(c)).alias(c) if c == "event_time" else F.col(c)
        for c in WIDE_TX.fieldNames()
    ]
    return rows.unionByName(again).select(
        F.col("row_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*message)).cast("binary").alias("value"),
        F.lit(WIDE_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.col("event_time").alias("timestamp"),
    )


def raw_csv_rows(wide: DataFrame) -> DataFrame:
    """Wide rows in the column layout of the raw CSV."""
    return wide.select(*WIDE_FEATURES, F.col("is_fraud").alias("Class"))
