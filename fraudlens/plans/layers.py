"""Queries over the layers: bronze, silver, gold, their checks, and chronological order."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators import features, ordering, quality, silver
from fraudlens.plans.registry import query
from fraudlens.schemas import CARD_TX, WIDE_FEATURES, WIDE_TX
from fraudlens.session import new_path
from fraudlens.sources import layout, replay, tables, views

TX_KEYS = ["event_time", "transaction_id"]


def bronze(spark, sf, offsets: bool = False) -> DataFrame:
    return silver.envelope(views.card_topic(spark, sf, offsets))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# -- features --------------------------------------------------------------------------------


@query(
    "gold_features",
    "SELECT * REPLACE (round(amount_ratio, 6) AS amount_ratio) FROM gold",
    views=("gold",),
)
def gold_features(spark, sf):
    return rounded(features.card_features(views.card_tx(spark, sf)), "amount_ratio")


@query(
    "gold_by_card",
    "SELECT * REPLACE (round(amount_ratio, 6) AS amount_ratio) FROM gold",
    views=("gold",),
)
def gold_by_card(spark, sf):
    """The same features from a table bucketed by card, which are windowed without a shuffle."""
    name = f"tx_by_card_{uuid.uuid4().hex}"
    layout.save_by_card(views.card_tx(spark, sf), name, new_path(spark, "by-card"), buckets=8)
    return rounded(features.card_features(layout.read_by_card(spark, name)), "amount_ratio")


@query(
    "period_kpis",
    """SELECT count(*) AS alerts, count(*) FILTER (is_fraud = 1) AS frauds, round(avg(latency_ms), 6) AS mean_latency_ms
    FROM alerts WHERE event_time >= TIMESTAMP '2024-01-10 06:00:00' AND event_time < TIMESTAMP '2024-01-12'""",
    views=("alerts",),
)
def period_kpis(spark, sf):
    """Figures of two days of alerts, from a table of which only those days are opened."""
    name = f"alerts_by_day_{uuid.uuid4().hex}"
    layout.save_by_card(views.alerts(spark, sf), name, new_path(spark, "by-day"), buckets=8)
    rows = layout.read_period(spark, name, datetime(2024, 1, 10, 6), datetime(2024, 1, 12))
    frauds = F.count_if(F.col("is_fraud") == 1)
    mean = F.round(F.avg("latency_ms"), 6)
    return rows.agg(F.count(F.lit(1)).alias("alerts"), frauds.alias("frauds"), mean.alias("mean_latency_ms"))


@query(
    "gold_profile",
    """SELECT is_fraud, count(*) AS n, round(avg(amount_ratio), 2) AS avg_amount_ratio,
      round(avg(is_foreign), 3) AS avg_is_foreign, round(avg(tx_1h), 2) AS avg_tx_1h
    FROM gold GROUP BY is_fraud""",
    views=("gold",),
)
def gold_profile(spark, sf):
    return quality.feature_profile(features.card_features(views.card_tx(spark, sf)))


@query(
    "one_hot",
    "SELECT transaction_id, "
    + ", ".join(
        f"CASE WHEN merchant_category = '{m}' THEN 1 ELSE 0 END AS merchant_category_{m}"
        for m in views.TEST_MERCHANTS
    )
    + " FROM tx",
    views=("tx",),
)
def one_hot(spark, sf):
    tx = views.card_tx(spark, sf).select("transaction_id", "merchant_category")
    return features.with_merchant_columns(tx, views.TEST_MERCHANTS).drop("merchant_category")


# -- bronze and silver -----------------------------------------------------------------------


@query(
    "bronze_envelope",
    """SELECT card_id AS key, transaction_id, 'transactions' AS topic, part AS partition,
      offs AS "offset", event_time AS kafka_timestamp FROM tx_raw""",
    views=("tx_raw",),
)
def bronze_envelope(spark, sf):
    rows = bronze(spark, sf, offsets=True)
    transaction = F.get_json_object("value", "$.transaction_id").alias("transaction_id")
    return rows.select("key", transaction, "topic", "partition", "offset", "kafka_timestamp")


@query("silver_card", "SELECT * FROM silver", views=("silver",))
def silver_card(spark, sf):
    return silver.silver_card(bronze(spark, sf))


@query(
    "silver_wide",
    """SELECT * EXCLUDE (offs) FROM wide_raw WHERE Amount >= 0 AND is_fraud IN (0, 1)
    QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY offs) = 1""",
    views=("wide_raw",),
)
def silver_wide(spark, sf):
    return silver.silver_wide(silver.envelope(views.wide_topic(spark, sf)))


@query(
    "scorer_message_filter",
    "SELECT transaction_id, country, event_time FROM tx_raw"
    " WHERE event_time IS NOT NULL AND country IS NOT NULL",
    views=("tx_raw",),
)
def scorer_message_filter(spark, sf):
    messages = silver.scorable(silver.decode(bronze(spark, sf), CARD_TX))
    return messages.select(
        "transaction_id", "country", F.col("event_time").try_cast("timestamp").alias("event_time")
    )


@query(
    "rejects",
    """SELECT CASE WHEN transaction_id IS NULL THEN 'transaction_id missing'
        WHEN card_id IS NULL THEN 'card_id missing' WHEN is_fraud IS NULL THEN 'is_fraud missing'
        WHEN amount IS NULL OR amount <= 0 THEN 'amount not positive' ELSE 'accepted' END AS reason,
      count(*) AS n
    FROM tx_raw GROUP BY reason""",
    views=("tx_raw",),
)
def rejects(spark, sf):
    decoded = silver.decode(bronze(spark, sf), CARD_TX)
    return silver.reject_counts(decoded, silver.card_checks())


@query(
    "label_counts_raw",
    "SELECT CAST(is_fraud AS VARCHAR) AS is_fraud, count(*) AS n FROM tx_raw GROUP BY is_fraud",
    views=("tx_raw",),
)
def label_counts_raw(spark, sf):
    return quality.raw_label_counts(bronze(spark, sf))


@query(
    "label_filter", "SELECT * FROM silver WHERE is_fraud = 1", views=("silver",)
)
def label_filter(spark, sf):
    return silver.silver_card(bronze(spark, sf)).filter("is_fraud = 1")


# -- checks ----------------------------------------------------------------------------------


@query(
    "partition_offsets",
    "SELECT part AS partition, count(*) AS n, max(offs) AS max_offset FROM tx_raw GROUP BY part",
    views=("tx_raw",),
)
def partition_offsets(spark, sf):
    return quality.partition_offsets(bronze(spark, sf, offsets=True))


@query(
    "table_profile",
    """SELECT count(*) AS rows, CAST(8 AS BIGINT) AS columns, count(*) FILTER (is_fraud = 0) AS label_0,
      count(*) FILTER (is_fraud = 1) AS label_1, count(*) FILTER (is_fraud IS NULL) AS label_null,
      min(event_time) AS first_time, max(event_time) AS last_time FROM silver""",
    views=("silver",),
)
def table_profile(spark, sf):
    return quality.table_profile(silver.silver_card(bronze(spark, sf)))


_SILVER_TYPES = {
    "transaction_id": "string",
    "card_id": "string",
    "amount": "double",
    "merchant_category": "string",
    "country": "string",
    "home_country": "string",
    "event_time": "timestamp",
    "is_fraud": "int",
}


@query(
    "column_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS filled FROM silver"
        for c, t in _SILVER_TYPES.items()
    ),
    views=("silver",),
)
def column_profile(spark, sf):
    return quality.column_profile(silver.silver_card(bronze(spark, sf)))


@query(
    "reconcile",
    """SELECT part AS partition, count(*) AS source_rows, count(*) AS bronze_rows,
      max(offs) - min(offs) + 1 AS offset_span, count(DISTINCT offs) AS distinct_offsets, 'ok' AS status
    FROM tx_raw GROUP BY part""",
    views=("tx_raw",),
)
def reconcile(spark, sf):
    source = views.card_tx_raw(spark, sf).groupBy(F.col("part").alias("partition"))
    manifest = source.agg(F.count(F.lit(1)).alias("source_rows"))
    return quality.reconcile(manifest, bronze(spark, sf, offsets=True))


@query(
    "offset_ranges",
    """, landed AS (SELECT part, offs, n FROM tx_raw, range(1, 4) c(n)
      WHERE offs % 97 NOT IN (5, 6, 7) AND (n = 1 OR n = 2 AND offs % 131 IN (0, 1) OR n = 3 AND offs % 262 = 1)),
    counted AS (SELECT part, offs, count(*) AS n FROM landed GROUP BY part, offs)
    SELECT part AS partition, 'missing' AS kind, before + 1 AS first_offset, offs - 1 AS last_offset,
      offs - before - 1 AS "rows"
    FROM (SELECT part, offs, lag(offs) OVER (PARTITION BY part ORDER BY offs) AS before FROM counted) l
    WHERE offs > before + 1
    UNION ALL
    SELECT part, 'repeated', min(offs), max(offs), CAST(sum(n - 1) AS BIGINT)
    FROM (SELECT *, offs - row_number() OVER (PARTITION BY part ORDER BY offs) AS island FROM counted WHERE n > 1) i
    GROUP BY part, island""",
    views=("tx_raw",),
)
def offset_ranges(spark, sf):
    """Bronze with three offsets in 97 lost and some landed twice or three times."""
    place = F.col("offset")
    landed = bronze(spark, sf, offsets=True).filter(~(place % 97).isin(5, 6, 7))
    again = landed.filter((place % 131).isin(0, 1))
    return quality.offset_ranges(landed.unionByName(again).unionByName(landed.filter(place % 262 == 1)))


@query(
    "topic_depth",
    """SELECT 'transactions' AS topic, CAST(sum(hi - lo + 1) AS BIGINT) AS depth,
      CAST(sum(hi + 1) AS BIGINT) AS high_sum
    FROM (SELECT part, min(offs) AS lo, max(offs) AS hi FROM tx_raw GROUP BY part) p""",
    views=("tx_raw",),
)
def topic_depth(spark, sf):
    return quality.topic_depth(bronze(spark, sf, offsets=True))


@query(
    "layer_counts",
    """SELECT 'bronze' AS layer, count(*) AS n FROM tx_raw
    UNION ALL SELECT 'silver', count(*) FROM silver
    UNION ALL SELECT 'gold', count(*) FROM silver WHERE event_time IS NOT NULL
    UNION ALL SELECT 'wide gold', NULL""",
    views=("silver",),
)
def layer_counts(spark, sf):
    raw = bronze(spark, sf)
    clean = silver.silver_card(raw)
    missing = tables.read_table_or_none(spark, new_path(spark, "no-such-table"))
    layers = {
        "bronze": raw,
        "silver": clean,
        "gold": features.card_features(clean),
        "wide gold": missing,
    }
    return quality.layer_counts(layers)


# -- storage ---------------------------------------------------------------------------------


@query(
    "table_overwrite",
    "SELECT row_id, Amount, is_fraud FROM wide WHERE is_fraud = 1",
    views=("wide",),
)
def table_overwrite(spark, sf):
    """Write all rows, replace them by the frauds read from the first version, read back."""
    path = new_path(spark, "overwrite")
    wide = views.wide_tx(spark, sf).select("row_id", "Amount", "is_fraud")
    tables.replace_table(wide, path)
    tables.replace_table(tables.read_current(spark, path).filter("is_fraud = 1"), path)
    return tables.read_current(spark, path)


@query(
    "csv_roundtrip",
    f"SELECT {', '.join(WIDE_FEATURES)}, is_fraud AS Class FROM wide",
    views=("wide",),
)
def csv_roundtrip(spark, sf):
    path = new_path(spark, "csv")
    rows = views.raw_csv_rows(views.wide_tx(spark, sf))
    tables.write_csv(rows, path, label="Class")
    return tables.read_csv(spark, path, rows.schema)


@query(
    "replay_rows",
    f"""SELECT row_id, {", ".join(WIDE_FEATURES)}, is_fraud FROM wide
    WHERE row_id >= (SELECT CAST(floor(count(*) * 0.8e0) AS BIGINT) FROM wide)""",
    views=("wide",),
)
def replay_file(spark, sf):
    """The test rows of the raw CSV, sent as messages and decoded again."""
    path = new_path(spark, "csv")
    wide = views.wide_tx(spark, sf)
    tables.write_csv(views.raw_csv_rows(wide.orderBy("row_id")), path, label="Class")
    messages = replay.replay_messages(spark, path, start=int(wide.count() * 0.8))
    return silver.decode(messages, WIDE_TX).drop("event_time")


# -- order -----------------------------------------------------------------------------------


@query("chrono_index", "SELECT transaction_id, row_idx FROM indexed", views=("indexed",))
def chrono_index(spark, sf):
    keys = views.card_tx(spark, sf).select(*TX_KEYS)
    return ordering.with_row_index(keys, TX_KEYS).select("transaction_id", "row_idx")


TRAIN_TEST = [(0.8, "train"), (1.0, "test")]
TRAIN_VALIDATION_TEST = [(0.6, "train"), (0.8, "validation"), (1.0, "test")]


def split_tx(spark, sf, cuts=TRAIN_TEST, name="split") -> DataFrame:
    return ordering.chronological_split(views.card_tx(spark, sf), TX_KEYS, cuts, name)


@query("chrono_split", "SELECT transaction_id, split, split3 FROM splits", views=("splits",))
def chrono_split(spark, sf):
    both = ordering.chronological_split(
        split_tx(spark, sf), TX_KEYS, TRAIN_VALIDATION_TEST, "split3"
    )
    return both.select("transaction_id", "split", "split3")


@query(
    "row_slice",
    """SELECT transaction_id, amount, row_idx FROM indexed
    WHERE row_idx >= floor(total * 0.8e0) AND row_idx < floor(total * 0.8e0) + 10000""",
    views=("indexed",),
)
def row_slice(spark, sf):
    """The replay slice: from the start of the test rows, 10,000 rows."""
    tx = views.card_tx(spark, sf).select(*TX_KEYS, "amount")
    start = int(tx.count() * 0.8)
    rows = ordering.row_slice(tx, TX_KEYS, start, 10_000)
    return rows.select("transaction_id", "amount", "row_idx")


@query(
    "ordered_preview",
    "SELECT row_id, V1, V2, Amount, is_fraud FROM wide ORDER BY row_id LIMIT 5",
    views=("wide",),
)
def ordered_preview(spark, sf):
    rows = views.wide_tx(spark, sf).select("row_id", "V1", "V2", "Amount", "is_fraud")
    return ordering.first_rows(rows, ["row_id"], 5)


@query(
    "fraud_spread",
    """SELECT min(row_idx) FILTER (is_fraud = 1) AS first_position,
      max(row_idx) FILTER (is_fraud = 1) AS last_position,
      count(*) FILTER (is_fraud = 1 AND row_idx < total // 2) AS first_half,
      count(*) FILTER (is_fraud = 1 AND row_idx >= total // 2) AS second_half
    FROM indexed""",
    views=("indexed",),
)
def fraud_spread(spark, sf):
    return ordering.label_positions(views.card_tx(spark, sf), TX_KEYS, "is_fraud")
