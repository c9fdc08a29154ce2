"""Message and table schemas, vocabularies and model input lists."""

from __future__ import annotations

from pyspark.sql import types as T

# Vocabularies, coordinates (lon, lat) and decision parameters.
COUNTRIES = ["MA", "FR", "ES", "DE", "US", "GB", "IT", "AE"]
MERCHANTS = ["atm", "electronics", "fuel", "grocery", "online_shop", "restaurant", "travel"]
COORDINATES = [
    ("MA", -7.6, 33.6),
    ("FR", 2.3, 48.9),
    ("ES", -3.7, 40.4),
    ("DE", 13.4, 52.5),
    ("US", -77.0, 38.9),
    ("GB", -0.1, 51.5),
    ("IT", 12.5, 41.9),
    ("AE", 55.3, 25.2),
]
DEFAULT_THRESHOLD = 0.5
DEFAULT_ALERT_COST = 5.0
REPORT_THRESHOLDS = [0.1, 0.3, 0.5, 0.7, 0.9]

WIDE_FEATURES = [f"V{i}" for i in range(1, 29)] + ["Amount"]
CARD_NUMERIC_FEATURES = ["amount", "amount_ratio", "tx_1h", "is_foreign"]


_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
    "map<string,double>": T.MapType(T.StringType(), T.DoubleType()),
}


def _schema(columns: str) -> T.StructType:
    fields = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


CARD_TX = _schema(
    "transaction_id string, card_id string, amount double, merchant_category string, "
    "country string, home_country string, event_time string, is_fraud int"
)
WIDE_TX = _schema(
    "row_id bigint, "
    + ", ".join(f"{c} double" for c in WIDE_FEATURES)
    + ", is_fraud int, event_time string"
)
TOPIC_RECORD = _schema(
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
ENVELOPE = _schema(
    "key string, value string, topic string, partition int, offset bigint, "
    "kafka_timestamp timestamp"
)
MESSAGE = _schema("key string, value string")
GOLD_COLUMNS = [
    "transaction_id",
    "card_id",
    "event_time",
    "amount",
    "merchant_category",
    "n_prev",
    "amount_ratio",
    "tx_1h",
    "sec_since_prev",
    "is_foreign",
    "is_fraud",
]
CARD_ALERT = _schema(
    "transaction_id string, card_id string, amount double, merchant_category string, "
    "country string, home_country string, score double, event_time string, latency_ms double"
)
WIDE_ALERT = _schema(
    "type string, run_id bigint, row_id bigint, Amount double, score double, is_fraud int, "
    "latency_ms double"
)
RUN_STATS = _schema(
    "type string, run_id bigint, ts double, processed bigint, tp bigint, fp bigint, fn bigint, "
    "tn bigint, lat_win double"
)
RUN_MESSAGE = T.StructType(
    WIDE_ALERT.fields + [f for f in RUN_STATS.fields if f.name not in WIDE_ALERT.names]
)
RUN_BEAT = _schema(
    "run_id bigint, ts double, n bigint, processed bigint, tp bigint, fp bigint, fn bigint, tn bigint, "
    "lat_win double, lat_sum double, lat_n bigint"
)
RAW_CSV = _schema(", ".join(f"{c} double" for c in WIDE_FEATURES) + ", Class int")
TRAINING_RUN = _schema(
    "experiment string, run_id string, start_time timestamp, params map<string,string>, "
    "metrics map<string,double>"
)
