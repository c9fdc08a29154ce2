"""Queries over alerts: key figures, tables, series, cards, runs and replays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions.columns import elapsed_ms, iso_to_timestamp, timestamp_to_iso
from fraudlens.operators import alerts as al
from fraudlens.operators import ordering, quality
from fraudlens.plans.layers import TX_KEYS, bronze, split_tx
from fraudlens.plans.registry import query
from fraudlens.schemas import CARD_ALERT, COORDINATES, COUNTRIES
from fraudlens.sources import views

_ALERT_COLUMNS = (
    "transaction_id, card_id, amount, merchant_category, country, home_country, "
    "round(score, 4) AS score, event_time, round(latency_ms, 1) AS latency_ms"
)
_CARD_COLUMNS = "event_time, amount, merchant_category, country, home_country, score"
REPLAY_BATCH = 250


@query(
    "alert_filter",
    f"""SELECT {_ALERT_COLUMNS} FROM alerts
    WHERE score >= 0.9 AND country IN ('MA', 'FR', 'ES') AND merchant_category IN ('click', 'purchase')""",
    views=("alerts",),
)
def alert_filter(spark, sf):
    rows = al.card_alerts(views.alerts(spark, sf))
    return al.alert_slice(rows, 0.9, ["MA", "FR", "ES"], ["click", "purchase"])


@query(
    "alert_kpis",
    """SELECT count(*) AS alerts, round(sum(amount), 2) AS amount,
      round(avg(latency_ms), 6) AS mean_latency_ms, round(avg(score), 6) AS mean_score,
      count(*) FILTER (event_time > newest - INTERVAL 1 MINUTE) AS last_minute
    FROM alerts, (SELECT max(event_time) AS newest FROM alerts) m""",
    views=("alerts",),
)
def alert_kpis(spark, sf):
    return al.alert_kpis(views.alerts(spark, sf))


def _frequency(name: str, column: str):
    sql = f"SELECT {column}, count(*) AS n FROM alerts GROUP BY {column}"

    @query(name, sql, views=("alerts",))
    def frequency(spark, sf):
        return al.frequencies(views.alerts(spark, sf), column)


_frequency("freq_merchant", "merchant_category")
_frequency("freq_country", "country")
_frequency("freq_card", "card_id")


@query(
    "top_cards",
    "SELECT card_id, count(*) AS n FROM alerts GROUP BY card_id ORDER BY n DESC, card_id LIMIT 10",
    views=("alerts",),
)
def top_cards(spark, sf):
    return al.top_cards(views.alerts(spark, sf))


@query(
    "flow_matrix",
    "SELECT home_country, "
    + ", ".join(f'count(*) FILTER (country = \'{c}\') AS "{c}"' for c in COUNTRIES)
    + ", count(*) FILTER (country IS NULL OR country NOT IN ("
    + ", ".join(f"'{c}'" for c in COUNTRIES)
    + ")) AS other FROM alerts GROUP BY home_country",
    views=("alerts",),
)
def flow_matrix(spark, sf):
    return al.flow_matrix(views.alerts(spark, sf))


_PLACES = ", ".join(f"('{code}', {lon}e0, {lat}e0)" for code, lon, lat in COORDINATES)


@query(
    "flows_geo",
    f"""SELECT home_country, country, count(*) AS n, s.lon AS src_lon, s.lat AS src_lat,
      d.lon AS dst_lon, d.lat AS dst_lat
    FROM alerts JOIN (VALUES {_PLACES}) s(code, lon, lat) ON s.code = home_country
      JOIN (VALUES {_PLACES}) d(code, lon, lat) ON d.code = country
    WHERE home_country <> country GROUP BY ALL""",
    views=("alerts",),
)
def flows_geo(spark, sf):
    return al.foreign_flows(views.alerts(spark, sf))


@query(
    "card_kpis",
    """SELECT card_id, count(*) AS alerts, round(sum(amount), 2) AS amount, max(score) AS max_score
    FROM alerts GROUP BY card_id""",
    views=("alerts",),
)
def card_kpis(spark, sf):
    return al.card_kpis(views.alerts(spark, sf))


@query(
    "card_drilldown",
    f"""SELECT {_CARD_COLUMNS} FROM alerts WHERE card_id =
      (SELECT card_id FROM alerts GROUP BY card_id ORDER BY count(*) DESC, card_id LIMIT 1)""",
    views=("alerts",),
)
def card_drilldown(spark, sf):
    rows = views.alerts(spark, sf)
    return al.card_history(rows, al.busiest_card(rows))


@query(
    "alert_rate",
    """SELECT t.n AS transactions, a.n AS alerts, round(100.0e0 * a.n / nullif(t.n, 0), 4) AS alert_rate
    FROM (SELECT count(*) AS n FROM tx_raw) t, (SELECT count(*) AS n FROM alerts) a""",
    views=("tx_raw", "alerts"),
)
def alert_rate(spark, sf):
    depth = quality.topic_depth(bronze(spark, sf, offsets=True)).select(F.col("depth").alias("n"))
    raised = views.alerts(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    return quality.alert_rate(depth, raised)


@query(
    "class_labels",
    """SELECT transaction_id, CASE WHEN is_fraud = 1 THEN 'Fraude' WHEN is_fraud = 0 THEN 'Normale' END AS classe,
      CASE WHEN is_fraud = 1 THEN 'Fraude' WHEN is_fraud = 0 THEN 'Fausse alerte' END AS alert_classe
    FROM alerts""",
    views=("alerts",),
)
def class_labels(spark, sf):
    rows = al.with_class_names(views.alerts(spark, sf))
    return rows.select("transaction_id", "classe", "alert_classe")


@query(
    "latency",
    """SELECT transaction_id, round((epoch_us(event_time + to_milliseconds(CAST(latency_ms AS BIGINT)))
      - epoch_us(event_time)) / 1000.0e0, 1) AS latency_ms FROM tx""",
    views=("tx",),
)
def latency(spark, sf):
    tx = views.card_tx(spark, sf)
    scored_at = F.timestamp_micros(
        F.unix_micros("event_time") + (F.col("latency_ms") * 1000).cast("bigint")
    )
    timed = tx.select("transaction_id", "event_time", scored_at.alias("scored_at"))
    return timed.select(
        "transaction_id",
        elapsed_ms(F.col("event_time"), F.col("scored_at")).alias("latency_ms"),
    )


@query(
    "alerts_out", f"SELECT {_ALERT_COLUMNS} FROM tx WHERE score >= 0.5", views=("tx",)
)
def alerts_out(spark, sf):
    return al.card_alerts(views.card_tx(spark, sf))


@query(
    "wide_alerts_out",
    """SELECT 'alert' AS type, CAST(run_id AS BIGINT) AS run_id, event_id AS row_id, amount AS Amount,
      score, is_fraud, latency_ms FROM tx WHERE score >= 0.7""",
    views=("tx",),
)
def wide_alerts_out(spark, sf):
    rows = views.card_tx(spark, sf).withColumnsRenamed({"event_id": "row_id", "amount": "Amount"})
    return al.wide_alerts(rows, F.col("run_id"), threshold=0.7)


@query(
    "alert_json",
    f"SELECT card_id AS key, {_ALERT_COLUMNS} FROM tx WHERE score >= 0.5",
    views=("tx",),
)
def alert_json(spark, sf):
    """Alerts written as messages and decoded again."""
    rows = al.card_alerts(views.card_tx(spark, sf))
    rows = rows.withColumn("event_time", timestamp_to_iso(F.col("event_time")))
    messages = al.to_messages(rows, "card_id")
    decoded = messages.select(
        "key", F.inline(F.array(F.from_json("value", CARD_ALERT))).alias(*CARD_ALERT.names)
    )
    return decoded.withColumn("event_time", iso_to_timestamp(F.col("event_time")))


@query(
    "alert_retention",
    "SELECT transaction_id, event_time, score FROM tx WHERE score >= 0.5"
    " ORDER BY event_time DESC, transaction_id DESC LIMIT 5000",
    views=("tx",),
)
def alert_retention(spark, sf):
    rows = al.flagged(views.card_tx(spark, sf)).select("transaction_id", "event_time", "score")
    return al.retained_alerts(rows)


@query(
    "run_retention",
    """SELECT run_id, transaction_id, event_time FROM tx
    WHERE score >= 0.5 AND run_id = (SELECT max(run_id) FROM tx WHERE score >= 0.5)
    ORDER BY event_time DESC, transaction_id DESC LIMIT 2000""",
    views=("tx",),
)
def run_retention(spark, sf):
    rows = al.flagged(views.card_tx(spark, sf)).select("run_id", "transaction_id", "event_time")
    return al.retained_alerts(al.newest_run(rows), al.KEPT_RUN_ALERTS)


@query(
    "latest_alerts",
    f"SELECT transaction_id, {_CARD_COLUMNS}, card_id, latency_ms FROM alerts"
    " ORDER BY event_time DESC, transaction_id LIMIT 15",
    views=("alerts",),
)
def latest_alerts(spark, sf):
    rows = al.latest_alerts(views.alerts(spark, sf))
    columns = _CARD_COLUMNS.split(", ")
    return rows.select("transaction_id", *columns, "card_id", "latency_ms")


# -- series ----------------------------------------------------------------------------------

_SERIES_SQL = """SELECT bucket, {value}
FROM (SELECT unnest(generate_series(min(b), max(b), INTERVAL 30 SECONDS)) AS bucket
      FROM (SELECT time_bucket(INTERVAL 30 SECONDS, event_time) AS b FROM alerts) x) spine
  LEFT JOIN (SELECT time_bucket(INTERVAL 30 SECONDS, event_time) AS bucket, count(*) AS n,
      avg(latency_ms) AS mean_latency FROM alerts GROUP BY 1) found USING (bucket)"""


@query(
    "alerts_30s",
    _SERIES_SQL.format(value="coalesce(n, 0) AS alerts"),
    views=("alerts",),
)
def alerts_30s(spark, sf):
    return al.interval_series(views.alerts(spark, sf)).select("bucket", "alerts")


@query(
    "latency_30s",
    _SERIES_SQL.format(value="round(mean_latency, 6) AS mean_latency_ms"),
    views=("alerts",),
)
def latency_30s(spark, sf):
    return al.interval_series(views.alerts(spark, sf)).select("bucket", "mean_latency_ms")


# -- runs and replays ------------------------------------------------------------------------


def run_stats(spark, sf) -> DataFrame:
    """Statistics messages of both runs, one per 250 rows."""
    rows = al.run_rows(views.card_tx(spark, sf), "run_id", ["event_time", "event_id"])
    return al.run_statistics(al.replay_totals(rows, REPLAY_BATCH, by=["run_id"]))


@query("run_statistics", "SELECT * REPLACE (CAST(run_id AS BIGINT) AS run_id) FROM stats", views=("stats",))
def run_statistics(spark, sf):
    return run_stats(spark, sf)


@query(
    "run_demux",
    """SELECT 'alert' AS type, CAST(run_id AS BIGINT) AS run_id, event_id AS row_id, amount AS Amount,
      CAST(NULL AS BIGINT) AS processed FROM alerts WHERE run_id = (SELECT max(run_id) FROM tx)
    UNION ALL SELECT type, run_id, NULL, NULL, processed FROM stats
      WHERE run_id = (SELECT max(run_id) FROM tx)""",
    views=("alerts", "stats"),
)
def run_demux(spark, sf):
    rows = views.alerts(spark, sf).withColumnsRenamed({"event_id": "row_id", "amount": "Amount"})
    raised = al.wide_alerts(rows, F.col("run_id"))
    messages = raised.unionByName(run_stats(spark, sf), allowMissingColumns=True)
    return al.newest_run(messages).select("type", "run_id", "row_id", "Amount", "processed")


@query(
    "run_series_long",
    """SELECT processed, serie, n FROM (
      SELECT processed, tp + fp AS "alertes", tp AS "fraudes détectées", fn AS "fraudes manquées"
      FROM stats WHERE run_id = (SELECT max(run_id) FROM tx)) s
    UNPIVOT (n FOR serie IN ("alertes", "fraudes détectées", "fraudes manquées"))""",
    views=("stats",),
)
def run_series_long(spark, sf):
    return al.run_series_long(al.newest_run(run_stats(spark, sf), "stats"))


@query(
    "live_run_view",
    """SELECT CAST(run_id AS BIGINT) AS run_id, processed, tp, fp, fn, tn, lat_win, tp + fp AS alerts,
      round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS precision,
      round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall
    FROM stats WHERE run_id = (SELECT max(run_id) FROM tx) ORDER BY processed DESC LIMIT 1""",
    views=("stats",),
)
def live_run_view(spark, sf):
    return al.live_run_view(run_stats(spark, sf))


@query(
    "replay_cumulative",
    """SELECT batch, CAST(sum(n) OVER w AS BIGINT) AS processed, CAST(sum(tp) OVER w AS BIGINT) AS tp,
      CAST(sum(fp) OVER w AS BIGINT) AS fp, CAST(sum(fn) OVER w AS BIGINT) AS fn,
      CAST(sum(tn) OVER w AS BIGINT) AS tn, CAST(sum(tp + fp) OVER w AS BIGINT) AS alerts
    FROM (SELECT (row_idx - CAST(floor(total * 0.8e0) AS BIGINT)) // 250 AS batch, count(*) AS n,
        count(*) FILTER (score >= 0.5 AND is_fraud = 1) AS tp,
        count(*) FILTER (score >= 0.5 AND is_fraud = 0) AS fp,
        count(*) FILTER (score < 0.5 AND is_fraud = 1) AS fn,
        count(*) FILTER (score < 0.5 AND is_fraud = 0) AS tn
      FROM splits WHERE split = 'test' GROUP BY batch) b
    WINDOW w AS (ORDER BY batch)""",
    views=("splits",),
)
def replay_cumulative(spark, sf):
    test = split_tx(spark, sf).filter("split = 'test'")
    test = test.select(*TX_KEYS, "is_fraud", "score", "latency_ms")
    totals = al.replay_totals(ordering.with_row_index(test, TX_KEYS), REPLAY_BATCH)
    return totals.drop("lat_win", "last_time")


@query(
    "replay_latest_hits",
    """SELECT transaction_id, amount, score, CASE WHEN is_fraud = 1 THEN 'Fraude' WHEN is_fraud = 0 THEN 'Normale' END AS classe
    FROM splits WHERE split = 'test' AND score >= 0.5 ORDER BY event_time DESC, transaction_id LIMIT 12""",
    views=("splits",),
)
def replay_latest_hits(spark, sf):
    hits = al.flagged(split_tx(spark, sf).filter("split = 'test'"))
    rows = al.with_class_names(al.latest_alerts(hits, 12))
    return rows.select("transaction_id", "amount", "score", "classe")
