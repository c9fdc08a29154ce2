"""Alerts: selection, messages, key figures, series, flows, cards, runs and replays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.functions.columns import class_name, count_if, flag
from fraudlens.operators.evaluate import confusion_aggregates, with_prf
from fraudlens.operators.ordering import first_rows, last_rows, running_totals
from fraudlens.schemas import COORDINATES, COUNTRIES, DEFAULT_THRESHOLD
from fraudlens.session import stage

KEPT_CARD_ALERTS = 5000
KEPT_RUN_ALERTS = 2000
KEPT_RUN_STATS = 5000


# -- from scores to alerts -------------------------------------------------------------------


def flagged(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Rows whose score reaches the threshold."""
    return scored.filter(flag(F.col("score"), threshold))


def card_alerts(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Flagged card rows in the alert layout."""
    return flagged(scored, threshold).select(
        "transaction_id",
        "card_id",
        "amount",
        "merchant_category",
        "country",
        "home_country",
        F.round("score", 4).alias("score"),
        "event_time",
        F.round("latency_ms", 1).alias("latency_ms"),
    )


def wide_alerts(
    scored: DataFrame, run_id: int | Column, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Flagged wide rows in the alert layout, stamped with the run."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    return flagged(scored, threshold).select(
        F.lit("alert").alias("type"),
        run.cast("bigint").alias("run_id"),
        "row_id",
        "Amount",
        F.round("score", 4).alias("score"),
        "is_fraud",
        F.round("latency_ms", 1).alias("latency_ms"),
    )


def to_messages(df: DataFrame, key: str | Column) -> DataFrame:
    """Rows as keyed JSON messages (S10); NULL fields are left out of the text."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def alert_slice(
    alerts: DataFrame,
    min_score: float = 0.5,
    countries: Sequence[str] | None = None,
    merchants: Sequence[str] | None = None,
) -> DataFrame:
    """Alerts of at least a score, in the chosen countries and merchant categories."""
    condition = F.col("score") >= F.lit(float(min_score))
    if countries is not None:
        condition = condition & F.col("country").isin(list(countries))
    if merchants is not None:
        condition = condition & F.col("merchant_category").isin(list(merchants))
    return alerts.filter(condition)


# -- key figures and tables ------------------------------------------------------------------


def alert_kpis(alerts: DataFrame) -> DataFrame:
    """Alerts, amount, mean latency and score, alerts of the last minute (A5)."""
    newest = alerts.agg(F.max("event_time")).scalar()
    recent = F.col("event_time") > newest - F.expr("interval 1 minute")
    return alerts.withColumn("recent", recent).agg(
        F.count(F.lit(1)).alias("alerts"),
        F.round(F.sum("amount"), 2).alias("amount"),
        F.round(F.avg("latency_ms"), 6).alias("mean_latency_ms"),
        F.round(F.avg("score"), 6).alias("mean_score"),
        count_if(F.col("recent")).alias("last_minute"),
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def top_cards(alerts: DataFrame, k: int = 10) -> DataFrame:
    """The cards with most alerts."""
    return frequencies(alerts, "card_id").limit(k)


def flow_matrix(alerts: DataFrame, countries: Sequence[str] = tuple(COUNTRIES)) -> DataFrame:
    """Alerts by home country (rows) and transaction country (columns), 0 where none.

    Alerts to any other or no country are counted in ``other``.
    """
    known = F.when(F.col("country").isin(list(countries)), F.col("country")).otherwise("other")
    columns = [*countries, "other"]
    matrix = alerts.withColumn("country", known).groupBy("home_country").pivot("country", columns).count()
    return matrix.na.fill(0, columns)


def coordinates(spark: SparkSession) -> DataFrame:
    rows = [
        F.struct(F.lit(code).alias("code"), F.lit(lon).alias("lon"), F.lit(lat).alias("lat"))
        for code, lon, lat in COORDINATES
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def foreign_flows(alerts: DataFrame) -> DataFrame:
    """Alerts per (home, foreign country) with both coordinates.

    Countries without coordinates are left out.  Rows are counted before the lookups; the
    coordinate table is a constant of eight rows.
    """
    flows = (
        alerts.filter(F.col("home_country") != F.col("country"))
        .groupBy("home_country", "country")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    places = coordinates(alerts.sparkSession)
    source = places.select(
        F.col("code").alias("home_country"), F.col("lon").alias("src_lon"),
        F.col("lat").alias("src_lat"),
    )
    target = places.select(
        F.col("code").alias("country"), F.col("lon").alias("dst_lon"),
        F.col("lat").alias("dst_lat"),
    )
    return flows.join(F.broadcast(source), "home_country").join(F.broadcast(target), "country")


def card_kpis(alerts: DataFrame) -> DataFrame:
    """Alerts, suspect amount and highest score per card (A10)."""
    return alerts.groupBy("card_id").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.round(F.sum("amount"), 2).alias("amount"),
        F.max("score").alias("max_score"),
    )


def card_history(alerts: DataFrame, card_id: str | Column) -> DataFrame:
    """All alerts of one card, newest first (P10)."""
    card = F.lit(card_id) if isinstance(card_id, str) else card_id
    return (
        alerts.filter(F.col("card_id") == card)
        .orderBy(F.desc("event_time"), "transaction_id")
        .select("event_time", "amount", "merchant_category", "country", "home_country", "score")
    )


def busiest_card(alerts: DataFrame) -> Column:
    """The card with most alerts, as a scalar subquery."""
    return top_cards(alerts, 1).select("card_id").scalar()


def latest_alerts(alerts: DataFrame, k: int = 15) -> DataFrame:
    """The newest alerts."""
    return first_rows(alerts, [F.desc("event_time"), "transaction_id"], k)


def retained_alerts(
    alerts: DataFrame, n: int = KEPT_CARD_ALERTS, key: str = "transaction_id"
) -> DataFrame:
    """The newest ``n`` alerts."""
    return last_rows(alerts, ["event_time", key], n)


def retained_statistics(stats: DataFrame, n: int = KEPT_RUN_STATS) -> DataFrame:
    """The last ``n`` statistics messages of a run."""
    return last_rows(stats, ["processed"], n)


def with_class_names(alerts: DataFrame) -> DataFrame:
    """Label names of the explorer and of the live alert list."""
    label = F.col("is_fraud")
    return alerts.withColumns(
        {
            "classe": class_name(label),
            "alert_classe": F.when(label == 1, "Fraude").when(label == 0, "Fausse alerte"),
        }
    )


# -- series ----------------------------------------------------------------------------------


def interval_series(alerts: DataFrame, seconds: int = 30) -> DataFrame:
    """Alerts and mean latency per interval between the first and the last alert.

    Intervals without alerts count 0 and have no latency.
    """
    step = f"{seconds} seconds"
    found = (
        alerts.groupBy(F.window("event_time", step).start.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("alerts"), F.avg("latency_ms").alias("mean_latency_ms"))
    )
    found = stage(found, "intervals")  # one row per interval with alerts, read for the ends and for the join
    # One row per day first, dealt over tasks, then the intervals of each day: no array and no
    # task spans the whole series.
    ends = found.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    one_day = F.expr("interval 1 day")
    days = ends.select(
        "lo", "hi", F.explode(F.sequence(F.date_trunc("day", "lo"), F.col("hi"), one_day)).alias("d")
    )
    tasks = int(alerts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    days = days.repartition(tasks, "d")
    first = F.greatest("lo", "d")
    last = F.least(F.col("hi"), F.col("d") + one_day - F.expr(f"interval {step}"))
    spine = days.select(F.explode(F.sequence(first, last, F.expr(f"interval {step}"))).alias("bucket"))
    return spine.join(found, "bucket", "left").select(
        "bucket",
        F.coalesce("alerts", F.lit(0)).alias("alerts"),
        F.round("mean_latency_ms", 6).alias("mean_latency_ms"),
    )


def replay_totals(
    indexed: DataFrame,
    batch: int,
    threshold: float = DEFAULT_THRESHOLD,
    by: Sequence[str] = (),
    index: str = "row_idx",
) -> DataFrame:
    """Running counters after every ``batch`` rows of a replay.

    ``lat_win`` is the mean latency of the batch alone.
    """
    cells = confusion_aggregates(F.col("is_fraud"), F.col("score"), threshold)
    per_batch = indexed.groupBy(*by, F.floor(F.col(index) / batch).alias("batch")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("event_time").alias("last_time"),
        F.round(F.avg("latency_ms"), 1).alias("lat_win"),
        *[cell.alias(f"{name}_n") for name, cell in cells.items()],
    )
    totals = {"processed": ("sum", F.col("n"))}
    totals |= {name: ("sum", F.col(f"{name}_n")) for name in cells}
    running = running_totals(per_batch, by=by, order=["batch"], totals=totals)
    return with_alert_count(
        running.select(*by, "batch", "processed", *cells, "lat_win", "last_time")
    )


def with_alert_count(stats: DataFrame) -> DataFrame:
    """Alerts raised so far: detected plus false."""
    return stats.withColumn("alerts", F.col("tp") + F.col("fp"))


def run_statistics(totals: DataFrame) -> DataFrame:
    """Replay counters per run as statistics messages."""
    return totals.select(
        F.lit("stats").alias("type"),
        F.col("run_id").cast("bigint").alias("run_id"),
        F.unix_timestamp("last_time").cast("double").alias("ts"),
        "processed",
        "tp",
        "fp",
        "fn",
        "tn",
        "lat_win",
    )


def newest_run(messages: DataFrame, kind: str | None = None) -> DataFrame:
    """Messages of the newest run, optionally of one type."""
    newest = messages.agg(F.max("run_id")).scalar()
    rows = messages.filter(F.col("run_id") == newest)
    return rows if kind is None else rows.filter(F.col("type") == kind)


def run_series_long(stats: DataFrame) -> DataFrame:
    """Alerts, detected and missed frauds against processed rows, one row per point."""
    named = with_alert_count(stats).select(
        "processed",
        F.col("alerts").alias("alertes"),
        F.col("tp").alias("fraudes détectées"),
        F.col("fn").alias("fraudes manquées"),
    )
    series = ["alertes", "fraudes détectées", "fraudes manquées"]
    return named.unpivot(["processed"], series, "serie", "n")


def live_run_view(stats: DataFrame) -> DataFrame:
    """The newest run's last statistics with running precision and recall."""
    current = newest_run(stats)
    fields = ["run_id", "processed", "tp", "fp", "fn", "tn", "lat_win"]
    last = current.agg(F.max_by(F.struct(*fields), F.col("processed")).alias("s")).select("s.*")
    return with_prf(with_alert_count(last)).drop("f1")


def run_rows(scored: DataFrame, by: str, order: Sequence[str], index: str = "row_idx") -> DataFrame:
    """Position of every row within its run."""
    return running_totals(
        scored, by=[by], order=order, totals={index: ("sum", F.lit(1))}, inclusive=False
    )


