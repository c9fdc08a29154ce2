"""Command line: ``spark-submit -m fraudlens.jobs <job> ...`` or ``python -m fraudlens.jobs``.

Every job reads tables and writes tables; the report jobs print small results.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.functions.columns import iso_to_timestamp
from fraudlens.operators import alerts as al
from fraudlens.operators import evaluate, explore, features, models, ordering, quality, silver
from fraudlens.schemas import (
    CARD_ALERT,
    DEFAULT_ALERT_COST,
    DEFAULT_THRESHOLD,
    ENVELOPE,
    MESSAGE,
    REPORT_THRESHOLDS,
    RUN_MESSAGE,
    WIDE_FEATURES,
)
from fraudlens.session import build_session, drop_staged, stage
from fraudlens.sources import replay, runs, tables, topics
from fraudlens.streaming import intake, layers, monitor, scoring, view

JOBS: dict[str, tuple[Callable, list[str]]] = {}

OPTIONS = {
    "in": {"help": "input table"},
    "out": {"help": "output table or topic folder"},
    "checkpoint": {"help": "checkpoint folder of the stream"},
    "format": {"default": "parquet", "help": "table format: parquet or delta"},
    "topic-format": {"default": "parquet", "help": "kafka, or the file format of a topic folder"},
    "servers": {"help": "broker addresses"},
    "topic": {"help": "topic name, or folder of a topic kept as files"},
    "alert-topic": {"help": "topic or folder for alerts"},
    "starting": {
        "choices": ["earliest", "latest"],
        "help": "by default latest for scorers with a trigger interval, earliest for all other jobs",
    },
    "cap": {"type": int, "help": "records (or files) per trigger"},
    "every": {"help": "trigger interval; without it the job drains its source and stops"},
    "model": {"help": "model folder"},
    "runs": {"help": "run log table"},
    "threshold": {"type": float, "default": DEFAULT_THRESHOLD},
    "alert-cost": {"type": float, "default": DEFAULT_ALERT_COST},
    "run-id": {"type": int, "help": "number of the run; by default the second it starts in"},
    "keep": {"type": int, "help": "only the newest rows, so many; by default all"},
    "versions": {"type": int, "help": "finished versions of the table to keep; by default all"},
    "country": {"nargs": "*", "help": "only alerts of these countries"},
    "merchant": {"nargs": "*", "help": "only alerts of these merchant categories"},
    "bronze": {"help": "bronze table"},
    "silver": {"help": "silver table"},
    "gold": {"help": "gold table"},
    "experiment": {"default": "fraud-detection", "help": "name in the run log"},
    "state": {
        "choices": ["group", "transform", "split"], "default": "group",
        "help": "live history per card in one call (two ways), or split over keys with state that ends",
    },
    "copies": {
        "choices": ["first", "lowest"], "default": "first",
        "help": "of copies keep the first to arrive, or the one of lowest offset, held until its time has passed",
    },
    "hold": {"type": int, "default": 86_400, "help": "seconds within which copies can come"},
    "delay": {"default": "1 day", "help": "how late a row may come"},
    "seconds": {"type": int, "default": 30, "help": "length of an interval"},
    "batch": {"type": int, "default": 250, "help": "rows between two points of a replay"},
    "sample": {"type": int, "default": 2000, "help": "rows of the negative class in a sample"},
    "bins": {"type": int, "default": 50, "help": "bins of a histogram"},
    "start": {"type": int, "default": 0},
    "limit": {"type": int, "default": 0},
}


def job(name: str, *options: str):
    def register(function: Callable) -> Callable:
        JOBS[name] = (function, list(options))
        return function

    return register


def _show(title: str, df: DataFrame, rows: int = 20) -> None:
    print(title)
    df.show(rows, truncate=False)


def _topic(spark: SparkSession, a, starting: str = "earliest") -> DataFrame:
    return topics.read_topic(
        spark, a.topic_format, a.topic, a.servers, a.topic, a.starting or starting, a.cap,
        checkpoint=a.checkpoint,
    )


def _live(a) -> str:
    """A scorer that keeps running begins with new messages, one that drains takes what is there."""
    return "latest" if a.every else "earliest"


_TOPIC = ("topic", "topic-format", "servers", "starting", "cap", "every", "checkpoint")


# -- layers ----------------------------------------------------------------------------------


@job("replay", "in", "out", "topic", "topic-format", "servers", "start", "limit")
def replay_file(spark, a):
    """Send a slice of the raw CSV to a topic."""
    messages = replay.replay_messages(spark, getattr(a, "in"), a.start, a.limit)
    writer = messages.write.format(a.topic_format).mode("append")
    if a.topic_format == "kafka":
        writer.option("kafka.bootstrap.servers", a.servers).option("topic", a.topic).save()
    else:
        writer.save(a.out)


@job("bronze", "out", "format", *_TOPIC)
def bronze(spark, a):
    query = layers.land_bronze(_topic(spark, a), a.out, a.checkpoint, a.format, a.every)
    topics.drain(query)


@job("silver", "in", "out", "format", "checkpoint", "every")
def silver_card(spark, a):
    query = layers.refine_silver(
        spark, getattr(a, "in"), a.out, a.checkpoint, a.format, a.every
    )
    topics.drain(query)


@job("silver-wide", "in", "out", "format", "versions")
def silver_wide(spark, a):
    rows = silver.silver_wide(tables.read_latest(spark, getattr(a, "in"), a.format))
    tables.replace_table(rows, a.out, a.format, a.versions)
    written = tables.read_current(spark, a.out, a.format)
    _show("rows and frauds", explore.overview(written))
    columns = ["row_id", "V1", "V2", "Amount", "is_fraud"]
    _show("first rows", ordering.first_rows(written.select(*columns), ["row_id"], 5))


@job("gold", "in", "out", "format", "versions")
def gold(spark, a):
    rows = features.card_features(tables.read_latest(spark, getattr(a, "in"), a.format))
    tables.replace_table(rows, a.out, a.format, a.versions)
    written = tables.read_current(spark, a.out, a.format)
    _show("features by label", quality.feature_profile(written))


# -- checks ----------------------------------------------------------------------------------


@job("check-bronze", "in", "format", "topic", "topic-format", "servers")
def check_bronze(spark, a):
    """With --topic the rows of every partition are also held against the topic they came from."""
    rows = tables.read_latest(spark, getattr(a, "in"), a.format)
    _show("partitions", quality.partition_offsets(rows))
    _show("missing and repeated offsets", quality.offset_ranges(rows).orderBy("partition", "first_offset"))
    if a.topic:
        source = topics.read_topic_now(spark, a.topic_format, a.topic, a.servers)
        manifest = source.groupBy("partition").agg(F.count(F.lit(1)).alias("source_rows"))
        _show("reconciliation", quality.reconcile(manifest, rows).orderBy("partition"))
    _show("labels", quality.raw_label_counts(rows))
    _show("topics", quality.topic_depth(rows))
    _show("messages", rows.select("key", "value"), 3)


@job("check-silver", "in", "format")
def check_silver(spark, a):
    rows = tables.read_latest(spark, getattr(a, "in"), a.format)
    _show("profile", quality.table_profile(rows))
    _show("columns", quality.column_profile(rows), 50)
    _show("frauds", rows.filter("is_fraud = 1"), 3)


@job("check-gold", "in", "format")
def check_gold(spark, a):
    rows = tables.read_latest(spark, getattr(a, "in"), a.format)
    _show("profile", quality.table_profile(rows))
    _show("features by label", quality.feature_profile(rows))


@job("check-csv", "in")
def check_csv(spark, a):
    rows = stage(replay.replay_rows(spark, getattr(a, "in")).drop("event_time"), "csv")
    _show("first rows", ordering.first_rows(rows.select("row_id", "V1", "V2", "Amount"), ["row_id"], 5))
    _show("amounts", explore.describe(rows, label=None))
    _show("frauds", ordering.label_positions(rows, ["row_id"], "is_fraud"))


# -- models ----------------------------------------------------------------------------------


def _train(spark, a, rows, keys, fit, params, experiment, amount) -> None:
    cuts = [(0.8, "train"), (1.0, "test")]
    split = ordering.chronological_split(rows, keys, cuts)
    _show("split", evaluate.class_balance(split))
    model = fit(split.filter("split = 'train'"))
    runs.save_model(model, a.model)
    scored = stage(models.score(split.filter("split = 'test'"), model), "scored")
    _show("test", models.evaluate_and_log(scored, a.runs, experiment, params))
    _show("thresholds", evaluate.threshold_table(scored, REPORT_THRESHOLDS))
    curves = {
        "precision-recall": evaluate.precision_recall_curve(scored),
        "cost": evaluate.cost_curve(scored, evaluate.threshold_grid(0.01), a.alert_cost, amount=amount),
    }
    curves = {name: stage(curve, name) for name, curve in curves.items()}
    _show("precision and recall", ordering.first_rows(curves["precision-recall"], [F.desc_nulls_last("threshold")], 20))
    _show("costs", curves["cost"].orderBy("threshold"), 100)
    _show("cheapest threshold", evaluate.cheapest_threshold(curves["cost"]))
    for name, curve in curves.items() if a.out else ():
        curve.write.mode("overwrite").parquet(f"{a.out}/{name}")
    _show("importance", models.feature_importance(spark, model))


@job("train-card", "in", "model", "runs", "format", "alert-cost", "out")
def train_card(spark, a):
    rows = tables.read_latest(spark, getattr(a, "in"), a.format)
    _train(
        spark, a, rows, ["event_time", "transaction_id"],
        models.train_card, models.CARD_PARAMS, "fraud-detection", "amount",
    )


@job("train-wide", "in", "model", "runs", "format", "alert-cost", "out")
def train_wide(spark, a):
    rows = tables.read_latest(spark, getattr(a, "in"), a.format)
    _train(
        spark, a, rows, ["row_id"],
        models.train_wide, models.WIDE_PARAMS, "fraud-detection-real", "Amount",
    )


@job("cost-threshold", "in", "alert-cost", "format")
def cost_threshold(spark, a):
    rows = tables.read_latest(spark, getattr(a, "in"), a.format)
    report = models.cost_threshold_run(
        rows, ["row_id"], models.train_wide, alert_cost=a.alert_cost
    )
    _show("strategies", report)


def _sender(a, run_id: int):
    if a.topic_format == "kafka":
        return monitor.send_to_broker(a.servers, a.alert_topic)
    return monitor.send_to_folder(a.alert_topic, run_id)


def _run_id(a) -> int:
    return a.run_id if a.run_id is not None else int(time.time())


@job("score-cards", "model", "threshold", "run-id", "alert-topic", "out", "state", *_TOPIC)
def score_cards(spark, a):
    """Alerts go to the alert topic (to a broker at least once); with --out, running counters to that table."""
    records = silver.envelope(_topic(spark, a, _live(a)))
    model = runs.load_model(a.model)
    if not a.out:
        if a.state == "split":
            raise SystemExit("--state split needs --out, the table of running counters")
        alerts = al.to_messages(scoring.live_card_alerts(records, model, a.threshold, a.state), "card_id")
        topics.drain(
            topics.publish_stream(
                alerts, a.checkpoint, a.topic_format, a.alert_topic, a.servers, a.alert_topic, a.every
            )
        )
        return
    run_id = _run_id(a)
    sender = _sender(a, run_id)
    if a.state == "split":
        publish = monitor.card_publisher(run_id, sender, a.out, a.threshold)
        topics.drain(scoring.start_split_scores(records, model, publish, a.checkpoint, a.every))
    else:
        scored = scoring.score_cards(records, model, a.state)
        topics.drain(monitor.publish_cards(scored, run_id, sender, a.out, a.checkpoint, a.threshold, a.every))
    beats = monitor.read_beats(spark, a.out, run_id).drop("lat_sum", "lat_n")
    _show("counters", evaluate.with_prf(ordering.first_rows(beats, [F.desc("processed")], 1)))


@job("score-wide", "model", "threshold", "run-id", "alert-topic", "out", *_TOPIC)
def score_wide(spark, a):
    """Alerts and statistics go to the alert topic (to a broker at least once), the statistics table to --out."""
    run_id = _run_id(a)
    records = silver.envelope(_topic(spark, a, _live(a)))
    scored = scoring.score_wide(records, runs.load_model(a.model))
    topics.drain(
        monitor.publish_run(
            scored, run_id, _sender(a, run_id), a.out, a.checkpoint, a.threshold, a.every
        )
    )


# -- tables kept up to date by a stream -------------------------------------------------------


def _card_alerts(messages: DataFrame) -> DataFrame:
    rows = silver.decode(messages, CARD_ALERT)
    return rows.withColumn("event_time", iso_to_timestamp(F.col("event_time")))


def _alert_stream(spark, a) -> DataFrame:
    """Published messages as a stream; a folder of them holds keys and values only."""
    if a.topic_format == "kafka":
        return silver.envelope(_topic(spark, a))
    return topics.read_table_stream(spark, a.topic, MESSAGE, a.topic_format, a.cap)


@job("dedupe-wide", "in", "out", "format", "checkpoint", "every", "copies", "hold", "delay")
def dedupe_wide(spark, a):
    """Bronze wide rows into a table with one row per id, as they arrive."""
    bronze_rows = topics.read_table_stream(spark, getattr(a, "in"), ENVELOPE, a.format)
    rows = silver.wide_rows(bronze_rows, keep=("partition", "offset"))
    if a.copies == "lowest":
        rows = layers.dedupe_lowest(rows, "row_id", "event_time", a.hold, a.delay)
    else:
        rows = layers.dedupe_stream(rows, "row_id", "event_time", f"{a.hold} seconds")
    topics.drain(topics.append_stream(rows.drop("partition", "offset"), a.out, a.checkpoint, a.format, a.every))


@job("alert-series", "out", "format", "seconds", "delay", *_TOPIC)
def alert_series(spark, a):
    """Published card alerts per closed interval, empty ones included, into a table."""
    rows = _card_alerts(_alert_stream(spark, a))
    series = monitor.filled_alert_windows(rows, F.lit(True), a.seconds, a.delay)
    topics.drain(topics.append_stream(series, a.out, a.checkpoint, a.format, a.every))


@job("keep-alerts", "out", "keep", *_TOPIC)
def keep_alerts(spark, a):
    """The newest published card alerts, so many, in a table of bounded size."""
    rows, n = _card_alerts(_alert_stream(spark, a)), a.keep or al.KEPT_CARD_ALERTS
    topics.drain(intake.keep_newest(rows, a.out, a.checkpoint, lambda df: al.retained_alerts(df, n), a.every))
    _show("newest", al.latest_alerts(intake.read_newest(spark, a.out, rows.schema)), 15)


@job("run-view", "out", "format", *_TOPIC)
def run_view(spark, a):
    """The view of the newest run after every micro-batch of its published messages, into a table."""
    messages = silver.decode(_alert_stream(spark, a), RUN_MESSAGE)
    topics.drain(topics.append_stream(view.run_view_stream(messages), a.out, a.checkpoint, a.format, a.every))
    found = tables.read_table(spark, a.out, a.format)
    _show("run", ordering.first_rows(found, [F.desc("run_id"), F.desc_nulls_last("processed")], 1))


# -- reports ---------------------------------------------------------------------------------


@job("alert-report", "in", "threshold", "country", "merchant", "keep")
def alert_report(spark, a):
    """The alert views over a folder of published card alerts."""
    rows = _card_alerts(spark.read.parquet(getattr(a, "in")))
    if a.keep:
        rows = al.retained_alerts(rows, a.keep)
    alerts = stage(al.alert_slice(rows, a.threshold, a.country, a.merchant), "alerts")
    _show("key figures", al.alert_kpis(alerts))
    for column in ("merchant_category", "country"):
        _show(column, al.frequencies(alerts, column))
    _show("cards", al.top_cards(alerts))
    _show("flows", al.flow_matrix(alerts))
    _show("foreign flows", al.foreign_flows(alerts))
    _show("per 30 seconds", al.interval_series(alerts).orderBy(F.desc("bucket")))
    _show("newest", al.latest_alerts(alerts), 15)
    _show("busiest card", al.card_history(alerts, al.busiest_card(alerts)))


@job("run-report", "in", "keep")
def run_report(spark, a):
    """The live view over a folder of published wide alerts and statistics."""
    messages = stage(silver.decode(spark.read.parquet(getattr(a, "in")), RUN_MESSAGE), "run")
    stats = al.newest_run(messages, "stats")
    if a.keep:
        stats = al.retained_statistics(stats, a.keep)
    _show("run", al.live_run_view(stats))
    _show("series", al.run_series_long(stats).orderBy(F.desc("processed"), "serie"))
    raised = al.with_class_names(al.newest_run(messages, "alert"))
    columns = ["row_id", "Amount", "score", "alert_classe", "latency_ms"]
    _show("newest", ordering.first_rows(raised.select(*columns), [F.desc("row_id")], 15))


@job("wide-report", "in", "format", "out", "bins", "sample")
def wide_report(spark, a):
    """The exploration views over wide silver; with --out, the sample is written there."""
    rows = tables.read_latest(spark, getattr(a, "in"), a.format)
    _show("overview", explore.overview(rows))
    _show("frauds over time", explore.label_bins(rows).orderBy("bin"), 40)
    _show("amounts by class", explore.describe(rows))
    _show("correlation", explore.label_correlation(rows, WIDE_FEATURES))
    _show("amounts", explore.histogram(rows, "Amount", a.bins, "is_fraud").orderBy("classe", "bin"), 2 * a.bins)
    sample = explore.stratified_sample(rows.select("row_id", *WIDE_FEATURES, "is_fraud"), "row_id", a.sample)
    if a.out:
        sample.write.mode("overwrite").parquet(a.out)
        sample = spark.read.parquet(a.out)
    _show("sample", sample.groupBy("is_fraud").count().orderBy("is_fraud"))


@job("replay-report", "in", "model", "threshold", "batch", "format", "out")
def replay_report(spark, a):
    """Running counters and last hits of a model over the newest fifth of wide silver, replayed in order."""
    rows = tables.read_latest(spark, getattr(a, "in"), a.format)
    split = ordering.chronological_split(rows, ["row_id"], [(0.8, "train"), (1.0, "test")])
    scored = models.score(split.filter("split = 'test'").drop("split"), runs.load_model(a.model))
    scored = stage(scored.withColumn("latency_ms", F.lit(None).cast("double")), "scored")
    totals = stage(al.replay_totals(ordering.with_row_index(scored, ["row_id"]), a.batch, a.threshold), "replay")
    totals = totals.drop("lat_win")
    if a.out:
        totals.write.mode("overwrite").parquet(a.out)
    _show("running counters", ordering.first_rows(evaluate.with_prf(totals), [F.desc("processed")], 20))
    hits = al.flagged(scored, a.threshold).filter("is_fraud = 1").select("row_id", "Amount", "score")
    _show("last hits", ordering.first_rows(hits, [F.desc("row_id")], 15))


@job("status", "bronze", "silver", "gold", "alert-topic", "runs", "experiment", "format")
def status(spark, a):
    """Rows per layer, alerts against transactions, the newest training run."""
    paths = {"bronze": a.bronze, "silver": a.silver, "gold": a.gold}
    layers_found = {n: _layer(spark, path, a.format) for n, path in paths.items()}
    bronze_rows = layers_found["bronze"]
    if any(rows is not None for rows in layers_found.values()):
        _show("layers", quality.layer_counts(layers_found))
    if bronze_rows is not None:
        _show("topics", quality.topic_depth(bronze_rows))
    alerts = _layer(spark, a.alert_topic, "parquet")
    if bronze_rows is not None and alerts is not None:
        counts = [df.agg(F.count(F.lit(1)).alias("n")) for df in (bronze_rows, alerts)]
        _show("alert rate", quality.alert_rate(*counts))
    if a.runs:
        _show("newest run", runs.latest_run(spark, a.runs, a.experiment))


def _layer(spark, path: str | None, fmt: str) -> DataFrame | None:
    if not path:
        return None
    version = tables.current_version(spark, path) if fmt != "delta" else None
    return tables.read_table_or_none(spark, version or path, fmt)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="fraudlens")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, (function, options) in JOBS.items():
        command = commands.add_parser(name, help=function.__doc__)
        for option in options:
            command.add_argument(f"--{option}", **OPTIONS[option])
    a = parser.parse_args(arguments)
    session = spark or build_session(f"fraudlens-{a.job}")
    try:
        JOBS[a.job][0](session, a)
    finally:
        if spark is None:
            drop_staged(session)


if __name__ == "__main__":
    main()
