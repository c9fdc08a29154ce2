"""The command line from the topic to the alert report, on files."""

import pytest

from fraudlens import jobs
from fraudlens.operators import models, silver
from fraudlens.schemas import CARD_ALERT
from fraudlens.session import new_path
from fraudlens.sources import tables, views
from fraudlens.streaming import intake


@pytest.fixture(scope="module")
def paths(spark):
    names = ["topic", "bronze", "silver", "gold", "model", "runs", "alerts", "csv", "wide"]
    return {n: new_path(spark, n) for n in names}


def run(spark, *arguments):
    jobs.main([str(a) for a in arguments], spark)


def test_card_jobs(spark, sf_dir, paths, capsys, monkeypatch):
    monkeypatch.setitem(models.CARD_PARAMS, "maxIter", 2)
    views.card_topic(spark, sf_dir, offsets=True).write.parquet(paths["topic"])
    c = [new_path(spark, "checkpoint") for _ in range(3)]
    run(spark, "bronze", "--topic", paths["topic"], "--out", paths["bronze"], "--checkpoint", c[0])
    run(spark, "check-bronze", "--in", paths["bronze"], "--topic", paths["topic"])
    printed = capsys.readouterr().out
    assert "max_offset" in printed and "missing and repeated offsets" in printed and "|ok" in printed
    run(spark, "silver", "--in", paths["bronze"], "--out", paths["silver"], "--checkpoint", c[1])
    run(spark, "check-silver", "--in", paths["silver"])
    run(spark, "gold", "--in", paths["silver"], "--out", paths["gold"])
    run(spark, "check-gold", "--in", paths["gold"])
    curves = new_path(spark, "curves")
    run(
        spark, "train-card", "--in", paths["gold"], "--model", paths["model"], "--runs", paths["runs"],
        "--out", curves, "--alert-cost", 3,
    )
    costs = spark.read.parquet(f"{curves}/cost").collect()
    assert len(costs) == 99 and "cheapest threshold" in capsys.readouterr().out
    points = spark.read.parquet(f"{curves}/precision-recall").collect()
    assert any(r.threshold is None and r.recall == 0 for r in points) and len(points) > 2
    run(
        spark, "score-cards", "--topic", paths["topic"], "--model", paths["model"],
        "--alert-topic", paths["alerts"], "--checkpoint", c[2],
    )
    run(spark, "alert-report", "--in", paths["alerts"])
    beats, sent, checkpoint = (new_path(spark, n) for n in ("beats", "sent", "checkpoint"))
    run(
        spark, "score-cards", "--topic", paths["topic"], "--model", paths["model"], "--run-id", 4,
        "--alert-topic", sent, "--out", beats, "--checkpoint", checkpoint,
    )
    assert spark.read.parquet(sent).count() == spark.read.parquet(paths["alerts"]).count()
    counted = spark.read.parquet(beats).first()
    assert counted.processed == 995 and counted.run_id == 4
    run(spark, "alert-report", "--in", sent, "--country", "FR", "MA", "--merchant", "click")
    split_sent, split_beats, checkpoint = (new_path(spark, n) for n in ("sent", "beats", "checkpoint"))
    run(
        spark, "score-cards", "--topic", paths["topic"], "--model", paths["model"], "--run-id", 5, "--state", "split",
        "--alert-topic", split_sent, "--out", split_beats, "--checkpoint", checkpoint,
    )
    columns = ["transaction_id", "amount", "score"]

    def scores(folder):
        found = silver.decode(spark.read.parquet(folder), CARD_ALERT).select(*columns).collect()
        return sorted((r.transaction_id, r.amount, round(r.score, 4)) for r in found)

    assert scores(split_sent) == scores(sent) and scores(sent)
    assert spark.read.parquet(split_beats).first().processed == 995
    live_jobs(spark, paths["alerts"], len(scores(sent)))
    run(
        spark, "status", "--bronze", paths["bronze"], "--silver", paths["silver"], "--gold", paths["gold"],
        "--alert-topic", sent, "--runs", paths["runs"],
    )
    assert spark.read.parquet(paths["bronze"]).count() == 1000
    assert tables.read_current(spark, paths["gold"]).count() == 995
    assert spark.read.parquet(paths["alerts"]).count() > 0
    assert "alert rate" in capsys.readouterr().out


def live_jobs(spark, alerts, n):
    """Tables that streams over published alerts keep up to date."""
    series, kept = new_path(spark, "series"), new_path(spark, "kept")
    run(
        spark, "alert-series", "--topic", alerts, "--out", series, "--checkpoint", new_path(spark, "checkpoint"),
        "--seconds", 3600, "--delay", "0 seconds",
    )
    rows = spark.read.parquet(series).orderBy("bucket").collect()
    steps = {(b.bucket - a.bucket).total_seconds() for a, b in zip(rows, rows[1:])}
    assert steps == {3600.0} and any(r.alerts == 0 for r in rows) and n - 20 < sum(r.alerts for r in rows) <= n
    run(spark, "keep-alerts", "--topic", alerts, "--out", kept, "--keep", 7, "--checkpoint", new_path(spark, "checkpoint"))
    found = intake.read_newest(spark, kept, CARD_ALERT).select("transaction_id").collect()
    every = silver.decode(spark.read.parquet(alerts), CARD_ALERT).select("event_time", "transaction_id").collect()
    assert {r.transaction_id for r in found} == {i for _, i in sorted(map(tuple, every))[-7:]}


def test_wide_jobs(spark, sf_dir, paths, capsys, monkeypatch):
    monkeypatch.setitem(models.WIDE_PARAMS, "maxIter", 2)
    wide = views.wide_tx(spark, sf_dir)
    tables.write_csv(views.raw_csv_rows(wide.orderBy("row_id")), paths["csv"], label="Class")
    run(spark, "check-csv", "--in", paths["csv"])
    messages = new_path(spark, "messages")
    run(spark, "replay", "--in", paths["csv"], "--out", messages, "--start", 10, "--limit", 400)
    bronze = new_path(spark, "bronze")
    spark.read.parquet(messages).selectExpr(
        "key", "value", "'t' AS topic", "0 AS partition", "bigint(key) AS offset",
        "current_timestamp() AS kafka_timestamp",
    ).write.parquet(bronze)
    run(spark, "silver-wide", "--in", bronze, "--out", paths["wide"])
    sample = new_path(spark, "sample")
    run(spark, "wide-report", "--in", paths["wide"], "--out", sample, "--sample", 30, "--bins", 5)
    assert spark.read.parquet(sample).filter("is_fraud = 0").count() == 30
    assert "density" in capsys.readouterr().out
    for copies in ("first", "lowest"):
        live = new_path(spark, "live")
        run(
            spark, "dedupe-wide", "--in", bronze, "--out", live, "--checkpoint", new_path(spark, "checkpoint"),
            "--copies", copies, "--hold", 60, "--delay", "1 hour",
        )
        n = spark.read.parquet(live).count()
        assert n == 400 if copies == "first" else n <= 400  # the newest are still held
    model, alerts, beats = (new_path(spark, n) for n in ("model", "alerts", "beats"))
    run(spark, "train-wide", "--in", paths["wide"], "--model", model, "--runs", new_path(spark, "runs"))
    topic = new_path(spark, "topic")
    views.wide_topic(spark, sf_dir).repartition(2).write.parquet(topic)
    run(
        spark, "score-wide", "--topic", topic, "--model", model, "--alert-topic", alerts, "--out", beats,
        "--checkpoint", new_path(spark, "checkpoint"), "--cap", 1, "--run-id", 9,
    )
    run(spark, "run-report", "--in", alerts)
    view_table = new_path(spark, "view")
    run(spark, "run-view", "--topic", alerts, "--out", view_table, "--checkpoint", new_path(spark, "checkpoint"))
    totals = new_path(spark, "totals")
    run(spark, "replay-report", "--in", paths["wide"], "--model", model, "--batch", 20, "--out", totals)
    assert [r.processed for r in spark.read.parquet(totals).orderBy("processed").collect()] == [20, 40, 60, 80]
    stats = spark.read.parquet(beats).orderBy("processed").collect()
    last = spark.read.parquet(view_table).orderBy("processed").collect()[-1]
    assert (last.run_id, last.processed, last.tp) == (9, stats[-1].processed, stats[-1].tp)
    assert stats[-1].processed == views.wide_topic(spark, sf_dir).count() and len(stats) == 2
    run(spark, "cost-threshold", "--in", paths["wide"])
    ids = [r.row_id for r in tables.read_current(spark, paths["wide"]).select("row_id").collect()]
    assert sorted(ids) == list(range(10, 410))
    assert "validation threshold" in capsys.readouterr().out
