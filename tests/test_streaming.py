import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_features import SCHEMA, brute_force, skewed_rows, tx

from fraudlens.operators import silver
from fraudlens.operators.features import card_features
from fraudlens.schemas import ENVELOPE, RUN_MESSAGE, TOPIC_RECORD
from fraudlens.session import ROCKSDB_PROVIDER, new_path
from fraudlens.sources import topics, views
from fraudlens.streaming import layers, monitor, state

START = datetime(2024, 5, 1)


def write_files(frames, path):
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)


def as_stream(spark, path, schema, files=1):
    return topics.read_table_stream(spark, path, schema, files_per_trigger=files)


def drain_to_table(df, path=None, checkpoint=None):
    spark = df.sparkSession
    path = path or new_path(spark, "out")
    topics.drain(topics.append_stream(df, path, checkpoint or new_path(spark, "checkpoint")))
    return spark.read.parquet(path)


def feature_rows(df):
    return {
        r.transaction_id: (r.n_prev, round(r.amount_ratio, 6), r.tx_1h, r.sec_since_prev)
        for r in df.collect()
    }


@pytest.mark.parametrize("mode", ["group", "transform"])
def test_live_features_equal_batch_across_micro_batches(spark, mode):
    rows = sorted(skewed_rows(240), key=lambda r: int(r[3]))
    # a second must not be split, its rows are ordered by id inside one batch
    cuts = [0, 80, 160, 240]
    while int(rows[cuts[1]][3]) == int(rows[cuts[1] - 1][3]):
        cuts[1] += 1
    while int(rows[cuts[2]][3]) == int(rows[cuts[2] - 1][3]):
        cuts[2] += 1
    path = new_path(spark, "tx")
    write_files([tx(spark, rows[a:b]) for a, b in zip(cuts, cuts[1:])], path)
    stream = as_stream(spark, path, tx(spark, []).schema)
    found = drain_to_table(state.live_features(stream, mode))
    assert feature_rows(found) == brute_force(rows)
    assert set(found.columns) == set(stream.columns) | set(state.FEATURES.names) | {"is_foreign"}


def test_carried_columns_survive_unchanged(spark):
    rows = [("a", "c", 1.5, "fuel", None, "FR", START + timedelta(microseconds=7), None)]
    path = new_path(spark, "tx")
    write_files([spark.createDataFrame(rows, SCHEMA)], path)
    stream = as_stream(spark, path, tx(spark, []).schema)
    row = drain_to_table(state.live_features(stream)).first()
    assert tuple(row)[: len(rows[0])] == rows[0]
    assert row.is_foreign is None


def test_late_row_counts_what_is_kept(spark):
    hour = 3600
    batches = [
        [("a", "c", 10.0, 0)],
        [("b", "c", 10.0, 2 * hour)],
        [("late", "c", 30.0, 10), ("d", "c", 10.0, 2 * hour + 5)],
    ]
    path = new_path(spark, "tx")
    write_files([tx(spark, b) for b in batches], path)
    found = feature_rows(
        drain_to_table(state.live_features(as_stream(spark, path, tx(spark, []).schema)))
    )
    # "a" left the last hour with "b", so the late row does not see it; its history does
    assert found["late"] == (2, 3.0, 0, 0)
    assert found["d"][0] == 3 and found["d"][2] == 1


def test_state_outlives_a_restart(spark):
    rows = sorted(skewed_rows(120, seed=8), key=lambda r: int(r[3]))
    cut = 60
    while int(rows[cut][3]) == int(rows[cut - 1][3]):
        cut += 1
    path, out, checkpoint = (new_path(spark, n) for n in ("tx", "out", "checkpoint"))
    for part in (rows[:cut], rows[cut:]):
        write_files([tx(spark, part)], path)
        stream = as_stream(spark, path, tx(spark, []).schema)
        found = drain_to_table(state.live_features(stream), out, checkpoint)
    assert feature_rows(found) == brute_force(rows)


def test_bronze_and_silver_resume_without_loss_or_repeats(spark, sf_dir):
    topic, bronze, clean = (new_path(spark, n) for n in ("topic", "bronze", "silver"))
    marks = [new_path(spark, "checkpoint") for _ in range(2)]
    records = views.card_topic(spark, sf_dir, offsets=False)
    total = records.count()
    halves = [records.filter("offset % 2 = 0"), records.filter("offset % 2 = 1")]

    def run():
        stream = topics.read_topic(spark, path=topic, cap=1, schema=TOPIC_RECORD)
        topics.drain(layers.land_bronze(stream, bronze, marks[0]))
        topics.drain(layers.refine_silver(spark, bronze, clean, marks[1]))
        return spark.read.parquet(bronze).count(), spark.read.parquet(clean).count()

    write_files(halves[:1], topic)
    first = run()
    assert run() == first  # nothing new, nothing added
    write_files(halves[1:], topic)
    batch = silver.silver_card(silver.envelope(records)).count()
    assert run() == (total, batch)


def test_dedupe_keeps_one_row_per_key(spark):
    rows = [(i % 10, START + timedelta(minutes=i)) for i in range(100)]
    path = new_path(spark, "rows")
    df = spark.createDataFrame(rows, "row_id bigint, event_time timestamp")
    write_files([df.limit(50), df.subtract(df.limit(50))], path)
    stream = as_stream(spark, path, df.schema)
    found = drain_to_table(layers.dedupe_stream(stream, "row_id", "event_time", "1 day"))
    assert sorted(r.row_id for r in found.collect()) == list(range(10))


@pytest.fixture
def scored_files(spark):
    rng = random.Random(2)
    rows = [
        (START + timedelta(seconds=i), int(rng.random() < 0.3), rng.random(), float(i))
        for i in range(90)
    ]
    schema = "event_time timestamp, is_fraud int, score double, latency_ms double"
    df = spark.createDataFrame(rows, schema)
    path = new_path(spark, "scored")
    write_files([spark.createDataFrame(rows[i : i + 30], schema) for i in (0, 30, 60)], path)
    return rows, as_stream(spark, path, df.schema)


def test_counters_are_cumulative(spark, scored_files):
    rows, stream = scored_files
    path = new_path(spark, "counters")
    query = monitor.save_counters(
        monitor.quality_counters(stream), path, new_path(spark, "checkpoint")
    )
    topics.drain(query)
    row = monitor.latest_epoch(spark, path).first()
    assert row.processed == 90 and row.tp + row.fp + row.fn + row.tn == 90
    assert row.tp == sum(y and p >= 0.5 for _, y, p, _ in rows)
    assert row.mean_latency_ms == 44.5


def test_heartbeat_latency_is_per_batch(spark, scored_files):
    _, stream = scored_files
    path = new_path(spark, "beats")
    topics.drain(monitor.heartbeat(stream, 7, path, new_path(spark, "checkpoint"), every=None))
    beats = monitor.heartbeat_statistics(spark, path).orderBy("processed").collect()
    assert [b.processed for b in beats] == [30, 60, 90]
    assert [b.lat_win for b in beats] == [14.5, 44.5, 74.5]
    assert {b.run_id for b in beats} == {7}


def test_runs_into_one_topic_stay_apart(spark, scored_files):
    """A second run, with a checkpoint of its own, starts its counters at 0 and replaces nothing."""
    _, stream = scored_files
    stream = stream.withColumn("row_id", F.unix_micros("event_time")).withColumn("Amount", F.lit(1.0))
    path, beats = new_path(spark, "run-topic"), new_path(spark, "beats")
    for run_id in (1, 2):
        send = monitor.send_to_folder(path, run_id)
        topics.drain(monitor.publish_run(stream, run_id, send, beats, new_path(spark, "checkpoint"), every=None))
    messages = silver.decode(spark.read.parquet(path), RUN_MESSAGE)
    counts = {(r.run_id, r.type): r["count"] for r in messages.groupBy("run_id", "type").count().collect()}
    assert counts[1, "stats"] == counts[2, "stats"] == 3
    assert counts[1, "alert"] == counts[2, "alert"] > 0
    found = monitor.heartbeat_statistics(spark, beats).orderBy("run_id", "processed").collect()
    assert [(b.run_id, b.processed) for b in found] == [(r, n) for r in (1, 2) for n in (30, 60, 90)]


def test_a_new_run_on_an_old_checkpoint_starts_at_zero(spark, scored_files):
    batch = spark.createDataFrame([(1, 0.9, 5.0)] * 2, "is_fraud int, score double, latency_ms double")
    path = new_path(spark, "beats")
    for run_id, epoch, processed in ((1, 0, 2), (1, 1, 4), (2, 2, 2), (2, 3, 4)):
        row = monitor._save_beat(batch, epoch, run_id, path, 0.5).first()
        assert (row.run_id, row.processed) == (run_id, processed)


def test_alert_windows_close_with_the_watermark(spark, scored_files):
    _, stream = scored_files
    found = drain_to_table(monitor.alert_windows(stream, 30, "10 seconds")).collect()
    # the watermark stands at 79 s: only the first two intervals are closed
    assert sorted((r.bucket, r.alerts) for r in found) == [
        (START, 30),
        (START + timedelta(seconds=30), 30),
    ]


def test_state_store_setting(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    assert spark.conf.get(key) == ROCKSDB_PROVIDER


def test_envelope_columns(spark, sf_dir):
    df = silver.envelope(views.card_topic(spark, sf_dir, offsets=False))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ENVELOPE]


def test_kafka_is_refused_clearly_without_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topic(spark, fmt="kafka", servers="localhost:1", topic="t")


def test_backlog_is_read_in_bounded_micro_batches(spark, monkeypatch):
    path = new_path(spark, "files")
    df = spark.range(2000).selectExpr("id", "uuid() AS text")
    for _ in range(3):
        df.coalesce(1).write.mode("append").parquet(path)
    monkeypatch.setattr(topics, "INTAKE_BYTES", 1000)  # less than a file
    stream = topics.read_table_stream(spark, path, df.schema)
    query = topics.append_stream(stream, new_path(spark, "out"), new_path(spark, "checkpoint"))
    topics.drain(query)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2000] * 3


def test_amounts_of_zero_give_no_ratio_live_or_batch(spark):
    rows = tx(spark, [("a", "c", 0.0, 0), ("b", "c", 5.0, 10), ("d", "c", 5.0, 20)])
    path = new_path(spark, "tx")
    write_files([rows], path)
    live = drain_to_table(state.live_features(as_stream(spark, path, rows.schema)))
    for found in (live, card_features(rows)):
        ratios = {r.transaction_id: r.amount_ratio for r in found.collect()}
        assert ratios == {"a": 1.0, "b": None, "d": 2.0}
