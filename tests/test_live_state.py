import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import as_stream, drain_to_table, scored_files, write_files  # noqa: F401

from fraudlens.operators import alerts as al
from fraudlens.operators import explore, quality
from fraudlens.operators.silver import first_per_key
from fraudlens.schemas import RUN_BEAT, RUN_MESSAGE
from fraudlens.session import new_path
from fraudlens.sources import topics
from fraudlens.streaming import intake, layers, monitor, rollup, view

START = datetime(2024, 5, 1)


# -- counters and beats (T5, T6) -------------------------------------------------------------


def test_counters_are_read_from_state(spark, scored_files):  # noqa: F811
    rows, stream = scored_files
    checkpoint = new_path(spark, "checkpoint")
    topics.drain(monitor.run_counters(monitor.quality_counters(stream), checkpoint))
    (row,) = monitor.counters_in_state(spark, checkpoint).collect()
    assert row.processed == 90 and row.tp + row.fp + row.fn + row.tn == 90
    assert row.tp == sum(y and p >= 0.5 for _, y, p, _ in rows) and row.mean_latency_ms == 44.5


def test_saved_counters_keep_two_micro_batches(spark, scored_files):  # noqa: F811
    path = new_path(spark, "counters")
    topics.drain(monitor.save_counters(monitor.quality_counters(scored_files[1]), path, new_path(spark, "checkpoint")))
    assert sorted(rollup.names(spark, path)) == ["epoch=1", "epoch=2"]
    assert monitor.latest_epoch(spark, path).first().processed == 90


def test_beats_of_a_long_run_have_few_files(spark, monkeypatch):
    monkeypatch.setattr(rollup, "FAN", 5)
    monkeypatch.setattr(rollup.roll_up, "__defaults__", (5,))
    batch = spark.createDataFrame([(1, 0.9, 5.0), (0, 0.9, 7.0)], "is_fraud int, score double, latency_ms double")
    path, most = new_path(spark, "beats"), 0
    for epoch in range(62):
        monitor._save_beat(batch, epoch, 3, path, 0.5)
        most = max(most, len(rollup.names(spark, f"{path}/run=3")))
    assert most <= 20
    beats = monitor.read_beats(spark, path).orderBy("processed").collect()
    assert [b.processed for b in beats] == [2 * (i + 1) for i in range(62)]
    assert [b.tp for b in beats] == [i + 1 for i in range(62)]
    assert {b.mean_latency_ms for b in beats} == {6.0} and {b.lat_win for b in beats} == {6.0}
    # a repeated micro-batch replaces its own row
    monitor._save_beat(batch, 61, 3, path, 0.5)
    assert monitor.read_beats(spark, path, 3).count() == 62 and monitor.read_beats(spark, path, 4).count() == 0


def beat(spark, n):
    return spark.createDataFrame([(1, 0.0, n, n, 0, 0, 0, 0, None, 0.0, 0)], RUN_BEAT)


def test_interrupted_merges_lose_and_repeat_nothing(spark):
    base = new_path(spark, "segments")
    for epoch in range(12):
        rollup.save_segment(beat(spark, epoch), base, epoch)

    def epochs():
        return sorted(r.n for r in rollup.read_segments(spark, base, RUN_BEAT).collect())

    # the merged segment is not finished: its rows are still those of the small ones
    half = rollup.Segment(1, 4).path(base)
    beat(spark, 99).write.parquet(half)
    rollup.delete(spark, f"{half}/_SUCCESS")
    assert epochs() == list(range(12))
    rollup.roll_up(spark, base, 11, RUN_BEAT, fan=5)
    assert epochs() == list(range(12))
    assert [s for s in rollup.live_segments(spark, base) if s.tier] == [rollup.Segment(1, 10)]
    # finished, but what it covers is not deleted yet
    rollup.save_segment(beat(spark, 3), base, 3)
    assert epochs() == list(range(12))
    rollup.roll_up(spark, base, 12, RUN_BEAT, fan=5)
    assert rollup.Segment(0, 3).path(base).rsplit("/", 1)[1] not in rollup.names(spark, base)
    assert rollup.read_segment(spark, base, 11, RUN_BEAT).first().n == 11
    assert rollup.read_segment(spark, base, 500, RUN_BEAT) is None


# -- lowest copy (A28) -----------------------------------------------------------------------


def test_lowest_copy_wins_in_any_order(spark):
    rng = random.Random(1)
    rows = []
    for key in range(40):
        for copy in range(rng.randint(1, 4)):
            at = START + timedelta(minutes=key, seconds=rng.randrange(600), microseconds=copy)
            rows.append((key, rng.randrange(3), len(rows), at, f"text {copy}"))
    schema = "row_id bigint, partition int, offset bigint, event_time timestamp, text string"
    want = sorted(map(tuple, first_per_key(spark.createDataFrame(rows, schema), "row_id", ["partition", "offset"]).collect()))
    end = [(-1, 0, 10_000, START + timedelta(days=9), "end")]
    for seed in (2, 3):
        random.Random(seed).shuffle(rows)
        path = new_path(spark, "rows")
        write_files([spark.createDataFrame(p, schema) for p in (rows[:30], rows[30:60], rows[60:], end)], path)
        found = drain_to_table(layers.dedupe_lowest(as_stream(spark, path, spark.createDataFrame(end, schema).schema), "row_id", "event_time", 7200, "3 hours"))
        assert sorted(map(tuple, found.collect())) == want


def test_rows_are_held_until_their_time_has_passed(spark):
    schema = "row_id bigint, partition int, offset bigint, event_time timestamp"
    batches = [[(1, 0, 5, START)], [(1, 0, 2, START + timedelta(seconds=50))], [(2, 0, 9, START + timedelta(seconds=90))]]
    path, out, checkpoint = (new_path(spark, n) for n in ("rows", "out", "checkpoint"))
    write_files([spark.createDataFrame(b, schema) for b in batches], path)
    stream = as_stream(spark, path, spark.createDataFrame(batches[0], schema).schema)

    def run():
        deduped = layers.dedupe_lowest(stream, "row_id", "event_time", 100, "0 seconds")
        return sorted((r.row_id, r.offset) for r in drain_to_table(deduped, out, checkpoint).collect())

    assert run() == []
    write_files([spark.createDataFrame([(3, 0, 10, START + timedelta(seconds=150))], schema)], path)
    assert run() == [(1, 2)]


# -- filled series (T7, T8) ------------------------------------------------------------------


def test_empty_intervals_come_by_timer(spark):
    """No alert after 20 s: the rows that follow move the watermark, which fills the series."""
    rows = [(START + timedelta(seconds=s), 0.9 if s < 20 else 0.1, float(s)) for s in range(0, 400, 10)]
    schema = "event_time timestamp, score double, latency_ms double"
    path, out, checkpoint = (new_path(spark, n) for n in ("scored", "series", "checkpoint"))
    for part in (rows[:10], rows[10:30], rows[30:]):
        write_files([spark.createDataFrame(part, schema)], path)
        stream = as_stream(spark, path, spark.createDataFrame(part, schema).schema)
        series = monitor.filled_alert_windows(stream, F.col("score") >= 0.5, 30, "10 seconds")
        found = sorted(map(tuple, drain_to_table(series, out, checkpoint).collect()))
    step = timedelta(seconds=30)
    # the watermark stands at 380 s
    assert found == [(START, 2, 5.0), *((START + i * step, 0, None) for i in range(1, 12))]
    written = spark.read.parquet(out)
    assert written.select("bucket").distinct().count() == written.count()


# -- run view (T9, P13) ----------------------------------------------------------------------


def message(kind, run_id, n):
    stats = (n, n // 2, n // 4, 1, 2, 1.5) if kind == "stats" else (None,) * 6
    return {"type": kind, "run_id": run_id, "row_id": None if kind == "stats" else n, **dict(zip(view._STATS, stats))}


def as_messages(spark, rows):
    full = [[row.get(f.name) for f in RUN_MESSAGE.fields] for row in rows]
    return spark.createDataFrame(full, RUN_MESSAGE)


def test_a_newer_run_resets_the_view(spark):
    batches = [
        [message("alert", 1, n) for n in range(100, 130)] + [message("stats", 1, 8), message("stats", 1, 4)],
        [message("alert", 2, 3)],
        [message("stats", 1, 99), message("alert", 1, 500)],  # a run that is over
        [message("stats", 2, 4), message("stats", 2, 12)] + [message("alert", 2, n) for n in range(4, 30)],
        [message("stats", 2, 8)],  # late
    ]
    path, out, checkpoint = (new_path(spark, n) for n in ("messages", "view", "checkpoint"))
    seen = []
    for b in batches:
        write_files([as_messages(spark, b)], path)
        stream = as_stream(spark, path, RUN_MESSAGE)
        found = drain_to_table(view.run_view_stream(stream), out, checkpoint)
        rows = sorted(map(lambda r: (r.run_id, r.processed, r.tp, r.alerts, r.precision, len(r.last_alerts)), found.collect()), key=str)
        seen.append(rows)
    assert seen[0] == [(1, 8, 4, 6, round(4 / 6, 6), 15)]
    assert (2, None, None, None, 0.0, 1) in seen[1] or any(r[:2] == (2, None) and r[-1] == 1 for r in seen[1])
    assert seen[2] == seen[1]  # nothing is given out for it
    assert (2, 12, 6, 9, round(6 / 9, 6), 15) in seen[3] and len(seen[4]) == len(seen[3]) + 1
    assert [a["row_id"] for a in view.alert_rows(spark.read.parquet(out))] == list(range(29, 14, -1))


# -- newest rows (S12) -----------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_newest_rows_whatever_the_micro_batches(spark, parts):
    rng = random.Random(parts)
    rows = [(f"t{i:03}", None if i % 40 == 0 else START + timedelta(seconds=rng.randrange(100))) for i in range(200)]
    rng.shuffle(rows)
    schema = "transaction_id string, event_time timestamp"
    df = spark.createDataFrame(rows, schema)
    for n in (30, 199, 500):
        path, source = new_path(spark, "newest"), new_path(spark, "alerts")
        write_files([spark.createDataFrame(rows[k::parts], schema) for k in range(parts)], source)
        topics.drain(intake.keep_newest(as_stream(spark, source, df.schema), path, new_path(spark, "checkpoint"), lambda x: al.retained_alerts(x, n)))  # noqa: B023
        kept = intake.read_newest(spark, path, df.schema)
        assert set(map(tuple, kept.collect())) == set(map(tuple, al.retained_alerts(df, n).collect()))
        assert len(rollup.names(spark, path)) <= 2
    assert intake.read_newest(spark, new_path(spark, "none"), df.schema).count() == 0


# -- offsets (J3) and sketches (A15) ---------------------------------------------------------


def test_offset_ranges(spark):
    offsets = [(0, o) for o in (3, 4, 5, 9, 10, 20)] + [(0, 4), (0, 5), (0, 5), (0, 20)] + [(1, 7)] + [(2, 1), (2, 1), (2, None)]
    found = quality.offset_ranges(spark.createDataFrame(offsets, "partition int, offset bigint")).collect()
    assert sorted(map(tuple, found)) == [
        (0, "missing", 6, 8, 3), (0, "missing", 11, 19, 9), (0, "repeated", 4, 5, 3), (0, "repeated", 20, 20, 1),
        (2, "repeated", 1, 1, 1),
    ]
    assert quality.offset_ranges(spark.createDataFrame([], "partition int, offset bigint")).collect() == []


def test_offset_ranges_of_one_large_partition(spark):
    kept = spark.range(20_000).filter("id % 7 <> 3").select(F.lit(0).alias("partition"), F.col("id").alias("offset"))
    found = quality.offset_ranges(kept).collect()
    assert sorted(r.first_offset for r in found) == list(range(3, 19_999, 7)) and {r["rows"] for r in found} == {1}


@pytest.mark.parametrize("sketch,error", [(200, 0.0265), (800, 0.0075)])
def test_sketched_quantiles_are_near_in_rank(spark, sketch, error):
    rng = random.Random(7)
    rows = [(rng.expovariate(1) if i % 3 else float(rng.randrange(5)), int(i % 10 == 0)) for i in range(40_000)]
    df = spark.createDataFrame(rows, "Amount double, is_fraud int").repartition(16)
    exact = {r.classe: r for r in explore.describe(df, digits=9).collect()}
    for r in explore.describe(df, digits=9, sketch=sketch).collect():
        label = int(r.classe == "Fraude")
        values = sorted(x for x, y in rows if y == label)
        for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            low = sum(v < r[name] - 1e-8 for v in values) / len(values)
            high = sum(v <= r[name] + 1e-8 for v in values) / len(values)
            assert low - error <= q <= high + error
        assert (r["count"], r["min"], r["max"]) == (exact[r.classe]["count"], exact[r.classe]["min"], exact[r.classe]["max"])
