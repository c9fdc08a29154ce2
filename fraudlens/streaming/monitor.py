"""Live counters, heartbeats and alert windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fraudlens.operators.alerts import card_alerts, to_messages, wide_alerts
from fraudlens.operators.evaluate import confusion_aggregates
from fraudlens.schemas import DEFAULT_THRESHOLD, RUN_BEAT
from fraudlens.session import exists, use_rocksdb
from fraudlens.streaming import rollup


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def _save_latest(df: DataFrame, path: str):
    """A foreachBatch sink that keeps the newest micro-batch and the one before; a repeated one replaces its own."""

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        for name in rollup.names(batch.sparkSession, path):
            if name.startswith("epoch=") and int(name[6:]) < epoch - 1:
                rollup.delete(batch.sparkSession, f"{path}/{name}")

    return df.writeStream.foreachBatch(save)


def latest_epoch(spark: SparkSession, path: str) -> DataFrame:
    """The newest micro-batch that was saved as a whole; at most three folders are looked at."""
    epochs = sorted(int(n[6:]) for n in rollup.names(spark, path) if n.startswith("epoch="))
    done = [e for e in epochs if exists(spark, f"{path}/epoch={e}/_SUCCESS")]
    return spark.read.parquet(f"{path}/epoch={done[-1]}")


def quality_counters(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Processed rows, confusion cells and mean latency since the start (T5).

    A streaming aggregate: one row of state, added to by partial sums of each micro-batch.
    """
    cells = confusion_aggregates(F.col("is_fraud"), F.col("score"), threshold)
    return scored.groupBy().agg(
        F.count(F.lit(1)).alias("processed"),
        *[cell.alias(name) for name, cell in cells.items()],
        F.round(F.avg("latency_ms"), 6).alias("mean_latency_ms"),
    )


def save_counters(
    counters: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Save the counters after every micro-batch; read them with :func:`latest_epoch`."""
    sink = _save_latest(counters, path).outputMode("complete")
    return sink.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def run_counters(
    counters: DataFrame, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep the counters in the state of the stream alone; read them with :func:`counters_in_state`."""
    sink = counters.writeStream.format("noop").outputMode("update")
    return sink.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def counters_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The running counters of :func:`quality_counters`, read from its state as of the last finished micro-batch.

    No sink writes anything for this, however many triggers there were. The state holds the buffers of the
    aggregates in their order, so a mean is a sum and a number.
    """
    state = spark.read.format("statestore").load(checkpoint)
    buffers = ", ".join([*(f"{name}: bigint" for name in _COUNTERS), "total: double", "timed: bigint"])
    held = state.select(F.col("value").cast(f"struct<{buffers}>").alias("s")).select("s.*")
    mean = F.round(F.col("total") / F.nullif(F.col("timed"), F.lit(0)), 6)
    return held.select(*_COUNTERS, mean.alias("mean_latency_ms"))


_COUNTERS = ["processed", "tp", "fp", "fn", "tn"]


def _save_beat(batch: DataFrame, epoch: int, run_id: int, path: str, threshold: float) -> DataFrame:
    """Write the statistics row of a micro-batch and return it as read back.

    Counters go on from the row of the micro-batch before of the same run, so a beat costs the same
    however long the run is, and a run begins at 0; a repeated micro-batch replaces its own row. Rows of
    earlier micro-batches are rolled up, so a run of any length has few files.
    """
    spark = batch.sparkSession
    base = f"{path}/run={run_id}"
    before: dict = dict.fromkeys([*_COUNTERS, "lat_n"], 0) | {"lat_sum": 0.0}
    last = rollup.read_segment(spark, base, epoch - 1, RUN_BEAT) if epoch else None
    if last is not None:
        before = last.first().asDict()
    if epoch and epoch % rollup.FAN == 0:
        rollup.roll_up(spark, base, epoch - 1, RUN_BEAT)
    cells = confusion_aggregates(F.col("is_fraud"), F.col("score"), threshold)
    now = {"processed": F.count(F.lit(1))} | cells
    latency = F.col("latency_ms")
    row = batch.agg(
        F.lit(run_id).cast("bigint").alias("run_id"),
        (F.unix_micros(F.current_timestamp()) / 1e6).alias("ts"),
        F.count(F.lit(1)).alias("n"),
        *[(F.lit(before[name]) + now[name]).alias(name) for name in _COUNTERS],
        F.round(F.avg(latency), 1).alias("lat_win"),
        (F.lit(before["lat_sum"]) + F.coalesce(F.sum(latency), F.lit(0.0))).alias("lat_sum"),
        (F.lit(before["lat_n"]) + F.count(latency)).alias("lat_n"),
    )
    return _as_messages(spark.read.schema(RUN_BEAT).parquet(rollup.save_segment(row, base, epoch)))


def read_beats(spark: SparkSession, path: str, run_id: int | None = None) -> DataFrame:
    """The statistics rows of all runs below ``path``, or of one, with their mean latency since the start."""
    wanted = [n for n in rollup.names(spark, path) if n.startswith("run=") and run_id in (None, int(n[4:]))]
    paths = [s.path(f"{path}/{n}") for n in wanted for s in rollup.live_segments(spark, f"{path}/{n}")]
    beats = spark.read.schema(RUN_BEAT).parquet(*paths) if paths else spark.createDataFrame([], RUN_BEAT)
    mean = F.round(F.col("lat_sum") / F.nullif(F.col("lat_n"), F.lit(0)), 6)
    return beats.withColumn("mean_latency_ms", mean)


def _as_messages(beats: DataFrame) -> DataFrame:
    return beats.filter("n > 0").select(
        F.lit("stats").alias("type"), "run_id", "ts", *_COUNTERS, "lat_win"
    )


def heartbeat(
    scored: DataFrame,
    run_id: int,
    path: str,
    checkpoint: str,
    threshold: float = DEFAULT_THRESHOLD,
    every: str | None = "2 seconds",
) -> StreamingQuery:
    """One statistics row per micro-batch (T6): running counters, the batch's own mean latency."""

    def save(batch: DataFrame, epoch: int) -> None:
        _save_beat(batch, epoch, run_id, path, threshold)

    stream = scored.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return stream.trigger(**_trigger(every)).start()


def heartbeat_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Saved heartbeats as statistics messages."""
    return _as_messages(read_beats(spark, path))


def publish_run(
    scored: DataFrame,
    run_id: int,
    send: Callable[[DataFrame, int], None],
    beats: str,
    checkpoint: str,
    threshold: float = DEFAULT_THRESHOLD,
    every: str | None = "2 seconds",
) -> StreamingQuery:
    """Send the alerts and the statistics of a wide run as messages of one topic.

    ``send(messages, epoch)`` writes them; each micro-batch is scored once for both.
    """

    def save(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            raised = to_messages(wide_alerts(batch, run_id, threshold), "row_id")
            beat = _save_beat(batch, epoch, run_id, beats, threshold)
            send(raised.unionByName(to_messages(beat, F.lit("stats"))), epoch)
        finally:
            batch.unpersist()

    stream = scored.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return stream.trigger(**_trigger(every)).start()


def card_publisher(
    run_id: int, send: Callable[[DataFrame, int], None], beats: str, threshold: float = DEFAULT_THRESHOLD
) -> Callable[[DataFrame, int], None]:
    """What a card run does with a micro-batch: its counters go below ``beats``, its alerts are sent."""

    def save(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            _save_beat(batch, epoch, run_id, beats, threshold)
            send(to_messages(card_alerts(batch, threshold), "card_id"), epoch)
        finally:
            batch.unpersist()

    return save


def publish_cards(
    scored: DataFrame,
    run_id: int,
    send: Callable[[DataFrame, int], None],
    beats: str,
    checkpoint: str,
    threshold: float = DEFAULT_THRESHOLD,
    every: str | None = "2 seconds",
) -> StreamingQuery:
    """Send the alerts of a card run as messages and keep its running counters below ``beats``."""
    stream = scored.writeStream.foreachBatch(card_publisher(run_id, send, beats, threshold))
    return stream.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def send_to_folder(path: str, run_id: int) -> Callable[[DataFrame, int], None]:
    """Messages into one folder per run and micro-batch; a repeated micro-batch replaces its own."""
    return lambda messages, epoch: messages.write.mode("overwrite").parquet(
        f"{path}/run={run_id}/epoch={epoch}"
    )


def send_to_broker(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Messages to a broker topic, at least once."""
    return lambda messages, _: (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def alert_windows(alerts: DataFrame, seconds: int = 30, delay: str = "1 minute") -> DataFrame:
    """Alerts and mean latency per interval as a stream.

    The watermark closes an interval ``delay`` after its end and bounds the open ones.
    """
    interval = F.window("event_time", f"{seconds} seconds")
    return (
        alerts.withWatermark("event_time", delay)
        .groupBy(interval)
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.round(F.avg("latency_ms"), 6).alias("mean_latency_ms"),
        )
        .select(F.col("window.start").alias("bucket"), "alerts", "mean_latency_ms")
    )


_INTERVAL = "bucket timestamp, alerts bigint, mean_latency_ms double"


class FilledSeries(StatefulProcessor):
    """Closed intervals in their order, with an empty one for each that no alert fell into.

    The state is the end of the last interval given out. A timer stands at the end of the next: when the watermark
    has passed it and no alert has come, the empty intervals up to the watermark are given out.
    """

    def __init__(self, seconds: int):
        self.step = seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.end = handle.getValueState("end", "ms bigint, timer bigint")

    def _rows(self, starts: list[int], alerts: list, latency: list) -> pd.DataFrame:
        at = pd.to_datetime(pd.Series(starts, dtype="int64"), unit="ms")
        return pd.DataFrame({"bucket": at, "alerts": alerts, "mean_latency_ms": pd.array(latency, "Float64")})

    def _empty(self, first: int, end: int) -> Iterator[pd.DataFrame]:
        """Empty intervals from ``first`` up to ``end``, a day's worth of them at a time."""
        for at in range(first, end, 2880 * self.step):
            starts = list(range(at, min(end, at + 2880 * self.step), self.step))
            yield self._rows(starts, [0] * len(starts), [None] * len(starts))

    def _wait(self, end: int, timer: int | None) -> None:
        if timer is not None:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(end + self.step)
        self.end.update((end, end + self.step))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).sort_values("start_ms")
        end, timer = self.end.get() if self.end.exists() else (None, None)
        for start, n, latency in zip(found["start_ms"].tolist(), found["alerts"].tolist(), found["mean_latency_ms"].tolist()):
            if end is not None:
                yield from self._empty(end, start)
            yield self._rows([start], [n], [None if latency != latency else latency])
            end = start + self.step
        self._wait(end, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end, _ = self.end.get()
        closed = max(end, timerValues.getCurrentWatermarkInMs() // self.step * self.step)
        yield from self._empty(end, closed)
        self._wait(closed, None)

    def close(self) -> None:
        pass


def filled_alert_windows(scored: DataFrame, flagged: Column, seconds: int = 30, delay: str = "1 minute") -> DataFrame:
    """Alerts and mean latency of every closed interval since the first alert, empty ones included, as a stream.

    ``scored`` are all rows, so their times move the watermark on when there is no alert; rows that are not ``flagged``
    are in no count. Counting is a partial aggregate; what is filled in is one row per interval.
    """
    use_rocksdb(scored.sparkSession)
    interval = F.window("event_time", f"{seconds} seconds")
    # a condition on the time too is not pushed below the watermark, which would then see alerts only
    flagged = F.when(F.col("event_time").isNotNull(), flagged)
    counted = (
        scored.withWatermark("event_time", delay)
        .filter(flagged)
        .groupBy(interval)
        .agg(F.count(F.lit(1)).alias("alerts"), F.round(F.avg("latency_ms"), 6).alias("mean_latency_ms"))
    )
    closed = counted.select(
        F.window_time("window").alias("closed"),
        F.unix_millis(F.col("window.start")).alias("start_ms"),
        "alerts",
        "mean_latency_ms",
        F.lit("all").alias("series"),
    )
    series = closed.groupBy("series").transformWithStateInPandas(FilledSeries(seconds), _INTERVAL, "append", "eventTime")
    return series.select("bucket", "alerts", "mean_latency_ms")
