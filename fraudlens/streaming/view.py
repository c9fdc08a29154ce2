"""The live view of a run as a stream (T9, P13): its newest statistics and its last alerts."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fraudlens.functions.columns import ISO_MICROS
from fraudlens.operators.alerts import with_alert_count
from fraudlens.operators.evaluate import with_prf
from fraudlens.session import use_rocksdb

SHOWN = 15
_STATS = ("processed", "tp", "fp", "fn", "tn", "lat_win")
_THIN = "type string, run_id bigint, place bigint, processed bigint, tp bigint, fp bigint, fn bigint, tn bigint, lat_win double, message string"
_VIEW = "run_id bigint, processed bigint, tp bigint, fp bigint, fn bigint, tn bigint, lat_win double, last_alerts array<string>"


def _newest_of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch of messages the newest run's last statistics and last alerts; the others cannot be shown."""
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column("run_id")))
        if not batch.num_rows:
            continue
        batch = batch.filter(pc.equal(batch.column("run_id"), pc.max(batch.column("run_id"))))
        for kind, n in (("stats", 1), ("alert", SHOWN)):
            part = batch.filter(pc.equal(batch.column("type"), kind))
            order = pc.sort_indices(part, sort_keys=[("place", "descending"), ("message", "ascending")])
            yield part.take(order[:n])


class RunView(StatefulProcessor):
    """The newest run so far: its number and statistics in one value, its last alerts in a list of bounded length."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "run_id bigint, processed bigint, tp bigint, fp bigint, fn bigint, tn bigint, lat_win double")
        self.alerts = handle.getListState("alerts", "place bigint, message string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows))
        run_id = int(found["run_id"].max())
        held = tuple(self.run.get()) if self.run.exists() else (None,) * 7
        alerts = [tuple(a) for a in self.alerts.get()] if self.alerts.exists() else []
        if held[0] is not None and held[0] > run_id:
            return  # messages of a run that is over
        if held[0] != run_id:
            held, alerts = (run_id, *(None,) * 6), []
        found = found[found["run_id"] == run_id]
        stats = found[found["type"] == "stats"]
        if len(stats):
            last = stats.sort_values("place").iloc[-1]
            if held[1] is None or int(last["place"]) >= held[1]:
                latency = None if pd.isna(last["lat_win"]) else float(last["lat_win"])
                held = (run_id, *(int(last[c]) for c in _STATS[:-1]), latency)
        new = found[found["type"] == "alert"]
        alerts += zip(new["place"].astype(int).tolist(), new["message"].tolist())
        alerts = sorted(alerts, key=lambda a: (-a[0], a[1]))[:SHOWN]
        self.run.update(held)
        self.alerts.put(alerts)
        columns = dict(zip(("run_id", *_STATS), ([v] for v in held)))
        yield pd.DataFrame(columns | {"last_alerts": [[m for _, m in alerts]]}).astype({c: "Int64" for c in ("run_id", *_STATS[:-1])})

    def close(self) -> None:
        pass


def run_view_stream(messages: DataFrame, place: str = "row_id") -> DataFrame:
    """After every micro-batch the view of the newest run: its statistics, precision, recall and last alerts.

    ``messages`` are decoded statistics and alerts of all runs; ``place`` orders alerts. A newer run starts the view
    anew, messages of older ones change nothing. Each task first keeps what can be shown of the messages
    it reads, so the one state gets at most 16 rows a batch of messages.
    """
    use_rocksdb(messages.sparkSession)
    where = F.when(F.col("type") == "stats", F.col("processed")).otherwise(F.col(place))
    whole = F.to_json(F.struct(*messages.columns), {"timestampFormat": ISO_MICROS})
    numbers = [F.col(c).cast("bigint").alias(c) for c in _STATS[:-1]]
    thin = messages.select(
        "type", F.col("run_id").cast("bigint").alias("run_id"), where.cast("bigint").alias("place"), *numbers,
        F.col("lat_win").cast("double").alias("lat_win"), whole.alias("message"),
    )
    newest = thin.filter("place IS NOT NULL").mapInArrow(_newest_of_batches, _THIN).withColumn("view", F.lit("all"))
    view = newest.groupBy("view").transformWithStateInPandas(RunView(), _VIEW, "append", "none")
    return with_prf(with_alert_count(view)).drop("f1")


def alert_rows(view: DataFrame) -> list[dict]:
    """The last alerts of a view row, newest first; at most ``SHOWN``."""
    row = view.orderBy(F.desc("run_id"), F.desc_nulls_last("processed")).select("last_alerts").first()
    return [json.loads(m) for m in row.last_alerts] if row else []
