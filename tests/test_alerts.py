import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fraudlens.operators import alerts as al
from fraudlens.schemas import CARD_ALERT

START = datetime(2024, 5, 1, 23, 58, 40)
SCHEMA = (
    "transaction_id string, card_id string, amount double, merchant_category string, country string, "
    "home_country string, score double, event_time timestamp, latency_ms double, is_fraud int"
)


def alerts(spark, seconds, **fixed):
    rows = []
    for i, s in enumerate(seconds):
        row = {
            "transaction_id": f"t{i}", "card_id": f"c{i % 2}", "amount": 10.0, "merchant_category": "atm",
            "country": "FR", "home_country": "MA", "score": 0.9, "event_time": START + timedelta(seconds=s),
            "latency_ms": float(i), "is_fraud": 1,
        } | {k: v[i] for k, v in fixed.items()}
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, SCHEMA)


def test_series_fills_gaps_across_midnight(spark):
    series = al.interval_series(alerts(spark, [0, 5, 100, 86_400 + 100])).orderBy("bucket").collect()
    first = datetime(2024, 5, 1, 23, 58, 30)
    assert [r.bucket for r in series] == [first + timedelta(seconds=30 * i) for i in range(len(series))]
    assert sum(r.alerts for r in series) == 4
    assert series[0].alerts == 2 and series[0].mean_latency_ms == 0.5
    assert series[1].alerts == 0 and series[1].mean_latency_ms is None
    assert series[-1].alerts == 1 and series[-1].bucket == datetime(2024, 5, 3, 0, 0, 0)


def test_last_minute_is_strict(spark):
    row = al.alert_kpis(alerts(spark, [0, 0.5, 30, 60])).first()
    assert (row.alerts, row.last_minute) == (4, 3)


def test_slice_bounds_are_inclusive_and_lists_apply(spark):
    df = alerts(spark, [0, 1, 2], score=[0.5, 0.49, 0.7], country=["FR", "FR", "XX"])
    assert al.alert_slice(df).count() == 2
    assert al.alert_slice(df, 0.5, countries=["FR"], merchants=["atm"]).count() == 1


def test_threshold_is_inclusive(spark):
    df = alerts(spark, [0, 1], score=[0.5, 0.4999])
    assert al.card_alerts(df).count() == 1


def test_flows_leave_out_home_and_unknown_places(spark):
    df = alerts(
        spark, range(5), country=["FR", "FR", "MA", "XX", None], home_country=["MA", "MA", "MA", "MA", "MA"]
    )
    rows = al.foreign_flows(df).collect()
    assert [(r.home_country, r.country, r.n) for r in rows] == [("MA", "FR", 2)]
    assert (rows[0].src_lon, rows[0].dst_lat) == (-7.6, 48.9)


def test_matrix_is_dense(spark):
    row = al.flow_matrix(alerts(spark, [0, 1])).first().asDict()
    assert row.pop("home_country") == "MA" and row.pop("FR") == 2 and set(row.values()) == {0}


def test_matrix_counts_every_alert(spark):
    df = alerts(spark, range(4), country=["FR", "JP", None, "FR"], home_country=["MA"] * 4)
    row = al.flow_matrix(df).first()
    assert (row.FR, row.other) == (2, 2)


def test_ties_in_frequencies_go_by_value(spark):
    assert [r.card_id for r in al.top_cards(alerts(spark, range(4)))  .collect()] == ["c0", "c1"]


def test_busiest_card_history(spark):
    df = alerts(spark, range(5))
    rows = al.card_history(df, al.busiest_card(df)).collect()
    assert [r.event_time for r in rows] == [START + timedelta(seconds=s) for s in (4, 2, 0)]


def test_messages_leave_out_nulls_and_decode_back(spark):
    df = al.card_alerts(alerts(spark, [0], country=[None]))
    df = df.withColumn("event_time", F.col("event_time").cast("string"))
    message = al.to_messages(df, "card_id").first()
    assert message.key == "c0" and "country" not in json.loads(message.value)
    assert set(json.loads(message.value)) == set(CARD_ALERT.names) - {"country"}


def test_newest_run_replaces_older_ones(spark):
    rows = [("alert", 1, 0), ("stats", 1, 1), ("alert", 2, 2), ("stats", 2, 3), ("alert", 1, 4)]
    df = spark.createDataFrame(rows, "type string, run_id bigint, n int")
    assert {r.n for r in al.newest_run(df).collect()} == {2, 3}
    assert {r.n for r in al.newest_run(df, "stats").collect()} == {3}


@pytest.mark.parametrize("batch", [1, 7, 250])
def test_replay_totals(spark, batch):
    rows = [(i, i % 3 == 0, (i * 37 % 100) / 100) for i in range(100)]
    df = spark.createDataFrame(rows, "row_idx bigint, f boolean, score double").selectExpr(
        "row_idx", "int(f) AS is_fraud", "score", "double(row_idx) AS latency_ms",
        "timestamp_seconds(row_idx) AS event_time",
    )
    found = al.replay_totals(df, batch).orderBy("batch").collect()
    for k, row in enumerate(found):
        upto = rows[: (k + 1) * batch]
        assert row.processed == len(upto)
        assert row.tp == sum(f and s >= 0.5 for _, f, s in upto)
        assert row.alerts == sum(s >= 0.5 for _, _, s in upto)
        assert row.tp + row.fp + row.fn + row.tn == len(upto)


def test_live_view_uses_the_last_statistics_of_the_newest_run(spark):
    rows = [(1, 900, 9, 9, 9, 9, 1.0), (2, 100, 1, 1, 0, 98, 2.0), (2, 200, 3, 1, 1, 195, 4.0)]
    names = "run_id bigint, processed bigint, tp bigint, fp bigint, fn bigint, tn bigint, lat_win double"
    row = al.live_run_view(spark.createDataFrame(rows, names)).first()
    assert (row.run_id, row.processed, row.alerts, row.lat_win) == (2, 200, 4, 4.0)
    assert (row.precision, row.recall) == (0.75, 0.75)


def test_retention(spark):
    df = alerts(spark, range(30))
    assert {r.transaction_id for r in al.retained_alerts(df, 3).collect()} == {"t27", "t28", "t29"}
    assert al.retained_alerts(df, 100).count() == 30
