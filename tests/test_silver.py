import json

import pytest
from pyspark.sql import functions as F

from fraudlens.operators import quality, silver
from fraudlens.schemas import CARD_TX, ENVELOPE, WIDE_TX

GOOD = {
    "transaction_id": "t1",
    "card_id": "c1",
    "amount": 12.5,
    "merchant_category": "fuel",
    "country": "FR",
    "home_country": "MA",
    "event_time": "2024-03-01T10:00:00.123456+00:00",
    "is_fraud": 0,
}


def bronze(spark, values):
    rows = [
        ("k", v if v is None or isinstance(v, str) else json.dumps(v), "transactions", 0, i, None)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


def without(key):
    return {k: v for k, v in GOOD.items() if k != key}


@pytest.mark.parametrize(
    "value",
    [
        "{bad",
        None,
        without("transaction_id"),
        without("card_id"),
        without("is_fraud"),
        without("amount"),
        GOOD | {"amount": "1.5"},
        GOOD | {"amount": 0},
        GOOD | {"amount": -3.0},
        GOOD | {"is_fraud": 1.0},
    ],
)
def test_invalid_card_rows_are_left_out(spark, value):
    assert silver.silver_card(bronze(spark, [value])).count() == 0


def test_valid_row_is_typed(spark):
    row = silver.silver_card(bronze(spark, [GOOD])).first()
    assert row.amount == 12.5 and row.is_fraud == 0
    assert row.event_time.microsecond == 123456


def test_bad_time_is_kept_as_null(spark):
    row = silver.silver_card(bronze(spark, [GOOD | {"event_time": "nope"}])).first()
    assert row is not None and row.event_time is None


def test_offset_of_the_time_is_applied(spark):
    text = GOOD | {"event_time": "2024-03-01T12:00:00+02:00"}
    assert silver.silver_card(bronze(spark, [text])).first().event_time.hour == 10


def test_wide_zero_amount_is_valid_and_negative_is_not(spark):
    base = {f"V{i}": 0.1 for i in range(1, 29)} | {"event_time": GOOD["event_time"], "is_fraud": 1}
    values = [
        base | {"row_id": 1, "Amount": 0.0},
        base | {"row_id": 2, "Amount": -0.01},
        base | {"row_id": 3, "Amount": 5.0, "is_fraud": 2},
        base | {"Amount": 5.0},
        base | {"row_id": 4},
    ]
    assert [r.row_id for r in silver.silver_wide(bronze(spark, values)).collect()] == [1]


def test_wide_keeps_the_first_copy(spark):
    base = {f"V{i}": 0.1 for i in range(1, 29)} | {"event_time": GOOD["event_time"], "is_fraud": 0}
    copies = [base | {"row_id": 7, "Amount": float(i)} for i in range(50)]
    rows = silver.silver_wide(bronze(spark, copies).orderBy(F.desc("offset"))).collect()
    assert [(r.row_id, r.Amount) for r in rows] == [(7, 0.0)]


def test_scorer_accepts_what_silver_rejects(spark):
    values = [without("is_fraud"), without("country"), without("event_time"), GOOD]
    decoded = silver.decode(bronze(spark, values), CARD_TX)
    assert silver.scorable(decoded).count() == 2


def test_reject_reasons_use_the_first_failing_check(spark):
    values = ["{bad", without("card_id"), without("is_fraud"), GOOD | {"amount": 0}, GOOD]
    decoded = silver.decode(bronze(spark, values), CARD_TX)
    counts = dict(map(tuple, silver.reject_counts(decoded, silver.card_checks()).collect()))
    assert counts == {
        "transaction_id missing": 1,
        "card_id missing": 1,
        "is_fraud missing": 1,
        "amount not positive": 1,
        "accepted": 1,
    }


def test_text_is_parsed_once(spark):
    plan = silver.silver_card(bronze(spark, [GOOD]))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") == 1


def test_reconcile_statuses(spark):
    manifest = spark.createDataFrame(
        [(0, 3), (1, 3), (2, 3), (3, 2), (4, 1), (6, 2)], "partition int, source_rows bigint"
    )
    offsets = {0: [0, 1, 2], 1: [0, 1], 2: [0, 1, 1], 3: [0, 1, 2], 5: [0], 6: [0, 5]}
    rows = [("k", "v", "t", p, o, None) for p, os in offsets.items() for o in os]
    found = quality.reconcile(manifest, spark.createDataFrame(rows, ENVELOPE)).collect()
    assert {r.partition: r.status for r in found} == {
        0: "ok",
        1: "missing rows",
        2: "repeated offsets",
        3: "extra rows",
        4: "missing rows",
        5: "extra rows",
        6: "offset gap",
    }


def test_wide_schema_lists_all_values():
    assert len(WIDE_TX.fields) == 32


def test_raw_label_counts_keep_null(spark):
    counts = quality.raw_label_counts(bronze(spark, [GOOD, GOOD, without("is_fraud")]))
    assert {tuple(r) for r in counts.collect()} == {("0", 2), (None, 1)}


def test_alert_rate_without_transactions(spark):
    none = spark.createDataFrame([], "n bigint")
    some = spark.createDataFrame([(3,)], "n bigint")
    assert quality.alert_rate(none, some).first().alert_rate is None
    assert quality.alert_rate(some, some).first().alert_rate == 100.0
