import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fraudlens.operators.features import card_features, with_merchant_columns

START = datetime(2024, 5, 1)
SCHEMA = (
    "transaction_id string, card_id string, amount double, merchant_category string, "
    "country string, home_country string, event_time timestamp, is_fraud int"
)


def tx(spark, rows):
    """rows of (id, card, amount, seconds after START)"""
    full = [
        (i, c, a, "fuel", "FR", "FR", None if s is None else START + timedelta(seconds=s), 0)
        for i, c, a, s in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def features(df, **kw):
    return {
        r.transaction_id: (r.n_prev, round(r.amount_ratio, 6), r.tx_1h, r.sec_since_prev)
        for r in card_features(df, **kw).collect()
    }


def brute_force(rows):
    """The four features row by row."""
    cards = defaultdict(list)
    for i, c, a, s in rows:
        cards[c].append((int(s), i, a))
    found = {}
    for history in cards.values():
        history.sort()
        for k, (s, i, a) in enumerate(history):
            before = history[:k]
            mean = sum(x[2] for x in before) / k if k else None
            found[i] = (
                k,
                round(a / mean, 6) if k else 1.0,
                sum(s - 3600 <= x[0] <= s - 1 for x in history),
                s - before[-1][0] if k else -1,
            )
    return found


def test_first_row_of_a_card(spark):
    assert features(tx(spark, [("a", "c", 5.0, 0)])) == {"a": (0, 1.0, 0, -1)}


@pytest.mark.parametrize("gap, in_hour", [(3600, 1), (3601, 0), (1, 1)])
def test_hour_edge(spark, gap, in_hour):
    found = features(tx(spark, [("a", "c", 5.0, 0), ("b", "c", 10.0, gap)]))
    assert found["b"] == (1, 2.0, in_hour, gap)


def test_same_second_rows_do_not_count_each_other(spark):
    found = features(tx(spark, [("b", "c", 10.0, 0.9), ("a", "c", 5.0, 0.2)]))
    assert found == {"a": (0, 1.0, 0, -1), "b": (1, 2.0, 0, 0)}


def test_rows_without_time_are_left_out(spark):
    found = features(tx(spark, [("a", "c", 5.0, None), ("b", "c", 5.0, None), ("x", "c", 1.0, 0)]))
    assert found == {"x": (0, 1.0, 0, -1)}


def skewed_rows(n=600, seed=3):
    """A third of all rows on one card, bursts within seconds, several days."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        card = "hot" if i % 3 == 0 else f"card_{rng.randrange(60)}"
        day = rng.randrange(4) * 86_400
        second = rng.choice([rng.randrange(86_400), 86_399, 0, 3_600, 100 + rng.randrange(5)])
        rows.append((f"t{rng.randrange(10**9)}-{i}", card, round(rng.uniform(0.01, 500), 2), day + second))
    return rows


@pytest.mark.parametrize("hot_card_rows", [10**9, 50, 1])
def test_skewed_cards_match_brute_force(spark, hot_card_rows):
    rows = skewed_rows()
    assert features(tx(spark, rows), hot_card_rows=hot_card_rows) == brute_force(rows)


@pytest.mark.parametrize("hot_card_rows", [10**9, 2])
def test_rows_without_card_are_one_card_on_both_plans(spark, hot_card_rows):
    rows = [(f"t{i}", None if i % 2 else "c", 1.0 + i, 700 * i) for i in range(12)]
    named = [(t, card or "none", amount, second) for t, card, amount, second in rows]
    assert features(tx(spark, rows), hot_card_rows=hot_card_rows) == brute_force(named)


def test_foreign_is_null_without_country(spark):
    row = ("t", "c", 1.0, "fuel", None, "FR", START, 0)
    df = spark.createDataFrame([row], SCHEMA)
    assert card_features(df).first().is_foreign is None


def test_unknown_merchant_has_no_column_set(spark):
    df = spark.createDataFrame([("casino",), (None,), ("atm",)], "merchant_category string")
    rows = with_merchant_columns(df).collect()
    assert [sum(r[1:]) for r in rows] == [0, 0, 1]


def test_one_shuffle_for_ordinary_cards(spark):
    df = card_features(tx(spark, [("a", "c", 5.0, 0)]).repartition(2).withColumn("x", F.lit(1)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(card_id") == 1 and plan.count("Sort [") == 1
