from datetime import datetime

import pytest
from test_features import brute_force, skewed_rows, tx
from test_features import features as feature_rows

from fraudlens.operators import features
from fraudlens.session import new_path
from fraudlens.sources import layout, views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark):
    layout.save_by_card(tx(spark, skewed_rows(240)), "skewed_by_card", new_path(spark, "by-card"), buckets=4)
    return layout.read_by_card(spark, "skewed_by_card")


def test_features_of_a_bucketed_table_need_no_shuffle(spark, table):
    rows = skewed_rows(240)
    assert feature_rows(table) == brute_force(rows)
    assert "Exchange" not in plan(features.card_features(table))
    assert "Exchange" in plan(features.card_features(tx(spark, rows)))
    assert "Exchange" not in plan(table.groupBy("card_id").count())


def test_a_period_opens_its_days_only(spark, sf_dir):
    source = views.card_tx(spark, sf_dir)
    layout.save_by_card(source, "period_by_card", new_path(spark, "by-day"), buckets=4)
    first, end = datetime(2024, 1, 5, 12), datetime(2024, 1, 7)
    found = layout.read_period(spark, "period_by_card", first, end)
    days = {f.split("event_date=")[1][:10] for f in found.inputFiles() if "event_date=" in f}
    assert "PartitionFilters: [isnotnull(event_date" in plan(found)
    assert sorted(found.columns) == sorted(source.columns) and len(days) > 2  # before pruning all days are known
    want = source.filter("event_time >= '2024-01-05 12:00:00' AND event_time < '2024-01-07'")
    assert found.count() == want.count() > 0
    assert found.select(*source.columns).exceptAll(want).count() == 0


def test_rows_without_time_or_card_are_kept(spark):
    rows = [("a", "c", 1.0, None), ("b", None, 2.0, 5), ("d", "c", 3.0, 86_400)]
    layout.save_by_card(tx(spark, rows), "odd_by_card", new_path(spark, "odd"), buckets=2)
    found = layout.read_by_card(spark, "odd_by_card")
    assert sorted(r.transaction_id for r in found.collect()) == ["a", "b", "d"]
    day = layout.read_period(spark, "odd_by_card", datetime(2024, 5, 1), datetime(2024, 5, 2))
    assert [r.transaction_id for r in day.collect()] == ["b"]
    layout.save_by_card(tx(spark, rows[:1]), "odd_by_card", new_path(spark, "odd"), buckets=2)  # replaced
    assert layout.read_by_card(spark, "odd_by_card").count() == 1
