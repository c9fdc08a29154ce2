import random

import pytest
from pyspark.sql import functions as F

from fraudlens.operators import evaluate

SCHEMA = "is_fraud int, score double, amount double"


def scored(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(5)
    rows = [
        (
            int(rng.random() < 0.2),
            rng.choice([0.0, 0.3, 0.5, 1.0, round(rng.random(), 3)]),
            round(rng.uniform(0, 90), 2),
        )
        for _ in range(400)
    ]
    rows += [(1, None, 10.0), (0, float("nan"), 3.0)]
    return scored(spark, rows).repartition(4), rows


def is_flagged(p, t):
    return p is not None and p >= t


def test_confusion_adds_up_and_counts_missing_scores_as_not_flagged(sample):
    df, rows = sample
    cells = evaluate.confusion(df).first()
    assert sum(cells) == len(rows)
    assert cells.tp == sum(y and is_flagged(p, 0.5) for y, p, _ in rows)
    assert cells.fn == sum(y and not is_flagged(p, 0.5) for y, p, _ in rows)


@pytest.mark.parametrize("step", [0.02, 0.01])
def test_grid_equals_direct_comparison(sample, step):
    df, rows = sample
    grid = evaluate.threshold_grid(step)
    found = {r.threshold: r for r in evaluate.cost_curve(df, grid).collect()}
    assert sorted(found) == grid and len(grid) == round(1 / step) - 1
    for t in grid:
        alerts = sum(is_flagged(p, t) for _, p, _ in rows)
        missed = sum(a for y, p, a in rows if y and not is_flagged(p, t))
        assert found[t].alerts == alerts
        assert found[t].cost == pytest.approx(5 * alerts + missed, abs=0.005)


def test_total_cost_agrees_with_the_curve(sample):
    df, _ = sample
    curve = {r.threshold: r.cost for r in evaluate.cost_curve(df, [0.3, 0.5]).collect()}
    for t, cost in curve.items():
        assert evaluate.total_cost(df, t).first().cost == cost


def test_cost_above_all_scores_is_the_baseline(spark):
    df = scored(spark, [(1, 0.2, 30.0), (1, 0.4, 12.5), (0, 0.4, 99.0)])
    rows = {r.strategy: r for r in evaluate.strategy_costs(df, {"none": None, "high": 0.9, "low": 0.1}).collect()}
    assert rows["none"].cost == rows["high"].cost == 42.5
    assert rows["none"].saving_pct == 0 and rows["none"].precision is None
    assert rows["high"].precision == 0 and rows["high"].recall == 0
    assert rows["low"].cost == 15 and rows["low"].recall == 1


def test_cheapest_threshold_takes_the_smallest_on_ties(spark):
    df = scored(spark, [(1, 0.9, 100.0), (0, 0.1, 5.0)])
    curve = evaluate.cost_curve(df, evaluate.threshold_grid(0.02))
    assert evaluate.cheapest_threshold(curve).first().threshold == 0.12


def test_tied_scores_give_one_point_and_the_end(spark):
    df = scored(spark, [(1, 0.5, 1.0), (0, 0.5, 1.0), (0, 0.5, 1.0), (0, 0.5, 1.0)])
    curve = {tuple(r) for r in evaluate.precision_recall_curve(df).collect()}
    assert curve == {(0.5, 0.25, 1.0), (None, 1.0, 0.0)}
    assert evaluate.average_precision(df).first()[0] == 0.25
    assert evaluate.confusion(df).first().fp == 3


def brute_average_precision(rows):
    rows = [(y, p) for y, p, _ in rows if p is not None and p == p]
    positives = sum(y for y, _ in rows)
    area = previous = 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        flagged = [y for y, p in rows if p >= t]
        recall = sum(flagged) / positives
        area += (recall - previous) * sum(flagged) / len(flagged)
        previous = recall
    return area


def test_average_precision_matches_the_definition(spark, sample):
    _, rows = sample
    clean = [r for r in rows if r[1] is not None and r[1] == r[1]]
    found = evaluate.average_precision(scored(spark, clean)).first()[0]
    assert found == pytest.approx(brute_average_precision(clean), abs=1e-6)


def test_no_positives(spark):
    df = scored(spark, [(0, 0.7, 1.0), (0, 0.2, 1.0)]).withColumn("split", F.lit("test"))
    assert evaluate.class_balance(df).first().pos_weight is None
    row = evaluate.metrics_row(df).first()
    assert (row.precision, row.recall, row.f1, row.pr_auc) == (0, 0, 0, 0)
    table = evaluate.threshold_table(df).collect()
    assert all(r.recall == 0 and r.precision == 0 for r in table)
    assert evaluate.strategy_costs(df, {"none": None}).first().saving_pct is None


def test_rows_without_label_are_in_no_cell(spark):
    df = scored(spark, [(None, 0.9, 1.0), (1, 0.9, 1.0)])
    assert tuple(evaluate.confusion(df).first()) == (1, 0, 0, 0)


def test_nothing_scored(spark):
    df = scored(spark, [])
    assert tuple(evaluate.confusion(df).first()) == (0, 0, 0, 0)
    assert evaluate.total_cost(df).first().cost == 0
    assert evaluate.average_precision(df).first()[0] == 0
