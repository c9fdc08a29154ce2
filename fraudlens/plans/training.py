"""Queries that train, score and log models.

What a model predicts no SQL can tell. So each result comes twice: one query returns what must hold of any right run,
for SQL to check (which rows were scored, how totals agree, how many scores differ between two ways), and one the
metrics, importances and costs themselves, which a test holds against a brute-force evaluation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens.functions.columns import iso_to_timestamp
from fraudlens.operators import evaluate, features, models, ordering, silver
from fraudlens.operators.alerts import to_messages
from fraudlens.plans.layers import TRAIN_TEST, TX_KEYS
from fraudlens.plans.registry import query
from fraudlens.plans.streams import by_week, drained
from fraudlens.schemas import CARD_ALERT, CARD_TX
from fraudlens.session import new_path, stage
from fraudlens.sources import runs, views
from fraudlens.streaming import scoring

_FITTED: dict[tuple[str, str, str], str] = {}


def _fitted(spark, sf: str, kind: str, fit) -> str:
    """Folder of a model that is trained once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _FITTED:
        path = new_path(spark, f"{kind}-model")
        runs.save_model(fit(), path)
        _FITTED[key] = path
    return _FITTED[key]


def _card_split(spark, sf):
    gold = stage(features.card_features(views.card_tx(spark, sf)), "gold")
    return ordering.chronological_split(gold, TX_KEYS, TRAIN_TEST)


def _card_model(spark, sf, split=None):
    def fit():
        train = (split or _card_split(spark, sf)).filter("split = 'train'")
        return models.train_card(train, views.TEST_MERCHANTS)

    return runs.load_model(_fitted(spark, sf, "card", fit))


def card_test(spark, sf):
    """The last fifth of the card rows with the scores of a model fitted on the others."""
    split = _card_split(spark, sf)
    return stage(models.score(split.filter("split = 'test'"), _card_model(spark, sf, split)), "scored")


def wide_test(spark, sf):
    """The same for wide rows."""
    split = _wide_split(spark, sf)
    return stage(models.score(split.filter("split = 'test'"), _wide_model(spark, sf, split)), "scored")


def _wide_split(spark, sf):
    wide = stage(views.wide_tx(spark, sf), "wide")
    return ordering.chronological_split(wide, ["row_id"], TRAIN_TEST)


def _wide_model(spark, sf, split=None):
    def fit():
        return models.train_wide((split or _wide_split(spark, sf)).filter("split = 'train'"))

    return runs.load_model(_fitted(spark, sf, "wide", fit))


def _logged_run(spark, scored, experiment: str, params: dict):
    """Rows and positives of the evaluation, and how far the run log is from it."""
    path = new_path(spark, "runs")
    found = models.evaluate_and_log(scored, path, experiment, params)
    run = runs.latest_run(spark, path, experiment)
    logged = [F.col("metrics")[m].alias(f"logged_{m}") for m in ("precision", "recall", "f1", "pr_auc")]
    right = (
        F.col("precision").eqNullSafe(F.col("logged_precision"))
        & F.col("recall").eqNullSafe(F.col("logged_recall"))
        & F.col("f1").eqNullSafe(F.col("logged_f1"))
        & F.col("pr_auc").eqNullSafe(F.col("logged_pr_auc"))
    )
    run = run.select("experiment", F.col("params.maxIter").alias("trees"), *logged)
    joined = run.join(found, F.lit(True))  # one row each
    return joined.select(
        "experiment",
        "trees",
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("test_rows"),
        (F.col("tp") + F.col("fn")).alias("positives"),
        right.alias("log_is_right"),
        F.col("pr_auc").between(0, 1).alias("area_in_range"),
    )


def _metrics(spark, scored, experiment: str, params: dict):
    """What was found, beside what the run log holds of it."""
    path = new_path(spark, "runs")
    found = models.evaluate_and_log(scored, path, experiment, params)
    names = ("precision", "recall", "f1", "pr_auc")
    run = runs.latest_run(spark, path, experiment)
    run = run.select("experiment", *[F.col("metrics")[m].alias(m) for m in names])
    return run.join(found.drop(*names), F.lit(True))  # one row each


@query(
    "train_card",
    """SELECT 'fraud-detection' AS experiment, '200' AS trees, count(*) AS test_rows,
      count(*) FILTER (is_fraud = 1) AS positives, true AS log_is_right, true AS area_in_range
    FROM splits WHERE split = 'test'""",
    views=("splits",),
)
def train_card(spark, sf):
    """Train on the past, save, load, evaluate on the future, log the run."""
    return _logged_run(spark, card_test(spark, sf), "fraud-detection", models.CARD_PARAMS)


@query("train_card_metrics")
def train_card_metrics(spark, sf):
    """Confusion cells, precision, recall, F1 and area of the card model on the last fifth, as read from the run log."""
    return _metrics(spark, card_test(spark, sf), "fraud-detection", models.CARD_PARAMS)


_WIDE_TEST = "FROM wide WHERE row_id IN (SELECT row_id FROM wide_index WHERE place >= floor(total * 0.8e0))"


@query(
    "train_wide",
    f"""SELECT 'fraud-detection-real' AS experiment, '300' AS trees, count(*) AS test_rows,
      count(*) FILTER (is_fraud = 1) AS positives, true AS log_is_right, true AS area_in_range
    {_WIDE_TEST}""",
    views=("wide_index",),
)
def train_wide(spark, sf):
    return _logged_run(spark, wide_test(spark, sf), "fraud-detection-real", models.WIDE_PARAMS)


@query("train_wide_metrics")
def train_wide_metrics(spark, sf):
    return _metrics(spark, wide_test(spark, sf), "fraud-detection-real", models.WIDE_PARAMS)


@query(
    "feature_importance",
    """SELECT unnest(list_concat(['Amount'], ['V' || i FOR i IN range(1, 29)])) AS feature,
      true AS in_range, 1.0e0 AS total""",
)
def feature_importance(spark, sf):
    """Every model input once, with importances that are shares of one whole."""
    found = models.feature_importance(spark, _wide_model(spark, sf))
    total = found.agg(F.round(F.sum("importance"), 6)).scalar()
    return found.select(
        "feature", F.col("importance").between(0, 1).alias("in_range"), total.alias("total")
    )


@query("feature_importance_values")
def feature_importance_values(spark, sf):
    """The importance of every input of the wide model."""
    return models.feature_importance(spark, _wide_model(spark, sf)).withColumn("importance", F.round("importance", 6))


def cost_scores(spark, sf):
    """Scores of all wide rows by a model of the first 60 %, fitted once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf, "cost-scores")
    if key not in _FITTED:
        path = new_path(spark, "cost-scores")
        wide = stage(views.wide_tx(spark, sf), "wide")
        scored = models.cost_threshold_scores(wide, ["row_id"], models.train_wide)
        scored.select("row_id", "split", "is_fraud", "Amount", "score").write.parquet(path)
        _FITTED[key] = path
    return spark.read.parquet(_FITTED[key])


@query("cost_threshold_costs")
def cost_threshold_costs(spark, sf):
    """Threshold, cost, saving, precision, recall and alerts of each strategy on the last fifth."""
    return models.cost_threshold_report(cost_scores(spark, sf))


@query(
    "cost_threshold_run",
    f"""SELECT strategy, CASE strategy WHEN 'no model' THEN base END AS cost,
      strategy <> 'no model' AS has_threshold, CASE strategy WHEN 'no model' THEN 0 END AS alerts,
      true AS saving_is_right, true AS shares_in_range
    FROM (SELECT round(sum(Amount) FILTER (is_fraud = 1), 2) AS base {_WIDE_TEST}) b,
      (VALUES ('no model'), ('default threshold'), ('validation threshold')) s(strategy)""",
    views=("wide_index",),
)
def cost_threshold_run(spark, sf):
    """Cost without a model, and how cost and saving of the others agree with it."""
    found = stage(models.cost_threshold_report(cost_scores(spark, sf)), "costs")
    none = F.col("strategy") == "no model"
    base = found.filter(none).agg(F.max("cost")).scalar()
    saving = 100 * (1 - F.col("cost") / base)
    share = [F.coalesce(F.col(c).between(0, 1), F.lit(True)) for c in ("precision", "recall")]
    return found.select(
        "strategy",
        F.when(none, F.col("cost")).alias("cost"),
        F.col("threshold").isNotNull().alias("has_threshold"),
        F.when(none, F.col("alerts")).alias("alerts"),
        (F.abs(F.col("saving_pct") - saving) < 0.01).alias("saving_is_right"),
        (share[0] & share[1]).alias("shares_in_range"),
    )


@query(
    "stream_scoring",
    """SELECT transaction_id, amount, false AS differs FROM tx_raw
    WHERE card_id IS NOT NULL AND country IS NOT NULL""",
    views=("tx_raw",),
)
def stream_scoring(spark, sf):
    """Card topic to features, scores and published messages, live, beside scores of gold rows.

    The threshold is 0, so every scored row is published and can be compared.
    """
    model = _card_model(spark, sf)
    records = by_week(views.card_topic(spark, sf, offsets=False), "timestamp")

    def published(stream):
        alerts = scoring.live_card_alerts(silver.envelope(stream), model, threshold=0.0)
        return to_messages(alerts, "card_id")

    live = silver.decode(drained(records, "fraud-alerts", published), CARD_ALERT)
    accepted = silver.scorable(silver.decode(silver.envelope(records.drop("step")), CARD_TX))
    accepted = accepted.withColumn("event_time", iso_to_timestamp(F.col("event_time")))
    gold = features.card_features(accepted.dropna(subset=["card_id", "amount", "event_time"]))
    batch = models.score(gold, model).select("transaction_id", F.col("score").alias("batch_score"))
    differs = F.coalesce(F.abs(F.col("score") - F.col("batch_score")) > 0.0001, F.lit(True))
    return live.join(batch, "transaction_id", "left").select(
        "transaction_id", "amount", differs.alias("differs")
    )


@query(
    "latest_run",
    """SELECT 'fraud-detection' AS experiment, '0.5' AS threshold, tp / CAST(tp + fp AS DOUBLE) AS precision,
      tp / CAST(tp + fn AS DOUBLE) AS recall FROM cells""",
    views=("cells",),
)
def latest_run(spark, sf):
    """Log two evaluations and read the newer one back."""
    scored = views.card_tx(spark, sf)
    path = new_path(spark, "runs")
    for threshold in (0.9, 0.5):
        row = evaluate.confusion(scored, threshold=threshold).first()
        metrics = {
            "precision": row.tp / (row.tp + row.fp),
            "recall": row.tp / (row.tp + row.fn),
        }
        runs.log_run(spark, path, "fraud-detection", {"threshold": threshold}, metrics)
    run = runs.latest_run(spark, path, "fraud-detection")
    return run.select(
        "experiment",
        F.col("params.threshold").alias("threshold"),
        F.col("metrics.precision").alias("precision"),
        F.col("metrics.recall").alias("recall"),
    )
