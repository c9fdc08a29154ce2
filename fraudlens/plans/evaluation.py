"""Queries over scored transactions: confusion, curves, costs; and exploration."""

from __future__ import annotations

from fraudlens.operators import evaluate, explore
from fraudlens.plans.layers import TRAIN_VALIDATION_TEST, split_tx
from fraudlens.plans.registry import query
from fraudlens.schemas import REPORT_THRESHOLDS, WIDE_FEATURES
from fraudlens.sources import views


@query(
    "class_balance",
    """SELECT split3 AS split, count(*) AS rows, count(*) FILTER (is_fraud = 1) AS frauds,
      round(count(*) FILTER (is_fraud = 0) / CAST(nullif(count(*) FILTER (is_fraud = 1), 0) AS DOUBLE), 6)
        AS pos_weight
    FROM splits GROUP BY split3""",
    views=("splits",),
)
def class_balance(spark, sf):
    return evaluate.class_balance(split_tx(spark, sf, TRAIN_VALIDATION_TEST))


@query("confusion", "SELECT * FROM cells", views=("cells",))
def confusion(spark, sf):
    return evaluate.confusion(views.card_tx(spark, sf))


@query(
    "prf",
    """SELECT tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall,
      round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1
    FROM (SELECT *, coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS p,
      coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) AS r FROM cells) c""",
    views=("cells",),
)
def prf(spark, sf):
    return evaluate.with_prf(evaluate.confusion(views.card_tx(spark, sf)))


@query(
    "pr_curve",
    """SELECT threshold, round(tp / CAST(flagged AS DOUBLE), 6) AS precision,
      round(tp / CAST(positives AS DOUBLE), 6) AS recall FROM curve
    UNION ALL SELECT NULL, 1.0e0, 0.0e0""",
    views=("curve",),
)
def pr_curve(spark, sf):
    return evaluate.precision_recall_curve(views.card_tx(spark, sf))


@query(
    "average_precision",
    """SELECT round(sum((recall - previous) * precision), 6) AS average_precision
    FROM (SELECT tp / CAST(flagged AS DOUBLE) AS precision, tp / CAST(positives AS DOUBLE) AS recall,
      lag(tp / CAST(positives AS DOUBLE), 1, 0.0e0) OVER (ORDER BY threshold DESC) AS previous
      FROM curve) c""",
    views=("curve",),
)
def average_precision(spark, sf):
    return evaluate.average_precision(views.card_tx(spark, sf))


@query(
    "threshold_table",
    f"""SELECT t AS threshold,
      round(coalesce(count(*) FILTER (score >= t AND is_fraud = 1)
        / CAST(nullif(count(*) FILTER (score >= t), 0) AS DOUBLE), 0), 3) AS precision,
      round(coalesce(count(*) FILTER (score >= t AND is_fraud = 1)
        / CAST(nullif(count(*) FILTER (is_fraud = 1), 0) AS DOUBLE), 0), 3) AS recall,
      count(*) FILTER (score >= t) AS alerts
    FROM tx, (SELECT unnest([{", ".join(f"{t}e0" for t in REPORT_THRESHOLDS)}]) AS t) g GROUP BY t""",
    views=("tx",),
)
def threshold_table(spark, sf):
    return evaluate.threshold_table(views.card_tx(spark, sf))


@query(
    "total_cost",
    """SELECT count(*) FILTER (score >= 0.5) AS alerts,
      round(coalesce(sum(amount) FILTER (score < 0.5 AND is_fraud = 1), 0), 2) AS missed_amount,
      round(5.0e0 * count(*) FILTER (score >= 0.5)
        + coalesce(sum(amount) FILTER (score < 0.5 AND is_fraud = 1), 0), 2) AS cost
    FROM tx""",
    views=("tx",),
)
def total_cost(spark, sf):
    return evaluate.total_cost(views.card_tx(spark, sf))


@query(
    "cost_curve",
    """SELECT t AS threshold, count(*) FILTER (score >= t) AS alerts,
      round(5.0e0 * count(*) FILTER (score >= t)
        + coalesce(sum(amount) FILTER (score < t AND is_fraud = 1), 0), 2) AS cost
    FROM (SELECT * FROM splits WHERE split = 'test') s,
      (SELECT round(i * 0.01e0, 2) AS t FROM range(1, 100) r(i)) g
    GROUP BY t""",
    views=("splits",),
)
def cost_curve(spark, sf):
    test = split_tx(spark, sf).filter("split = 'test'")
    return evaluate.cost_curve(test, evaluate.threshold_grid(0.01))


@query("best_threshold", "SELECT threshold, cost FROM best", views=("best",))
def best_threshold(spark, sf):
    validation = split_tx(spark, sf, TRAIN_VALIDATION_TEST).filter("split = 'validation'")
    curve = evaluate.cost_curve(validation, evaluate.threshold_grid(0.02))
    return evaluate.cheapest_threshold(curve)


@query(
    "strategy_costs",
    """SELECT strategy, threshold, round(5.0e0 * alerts + missed, 2) AS cost,
      round(100 * (1 - (5.0e0 * alerts + missed) / nullif(base, 0)), 4) AS saving_pct,
      CASE WHEN threshold IS NOT NULL THEN round(coalesce(tp / CAST(nullif(alerts, 0) AS DOUBLE), 0), 3) END
        AS precision,
      CASE WHEN threshold IS NOT NULL THEN round(coalesce(tp / CAST(nullif(positives, 0) AS DOUBLE), 0), 3) END
        AS recall,
      alerts
    FROM (
      SELECT strategy, threshold, count(*) FILTER (score >= coalesce(threshold, 'infinity'::DOUBLE)) AS alerts,
        count(*) FILTER (score >= coalesce(threshold, 'infinity'::DOUBLE) AND is_fraud = 1) AS tp,
        count(*) FILTER (is_fraud = 1) AS positives,
        coalesce(sum(amount) FILTER (is_fraud = 1), 0) AS base,
        coalesce(sum(amount) FILTER (score < coalesce(threshold, 'infinity'::DOUBLE) AND is_fraud = 1), 0) AS missed
      FROM (SELECT * FROM splits WHERE split3 = 'test') s,
        (SELECT 'no model' AS strategy, CAST(NULL AS DOUBLE) AS threshold
         UNION ALL SELECT 'default threshold', 0.5e0
         UNION ALL SELECT 'validation threshold', threshold FROM best) g
      GROUP BY strategy, threshold) t""",
    views=("best",),
)
def strategy_costs(spark, sf):
    split = split_tx(spark, sf, TRAIN_VALIDATION_TEST)
    curve = evaluate.cost_curve(
        split.filter("split = 'validation'"), evaluate.threshold_grid(0.02)
    )
    best = evaluate.cheapest_threshold(curve).first().threshold
    strategies = {"no model": None, "default threshold": 0.5, "validation threshold": best}
    return evaluate.strategy_costs(split.filter("split = 'test'"), strategies)


# -- exploration -----------------------------------------------------------------------------


@query(
    "overview",
    """SELECT count(*) AS rows, count(*) FILTER (is_fraud = 1) AS frauds,
      round(100.0e0 * count(*) FILTER (is_fraud = 1) / nullif(count(*), 0), 6) AS fraud_pct,
      round(avg(Amount) FILTER (is_fraud = 1), 6) AS mean_amount_fraud,
      round(avg(Amount) FILTER (is_fraud = 0), 6) AS mean_amount_normal
    FROM wide""",
    views=("wide",),
)
def overview(spark, sf):
    return explore.overview(views.wide_tx(spark, sf))


@query(
    "fraud_bins",
    """SELECT CAST(greatest(0, ceil((event_id - lo) * 40.0e0 / (hi - lo)) - 1) AS INT) AS bin,
      count(*) FILTER (is_fraud = 1) AS frauds
    FROM tx, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM tx) m GROUP BY bin""",
    views=("tx",),
)
def fraud_bins(spark, sf):
    return explore.label_bins(views.card_tx(spark, sf), "event_id")


def _describe_sql(group: str, value: str, view: str) -> str:
    quantiles = ", ".join(
        f"round_even(quantile_cont({value}, 0.{q}), 2) AS p{q}" for q in (25, 50, 75)
    )
    return f"""SELECT {group} AS classe, count({value}) AS count, round_even(avg({value}), 2) AS mean,
      round_even(stddev_samp({value}), 2) AS std, round_even(min({value}), 2) AS min, {quantiles},
      round_even(max({value}), 2) AS max
    FROM {view} GROUP BY classe"""


_CLASS = "CASE WHEN is_fraud = 1 THEN 'Fraude' WHEN is_fraud = 0 THEN 'Normale' END"


@query("describe_by_class", _describe_sql(_CLASS, "amount", "tx"), views=("tx",))
def describe_by_class(spark, sf):
    return explore.describe(views.card_tx(spark, sf), "amount")


@query("describe_sketched")
def describe_sketched(spark, sf):
    """The same with quartiles from sketches; a test holds their ranks against the table."""
    return explore.describe(views.card_tx(spark, sf), "amount", sketch=800)


@query("describe_overall", _describe_sql("'all'", "Amount", "wide"), views=("wide",))
def describe_overall(spark, sf):
    return explore.describe(views.wide_tx(spark, sf), "Amount", label=None)


def _histogram_sql(column: str, bins: int, group: str, view: str) -> str:
    return f"""SELECT classe, bin, n,
      round(CAST(n AS DOUBLE) / (CAST(sum(n) OVER (PARTITION BY classe) AS BIGINT) * width), 6) AS density
    FROM (SELECT {group} AS classe,
        CAST(least({bins - 1}, floor(({column} - lo) * {bins}.0e0 / (hi - lo))) AS INT) AS bin,
        (hi - lo) / {bins}.0e0 AS width, count(*) AS n
      FROM {view}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {view}) m
      GROUP BY classe, bin, width) h"""


@query("hist_score", _histogram_sql("score", 25, "'all'", "alerts"), views=("alerts",))
def hist_score(spark, sf):
    return explore.histogram(views.alerts(spark, sf), "score", 25)


@query("hist_amount", _histogram_sql("amount", 30, "'all'", "alerts"), views=("alerts",))
def hist_amount(spark, sf):
    return explore.histogram(views.alerts(spark, sf), "amount", 30)


@query("hist_amount_by_class", _histogram_sql("amount", 60, _CLASS, "tx"), views=("tx",))
def hist_amount_by_class(spark, sf):
    return explore.histogram(views.card_tx(spark, sf), "amount", 60, "is_fraud")


@query("hist_density", _histogram_sql("V14", 60, _CLASS, "wide"), views=("wide",))
def hist_density(spark, sf):
    return explore.histogram(views.wide_tx(spark, sf), "V14", 60, "is_fraud")


@query(
    "corr_top15",
    "SELECT feature, round(abs_corr, 6) AS abs_corr FROM ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, abs(corr({f}, is_fraud)) AS abs_corr FROM wide"
        for f in WIDE_FEATURES
    )
    + ") c ORDER BY round(abs_corr, 6) DESC NULLS LAST, feature LIMIT 15",
    views=("wide",),
)
def corr_top15(spark, sf):
    return explore.label_correlation(views.wide_tx(spark, sf), WIDE_FEATURES)


@query(
    "stratified_sample",
    """SELECT transaction_id, amount, is_fraud FROM tx WHERE is_fraud = 1
    UNION ALL (SELECT transaction_id, amount, is_fraud FROM tx WHERE is_fraud = 0
      ORDER BY md5(concat('3:', transaction_id)), transaction_id LIMIT 3000)""",
    views=("tx",),
)
def stratified_sample(spark, sf):
    rows = views.card_tx(spark, sf).select("transaction_id", "amount", "is_fraud")
    return explore.stratified_sample(rows, "transaction_id", 3000, seed=3)
