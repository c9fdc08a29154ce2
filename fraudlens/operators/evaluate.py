"""Decision quality and cost of a score: confusion, curves, thresholds, strategies.

Inputs are rows with a label, a score and, for costs, an amount.  Reports over a grid of
thresholds read the rows once: each row falls into one of ``len(grid) + 1`` buckets, and the
buckets are summed from the top.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.functions.columns import count_if, flag, ratio_or_zero
from fraudlens.operators.ordering import running_totals
from fraudlens.schemas import DEFAULT_ALERT_COST, DEFAULT_THRESHOLD, REPORT_THRESHOLDS


def threshold_grid(step: float) -> list[float]:
    """step, 2 x step, ... below 1, two decimals."""
    return [round(i * step, 2) for i in range(1, round(1 / step))]


def class_balance(df: DataFrame, label: str = "is_fraud", split: str = "split") -> DataFrame:
    """Rows, frauds and the weight of the positive class per split; NULL without positives."""
    negatives, positives = count_if(F.col(label) == 0), count_if(F.col(label) == 1)
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        positives.alias("frauds"),
        F.round(F.try_divide(negatives.cast("double"), positives), 6).alias("pos_weight"),
    )


def confusion_aggregates(
    label: Column, score: Column, threshold: float
) -> dict[str, Column]:
    """tp, fp, fn, tn; rows without a label are in none of them."""
    flagged = flag(score, threshold)
    return {
        "tp": count_if(flagged & (label == 1)),
        "fp": count_if(flagged & (label == 0)),
        "fn": count_if(~flagged & (label == 1)),
        "tn": count_if(~flagged & (label == 0)),
    }


def confusion(
    df: DataFrame, label: str = "is_fraud", score: str = "score", threshold=DEFAULT_THRESHOLD
) -> DataFrame:
    cells = confusion_aggregates(F.col(label), F.col(score), threshold)
    return df.agg(*[cell.alias(name) for name, cell in cells.items()])


def with_prf(df: DataFrame, digits: int = 6) -> DataFrame:
    """Precision, recall and F1 beside tp, fp, fn; 0 where the denominator is 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision = ratio_or_zero(tp, tp + fp)
    recall = ratio_or_zero(tp, tp + fn)
    return df.withColumns(
        {
            "precision": F.round(precision, digits),
            "recall": F.round(recall, digits),
            "f1": F.round(ratio_or_zero(2 * precision * recall, precision + recall), digits),
        }
    )


def precision_recall_points(
    df: DataFrame, label: str = "is_fraud", score: str = "score"
) -> DataFrame:
    """tp, flagged rows and exact precision and recall at every distinct score."""
    per_score = (
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(count_if(F.col(label) == 1).alias("pos"), F.count(F.lit(1)).alias("n"))
    )
    points = running_totals(
        per_score,
        order=[F.desc("threshold")],
        totals={"tp": ("sum", F.col("pos")), "flagged": ("sum", F.col("n"))},
    )
    positives = per_score.agg(F.sum("pos")).scalar()
    return points.select(
        "threshold",
        "pos",
        "tp",
        "flagged",
        F.try_divide(F.col("tp").cast("double"), "flagged").alias("precision"),
        # without positives every point recalls all there is
        F.coalesce(F.try_divide(F.col("tp").cast("double"), positives), F.lit(1.0)).alias(
            "recall"
        ),
        F.try_divide(F.col("pos").cast("double"), positives).alias("recall_gain"),
    )


def precision_recall_curve(
    df: DataFrame, label: str = "is_fraud", score: str = "score", digits: int = 6
) -> DataFrame:
    """One point per distinct score and the end point (recall 0, precision 1)."""
    points = precision_recall_points(df, label, score)
    curve = points.select(
        "threshold",
        F.round("precision", digits).alias("precision"),
        F.round("recall", digits).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def average_precision(
    df: DataFrame, label: str = "is_fraud", score: str = "score", digits: int = 6
) -> DataFrame:
    """Step-wise area under the precision-recall curve (A21); 0 without positives.

    The recall gained at a score depends on that score's positives alone, so no neighbour is read.
    """
    points = precision_recall_points(df, label, score)
    area = F.sum(F.col("recall_gain") * F.col("precision"))
    return points.agg(F.round(F.coalesce(area, F.lit(0.0)), digits).alias("average_precision"))


def grid_totals(
    df: DataFrame,
    grid: Sequence[float],
    label: str = "is_fraud",
    score: str = "score",
    amount: str | None = None,
) -> DataFrame:
    """Per threshold: alerts, tp, positives, amount of missed frauds.

    One pass and ``len(grid) + 1`` reduced rows instead of every row against every threshold.  A
    missing score lies below all thresholds.
    """
    grid = sorted(grid)
    low = F.lit(float("-inf"))
    spend = F.col(amount) if amount else F.lit(0.0)
    rows = df.select(
        F.coalesce(F.nanvl(F.col(score).cast("double"), low), low).alias("_score"),
        (F.col(label) == 1).alias("_pos"),
        spend.alias("_spend"),
    )
    bucketed = Bucketizer(
        splits=[float("-inf"), *grid, float("inf")], inputCol="_score", outputCol="_bucket"
    ).transform(rows)
    buckets = bucketed.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        count_if(F.col("_pos")).alias("pos"),
        F.sum(F.when(F.col("_pos"), F.col("_spend"))).alias("spend"),
    )
    # Empty buckets still are thresholds of the report.
    limits = F.array(*[F.lit(t) for t in [None, *grid]])
    all_buckets = df.sparkSession.range(len(grid) + 1).select(
        F.col("id").cast("double").alias("_bucket"),
        F.element_at(limits, (F.col("id") + 1).cast("int")).alias("threshold"),
    )
    up = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return (
        all_buckets.join(buckets, "_bucket", "left")
        .select(
            "threshold",
            F.coalesce(F.sum("n").over(up), F.lit(0)).alias("alerts"),
            F.coalesce(F.sum("pos").over(up), F.lit(0)).alias("tp"),
            F.coalesce(F.sum("pos").over(everything), F.lit(0)).alias("positives"),
            F.coalesce(F.sum("spend").over(down), F.lit(0.0)).alias("missed_amount"),
        )
        .filter(F.col("threshold").isNotNull())
    )


def threshold_table(
    df: DataFrame,
    thresholds: Sequence[float] = REPORT_THRESHOLDS,
    label: str = "is_fraud",
    score: str = "score",
) -> DataFrame:
    """Precision, recall and alerts at a few thresholds."""
    return grid_totals(df, thresholds, label, score).select(
        "threshold",
        F.round(ratio_or_zero(F.col("tp"), F.col("alerts")), 3).alias("precision"),
        F.round(ratio_or_zero(F.col("tp"), F.col("positives")), 3).alias("recall"),
        "alerts",
    )


def total_cost(
    df: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    alert_cost: float = DEFAULT_ALERT_COST,
    label: str = "is_fraud",
    score: str = "score",
    amount: str = "amount",
) -> DataFrame:
    """Alert cost plus the amount of frauds below the threshold."""
    flagged = flag(F.col(score), threshold)
    missed = F.when(~flagged & (F.col(label) == 1), F.col(amount))
    return (
        df.agg(
            count_if(flagged).alias("alerts"),
            F.coalesce(F.sum(missed), F.lit(0.0)).alias("missed_amount"),
        )
        .withColumn(
            "cost", F.round(F.lit(float(alert_cost)) * F.col("alerts") + F.col("missed_amount"), 2)
        )
        .withColumn("missed_amount", F.round("missed_amount", 2))
    )


def cost_curve(
    df: DataFrame,
    grid: Sequence[float],
    alert_cost: float = DEFAULT_ALERT_COST,
    label: str = "is_fraud",
    score: str = "score",
    amount: str = "amount",
) -> DataFrame:
    """Total cost at every threshold of the grid."""
    cost = F.lit(float(alert_cost)) * F.col("alerts") + F.col("missed_amount")
    return grid_totals(df, grid, label, score, amount).select(
        "threshold", "alerts", F.round(cost, 2).alias("cost")
    )


def cheapest_threshold(curve: DataFrame) -> DataFrame:
    """The threshold of lowest cost, the smallest one on ties."""
    return curve.orderBy("cost", "threshold").limit(1).select("threshold", "cost")


def strategy_costs(
    df: DataFrame,
    strategies: dict[str, float | None],
    alert_cost: float = DEFAULT_ALERT_COST,
    label: str = "is_fraud",
    score: str = "score",
    amount: str = "amount",
) -> DataFrame:
    """Cost, saving against no model, precision, recall and alerts per strategy.

    ``strategies`` maps a name to its threshold; None stands for no model at all.
    """
    is_pos = F.col(label) == 1
    cells = []
    for i, threshold in enumerate(strategies.values()):
        flagged = F.lit(False) if threshold is None else flag(F.col(score), threshold)
        cells += [
            count_if(flagged).alias(f"alerts_{i}"),
            count_if(flagged & is_pos).alias(f"tp_{i}"),
            F.sum(F.when(~flagged & is_pos, F.col(amount))).alias(f"missed_{i}"),
        ]
    totals = df.agg(
        count_if(is_pos).alias("positives"), F.sum(F.when(is_pos, F.col(amount))).alias("base"),
        *cells,
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("strategy"),
                F.lit(t).cast("double").alias("threshold"),
                F.col(f"alerts_{i}").alias("alerts"),
                F.col(f"tp_{i}").alias("tp"),
                F.coalesce(f"missed_{i}", F.lit(0.0)).alias("missed"),
            )
            for i, (name, t) in enumerate(strategies.items())
        ]
    )
    cost = F.lit(float(alert_cost)) * F.col("alerts") + F.col("missed")
    used = F.col("threshold").isNotNull()
    return totals.select("positives", "base", F.inline(rows)).select(
        "strategy",
        "threshold",
        F.round(cost, 2).alias("cost"),
        F.round(100 * (1 - F.try_divide(cost, F.col("base"))), 4).alias("saving_pct"),
        F.when(used, F.round(ratio_or_zero(F.col("tp"), F.col("alerts")), 3)).alias("precision"),
        F.when(used, F.round(ratio_or_zero(F.col("tp"), F.col("positives")), 3)).alias("recall"),
        "alerts",
    )


def metrics_row(
    df: DataFrame, label: str = "is_fraud", score: str = "score", threshold=DEFAULT_THRESHOLD
) -> DataFrame:
    """Confusion cells, precision, recall, F1 and average precision in one row (M5)."""
    area = average_precision(df, label, score).scalar().alias("pr_auc")
    return with_prf(confusion(df, label, score, threshold)).select("*", area)

