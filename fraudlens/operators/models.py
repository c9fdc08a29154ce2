"""Training, scoring and evaluation of the tree-ensemble classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import datetime, timezone
from math import inf, nextafter

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.operators import evaluate
from fraudlens.operators.ordering import chronological_split
from fraudlens.schemas import (
    CARD_NUMERIC_FEATURES,
    DEFAULT_ALERT_COST,
    DEFAULT_THRESHOLD,
    MERCHANTS,
    WIDE_FEATURES,
)
from fraudlens.session import shared_dir, stage
from fraudlens.sources.runs import log_run

CARD_PARAMS = {"maxIter": 200, "maxDepth": 4, "stepSize": 0.1, "seed": 42}
WIDE_PARAMS = {
    "maxIter": 300,
    "maxDepth": 5,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}

_INPUT, _BIN = "in_", "bin_"
_CUT_ROWS = 10_000  # the learner also looks at so many rows for its candidates


def merchant_columns(vocabulary: Sequence[str] = MERCHANTS) -> list[str]:
    return [f"merchant_category_{m}" for m in vocabulary]


def _input_stage(features: Sequence[str], vocabulary: Sequence[str] = ()) -> Transformer:
    """Model inputs as a stage, so that a saved model carries its vocabulary and its defaults.

    A missing number is 0; an unknown or missing merchant is 0 in every merchant column.
    """
    inputs = [f"double(coalesce({c}, 0)) AS {_INPUT}{c}" for c in features]
    inputs += [
        f"double(coalesce(merchant_category = '{m}', false)) AS {_INPUT}merchant_category_{m}"
        for m in vocabulary
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(inputs)} FROM __THIS__")


def _fit(
    train: DataFrame,
    numeric: Sequence[str],
    vocabulary: Sequence[str],
    label: str,
    estimator: Estimator | None,
    params: dict,
) -> PipelineModel:
    """Weight the classes by neg / pos and fit."""
    shared_dir(train.sparkSession)  # boosting checkpoints its residuals there
    counts = train.agg(
        F.count(F.when(F.col(label) == 0, 1)), F.count(F.when(F.col(label) == 1, 1))
    ).first()
    if not counts[1]:
        raise ValueError("no positive rows to train on")
    weight = F.when(F.col(label) == 1, F.lit(counts[0] / counts[1])).otherwise(F.lit(1.0))
    learner = estimator or GBTClassifier(
        featuresCol="features", labelCol=label, weightCol="weight", **params
    )
    columns = [f"{_INPUT}{c}" for c in [*numeric, *merchant_columns(vocabulary)]]
    weighted, inputs = train.withColumn("weight", weight), _input_stage(numeric, vocabulary)
    if estimator is None and learner.getSubsamplingRate() == 1.0:
        return _fit_cells(weighted, sum(counts), inputs, columns, learner)
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    return Pipeline(stages=[inputs, assembler, learner]).fit(weighted)


def cut_points(values: Iterable[tuple[float, float]], most: int) -> list[float]:
    """At most about ``most`` cuts of equal weight between (value, weight) pairs, half way between neighbours.

    They are the candidates that the trees of MLlib choose from.
    """
    weights: dict[float, float] = {}
    for value, weight in values:
        weights[value] = weights.get(value, 0.0) + weight
    ordered = sorted(weights)
    middles = [(a + b) / 2 for a, b in zip(ordered, ordered[1:])]
    if len(middles) <= most:
        return middles
    stride = sum(weights.values()) / (most + 1)
    cuts, reached, target = [], weights[ordered[0]], stride
    for middle, value in zip(middles, ordered[1:]):
        before, reached = reached, reached + weights[value]
        if abs(before - target) < abs(reached - target):
            cuts.append(middle)
            target += stride
    return cuts


def _fit_cells(
    train: DataFrame, total: int, inputs: Transformer, columns: Sequence[str], learner: GBTClassifier
) -> PipelineModel:
    """Fit on one weighted row per (binned inputs, label), which is the same to the trees as all its rows.

    Trees only see bins, and rows of one cell and label have the same residual in every round, so rounds cost what there
    are cells, not rows.  Rounds that draw a part of the rows need the rows themselves.
    """
    label = learner.getLabelCol()
    rows = inputs.transform(train).select(*columns, label, "weight")
    few = rows.sample(_CUT_ROWS / total, learner.getSeed()) if total > _CUT_ROWS else rows
    few = few.toPandas()
    weights, most = few["weight"].tolist(), learner.getMaxBins() - 1
    # a value that equals a cut belongs below it, as in a tree
    cuts = {c: [nextafter(t, inf) for t in cut_points(zip(few[c].tolist(), weights), most)] for c in columns}
    splits = {c: [-inf, *(t for t in cuts[c] if t < inf), inf] for c in columns}
    binned = [c for c in columns if len(splits[c]) > 2]
    names = {c: f"{_BIN}{c}" for c in binned}
    bins = Bucketizer(splitsArray=[splits[c] for c in binned], inputCols=binned, outputCols=[*names.values()])
    # the bin without its attributes: to the learner it is a number, not a category
    places = {names[c]: (F.col(names[c]) + F.lit(0.0)) for c in binned}
    used = [*places, *(c for c in columns if c not in names)]
    cells = bins.transform(rows).withColumns(places).select(*places, *columns, label, "weight")
    cells = stage(cells.groupBy(*used, label).agg(F.sum("weight").alias("weight")), "cells")
    assembler = VectorAssembler(inputCols=[names.get(c, c) for c in columns], outputCol="features")
    return PipelineModel([inputs, bins, assembler, learner.fit(assembler.transform(cells))])


def train_card(
    train: DataFrame,
    vocabulary: Sequence[str] = MERCHANTS,
    label: str = "is_fraud",
    estimator: Estimator | None = None,
    **params,
) -> PipelineModel:
    """Fit the card model on gold rows (M1)."""
    return _fit(
        train, CARD_NUMERIC_FEATURES, vocabulary, label, estimator, CARD_PARAMS | params
    )


def train_wide(
    train: DataFrame, label: str = "is_fraud", estimator: Estimator | None = None, **params
) -> PipelineModel:
    """Fit the wide model on silver rows (M2)."""
    return _fit(train, WIDE_FEATURES, (), label, estimator, WIDE_PARAMS | params)


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """The probability of class 1 as ``score`` beside the input columns (M4)."""
    probability = vector_to_array(F.col("probability"))[1].alias("score")
    return model.transform(df).select(*df.columns, probability)


def feature_names(model: PipelineModel) -> list[str]:
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return [c.removeprefix(_BIN).removeprefix(_INPUT) for c in assembler.getInputCols()]


def feature_importance(spark, model: PipelineModel, k: int | None = None) -> DataFrame:
    """Features by importance, all or the first ``k`` (A27); one row per model input."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = spark.createDataFrame(
        list(zip(feature_names(model), values)), "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")
    return rows if k is None else rows.limit(k)


def evaluate_and_log(
    scored: DataFrame,
    runs_path: str,
    experiment: str,
    params: dict,
    label: str = "is_fraud",
    threshold: float = DEFAULT_THRESHOLD,
    start_time: datetime | None = None,
) -> DataFrame:
    """Metrics of a scored test set, appended to the run log (M5)."""
    row = evaluate.metrics_row(scored, label, "score", threshold).first().asDict()
    metrics = {name: row[name] for name in ("precision", "recall", "f1", "pr_auc")}
    spark = scored.sparkSession
    log_run(spark, runs_path, experiment, params, metrics, start_time or datetime.now(timezone.utc))
    schema = "tp bigint, fp bigint, fn bigint, tn bigint, " + ", ".join(
        f"{name} double" for name in metrics
    )
    return spark.createDataFrame([row], schema)


def cost_threshold_scores(
    df: DataFrame, keys: Sequence[str], fit: Callable[[DataFrame], PipelineModel]
) -> DataFrame:
    """All rows with their ``split`` (60 % train, 20 % validation, 20 % test) and the score of a model of the first."""
    cuts = [(0.6, "train"), (0.8, "validation"), (1.0, "test")]
    split = chronological_split(df, keys, cuts)
    return score(split, fit(split.filter("split = 'train'").drop("split")))


def cost_threshold_report(
    scored: DataFrame, amount: str = "Amount", alert_cost: float = DEFAULT_ALERT_COST, step: float = 0.02
) -> DataFrame:
    """The cheapest threshold of the validation rows beside the default one and no model, on the test rows."""
    curve = evaluate.cost_curve(
        scored.filter("split = 'validation'"),
        evaluate.threshold_grid(step),
        alert_cost,
        amount=amount,
    )
    best = evaluate.cheapest_threshold(curve).first().threshold
    strategies = {"no model": None, "default threshold": 0.5, "validation threshold": best}
    return evaluate.strategy_costs(scored.filter("split = 'test'"), strategies, alert_cost, amount=amount)


def cost_threshold_run(
    df: DataFrame,
    keys: Sequence[str],
    fit: Callable[[DataFrame], PipelineModel],
    amount: str = "Amount",
    alert_cost: float = DEFAULT_ALERT_COST,
    step: float = 0.02,
) -> DataFrame:
    """Train on 60 %, choose the cheapest threshold on 20 %, report on the last 20 % (M3)."""
    return cost_threshold_report(cost_threshold_scores(df, keys, fit), amount, alert_cost, step)
