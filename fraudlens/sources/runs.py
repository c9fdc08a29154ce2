"""Training-run log and model artefacts."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.schemas import TRAINING_RUN


def log_run(
    spark: SparkSession,
    path: str,
    experiment: str,
    params: dict,
    metrics: dict[str, float],
    start_time: datetime | None = None,
    fmt: str = "parquet",
) -> str:
    """Append one run to the log (S16) and return its id."""
    run_id = uuid.uuid4().hex
    row = (
        experiment,
        run_id,
        start_time or datetime.now(timezone.utc),
        {k: str(v) for k, v in params.items()},
        {k: None if v is None else float(v) for k, v in metrics.items()},
    )
    spark.createDataFrame([row], TRAINING_RUN).coalesce(1).write.format(fmt).mode("append").save(
        path
    )
    return run_id


def latest_run(spark: SparkSession, path: str, experiment: str, fmt: str = "parquet") -> DataFrame:
    """The newest run of an experiment."""
    runs = spark.read.format(fmt).schema(TRAINING_RUN).load(path)
    return runs.filter(F.col("experiment") == experiment).orderBy(F.desc("start_time")).limit(1)


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted model."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
