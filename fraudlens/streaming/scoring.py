"""Messages to features to scores to alerts, live."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fraudlens.functions.columns import elapsed_ms, iso_to_timestamp
from fraudlens.operators import silver
from fraudlens.operators.alerts import card_alerts, wide_alerts
from fraudlens.operators.models import score
from fraudlens.schemas import CARD_TX, DEFAULT_THRESHOLD, WIDE_TX
from fraudlens.streaming import split
from fraudlens.streaming.state import live_features


def with_latency(scored: DataFrame, scored_at: Column | None = None) -> DataFrame:
    """Milliseconds from the event to its scoring (T4).

    The default clock is read once per micro-batch.
    """
    clock = F.current_timestamp() if scored_at is None else scored_at
    return scored.withColumn("latency_ms", elapsed_ms(F.col("event_time"), clock))


def card_messages(bronze: DataFrame) -> DataFrame:
    """Bronze card messages that can be scored.

    Messages without card, amount or readable time have no history to belong to and are left out.
    """
    messages = silver.scorable(silver.decode(bronze, CARD_TX))
    messages = messages.withColumn("event_time", iso_to_timestamp(F.col("event_time")))
    return messages.dropna(subset=["event_time", "card_id", "amount"])


def score_cards(bronze: DataFrame, model: PipelineModel, state: str = "group") -> DataFrame:
    """Bronze card messages to scored rows with latency; features use earlier rows only."""
    return with_latency(score(live_features(card_messages(bronze), state), model))


def start_split_scores(
    bronze: DataFrame,
    model: PipelineModel,
    save: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """The same scores with cards split over keys: ``save(scored rows, epoch)`` gets every micro-batch."""

    def scored(rows: DataFrame, epoch: int) -> None:
        save(with_latency(score(rows, model)), epoch)

    return split.start_features(card_messages(bronze), scored, checkpoint, every=every)


def score_wide(bronze: DataFrame, model: PipelineModel) -> DataFrame:
    """Bronze wide messages to scored rows with latency; there is no state.

    Messages without id, amount or readable time are left out; the progress of the stream reports
    their number as the observed metric ``messages.rejected``.
    """
    rows = silver.decode(bronze, WIDE_TX)
    rows = rows.withColumn("event_time", iso_to_timestamp(F.col("event_time")))
    accepted = silver.wide_scorable()
    rows = rows.observe(
        "messages",
        F.count(F.lit(1)).alias("read"),
        F.count(F.when(~accepted, F.lit(1))).alias("rejected"),
    )
    return with_latency(score(rows.filter(accepted), model))


def live_card_alerts(
    bronze: DataFrame,
    model: PipelineModel,
    threshold: float = DEFAULT_THRESHOLD,
    state: str = "group",
) -> DataFrame:
    return card_alerts(score_cards(bronze, model, state), threshold)


def live_wide_alerts(
    bronze: DataFrame, model: PipelineModel, run_id: int, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    return wide_alerts(score_wide(bronze, model), run_id, threshold)
