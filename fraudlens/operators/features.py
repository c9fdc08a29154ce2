"""Per-card history features (W1-W4, P7) and model inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.functions.columns import epoch_seconds, one_hot
from fraudlens.operators.ordering import hot_keys, running_totals
from fraudlens.schemas import GOLD_COLUMNS, MERCHANTS

HOUR = 3600
DAY = 86_400
_CARD = "_card"
HOT_CARD_ROWS = 1_000_000


def card_features(tx: DataFrame, hot_card_rows: int = HOT_CARD_ROWS) -> DataFrame:
    """Silver rows to gold rows: history of the card strictly before each transaction.

    * ``n_prev``: earlier rows of the card, by second and then transaction id
    * ``amount_ratio``: amount over the mean of those rows, 1.0 for the first
    * ``tx_1h``: rows whose second lies in [ts - 3600, ts - 1]
    * ``sec_since_prev``: seconds since the row before, -1 for the first

    Cards below ``hot_card_rows`` share one shuffle and one sort; larger cards are split along time.
    Rows without an event time are left out.
    """
    rows = tx.filter(F.col("event_time").isNotNull()).withColumn(
        "ts", epoch_seconds(F.col("event_time"))
    )
    # never null, so that rows without a card are routed and joined like those of any card
    key = F.coalesce(F.concat(F.lit("="), F.col("card_id")), F.lit(""))
    hot = hot_keys(rows.select(key.alias(_CARD)), _CARD, hot_card_rows)
    if hot is None:
        history = _history_by_card(rows)
    else:
        rows = rows.withColumn(_CARD, key)
        cold_rows = rows.join(hot, _CARD, "left_anti")
        hot_rows = rows.join(hot, _CARD, "left_semi")
        history = _history_by_card(cold_rows).unionByName(_history_split(hot_rows))
    return _finish(history)


def _history_by_card(rows: DataFrame) -> DataFrame:
    card = Window.partitionBy("card_id")
    ordered = card.orderBy("ts", "transaction_id")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    last_hour = card.orderBy("ts").rangeBetween(-HOUR, -1)
    return rows.withColumns(
        {
            "n_prev": F.count(F.lit(1)).over(before),
            "sum_prev": F.sum("amount").over(before),
            "prev_ts": F.lag("ts").over(ordered),
            "tx_1h": F.count(F.lit(1)).over(last_hour),
        }
    )


def _history_split(rows: DataFrame) -> DataFrame:
    """The same four columns for cards too large for one task."""
    totals = running_totals(
        rows,
        order=["ts", "transaction_id"],
        by=[_CARD],
        totals={
            "n_prev": ("sum", F.lit(1)),
            "sum_prev": ("sum", F.col("amount")),
            "prev_ts": ("max", F.col("ts")),
        },
        inclusive=False,
    )
    return totals.join(_hour_counts_by_day(rows), [_CARD, "ts"])


def _hour_counts_by_day(rows: DataFrame) -> DataFrame:
    """``tx_1h`` per (card, second) of the split cards.

    Rows are counted per second first, then windowed per (card, day); the last hour of a day is
    copied into the next day as context.  A window holds at most 25 hours of seconds.
    """
    seconds = (
        rows.groupBy(_CARD, "ts")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"day": F.floor(F.col("ts") / DAY), "context": F.lit(False)})
    )
    late = F.pmod(F.col("ts"), F.lit(DAY)) >= DAY - HOUR
    context = seconds.filter(late).withColumns(
        {"day": F.col("day") + 1, "context": F.lit(True)}
    )
    last_hour = Window.partitionBy(_CARD, "day").orderBy("ts").rangeBetween(-HOUR, -1)
    return (
        seconds.unionByName(context)
        .withColumn("tx_1h", F.coalesce(F.sum("n").over(last_hour), F.lit(0)))
        .filter(~F.col("context"))
        .select(_CARD, "ts", "tx_1h")
    )


def amount_ratio(amount: Column, total: Column, n: Column) -> Column:
    """Amount over the mean of earlier amounts; 1.0 where there is none."""
    mean = F.try_divide(total, n)
    return F.when(mean.isNull(), F.lit(1.0)).otherwise(F.try_divide(amount, mean))


def is_foreign(country: Column, home: Column) -> Column:
    """1 abroad, 0 at home, NULL where either country is missing."""
    return (country != home).cast("int")


def _finish(history: DataFrame) -> DataFrame:
    return history.withColumns(
        {
            "amount_ratio": amount_ratio(F.col("amount"), F.col("sum_prev"), F.col("n_prev")),
            "sec_since_prev": F.coalesce(F.col("ts") - F.col("prev_ts"), F.lit(-1)),
            "is_foreign": is_foreign(F.col("country"), F.col("home_country")),
        }
    ).select(*GOLD_COLUMNS)


def with_merchant_columns(
    df: DataFrame, vocabulary: list[str] = MERCHANTS, column: str = "merchant_category"
) -> DataFrame:
    """One 0/1 column per merchant category, the same list for training and scoring."""
    return df.withColumns(one_hot(F.col(column), vocabulary, column))
