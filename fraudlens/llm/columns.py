"""Columns that only pass through an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hide(docs: DataFrame, *used: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but ``used`` renamed, so that an operator's own names clash with none.

    Returns it and each column's name in it, in order.
    """
    names = {c: c if c in used else f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def show(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns as they were."""
    return docs.select(*(F.col(n).alias(c) for c, n in names.items()))
