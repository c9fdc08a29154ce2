"""Mixing to target weights by iterative proportional fitting; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.columns import hide, show
from fraudlens.session import stage

DIMENSIONS = ("source", "lang", "topic")
# A document's topic where a table has none: what kind of text it is, by marks in it.
TOPIC = (
    "CASE WHEN text LIKE '%Licen%' OR text LIKE '%Copyright%' THEN 'legal' "
    "WHEN text LIKE '%://%' OR text LIKE '%@%' THEN 'web' "
    "WHEN length(text) - length(translate(text, '0123456789', '')) > 0.01 * length(text) THEN 'numbers' "
    "WHEN length(text) - length(translate(text, chr(10), '')) > 0.01 * length(text) THEN 'lines' "
    "WHEN text IS NULL OR text = '' THEN 'empty' ELSE 'prose' END"
)
TOKENS = "regexp_count(coalesce(text, ''), '[^ \\\\t\\\\n\\\\r]+')"
_UNIT = float(1 << 48)


KEYS = tuple(f"v_{d}" for d in DIMENSIONS)


def _described(topic: str, tokens: str, seed: str) -> list[Column]:
    """Expressions of the three categories (a null one is one of its own), the tokens and the draw of a document."""
    values = [F.col("source"), F.col("lang"), F.expr(topic)]
    categories = [F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("")).alias(k) for v, k in zip(values, KEYS)]
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))
    number = F.conv(F.substring(F.md5(F.concat(key, F.lit(":" + seed))), 1, 12), 16, 10).cast("double") / _UNIT
    return [*categories, F.expr(tokens).cast("long").alias("tokens"), number.alias("number")]


def default_targets(cells: DataFrame, power: float) -> dict[str, DataFrame]:
    """Target shares (value, share) of each dimension: shares of tokens to ``power``, scaled to sum to 1."""
    out = {}
    for d, k in zip(DIMENSIONS, KEYS):
        totals = cells.groupBy(F.col(k).alias("value")).agg(F.sum("tokens").alias("t")).filter("t > 0")
        flat = totals.select("value", F.pow(F.col("t").cast("double"), F.lit(power)).alias("f"))
        out[d] = flat.select("value", (F.col("f") / flat.agg(F.sum("f")).scalar()).alias("share"))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], fraction: float, cycles: int) -> DataFrame:
    """``cells(v_source, v_lang, v_topic, tokens)`` with ``weight``, the tokens to take from each cell, and its goals.

    All weights begin at ``fraction`` of the tokens. A cycle scales them to the target tokens of each source,
    then language, then topic, and cuts what exceeds a cell's tokens. Values without a target get none.
    Only one row per cell takes part; sums are pre-aggregated. Every step is written and read again, so it is one
    aggregate and one join over a table, however many came before.
    """
    goals = [f"goal_{d}" for d in DIMENSIONS]
    budget = cells.agg(F.sum("tokens") * fraction).scalar()
    state = cells
    for d, key, goal in zip(DIMENSIONS, KEYS, goals):
        wanted = targets[d].select(F.col("value").alias(key), (F.col("share") * budget).alias(goal))
        state = state.join(wanted, key, "left").withColumn(goal, F.coalesce(goal, F.lit(0.0)))
    columns = [*KEYS, "tokens", *goals]
    state = stage(state.select(*columns, (F.col("tokens") * fraction).alias("weight")), "cells-and-goals")
    for _ in range(cycles):
        for key, goal in zip(KEYS, goals):
            totals = state.groupBy(key).agg(F.sum("weight").alias("total"))
            weight = F.expr(f"IF(total > 0, weight * ({goal} / total), 0)")
            if key == KEYS[-1]:
                weight = F.least(weight, F.col("tokens").cast("double"))
            state = stage(state.join(totals, key).select(*columns, weight.alias("weight")), "raked")
    return state


def residuals(state: DataFrame) -> DataFrame:
    """How far raked cells are from their goals: a row (dimension, value, goal, reached) for each value with tokens.

    Goals that sum to more than the tokens there are, or that contradict each other, cannot all be reached.
    """
    rows = []
    for d, key in zip(DIMENSIONS, KEYS):
        reached = state.groupBy(key).agg(F.max(f"goal_{d}").alias("goal"), F.sum("weight").alias("reached"))
        rows.append(reached.select(F.lit(d).alias("dimension"), F.expr(f"substring({key}, 2)").alias("value"), "goal", "reached"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def describe(docs: DataFrame, columns: list[str], topic: str = TOPIC, tokens: str = TOKENS, seed: str = "mix-1") -> DataFrame:
    """Staged: ``columns`` of ``docs`` as c0, c1, ..., the three categories, the tokens and the draw of every document."""
    passed = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    return stage(docs.select(*passed, *_described(topic, tokens, seed)), "described")


def count_cells(described: DataFrame) -> DataFrame:
    """Staged: tokens per (source, language, topic)."""
    return stage(described.groupBy(*KEYS).agg(F.sum("tokens").alias("tokens")), "cells")


def mix(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    fraction: float = 0.6,
    power: float = 0.7,
    cycles: int = 10,
    topic: str = TOPIC,
    tokens: str = TOKENS,
    seed: str = "mix-1",
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all) with topic, n_tokens, probability and kept: a sample whose tokens follow targets.

    Tokens are counted per (source, language, topic) and raked to the targets (by default: the present shares to
    ``power``, which flattens them) of ``fraction`` of all tokens. A document's probability is its cell's raked
    tokens by its tokens; it is kept if a number made from its id is below that, so a run can be repeated.
    ``topic`` and ``tokens`` are SQL expressions over ``docs``, for example the names of its columns; the defaults
    tell topics by marks in the text and count words. Texts are looked at once: what is found is staged.

    Defined cases: nulls in source, lang or topic are a value of their own; a null or empty text has no tokens and,
    like other documents without any, probability 0; rows that repeat a doc_id share their fate; a null doc_id
    draws by its text; an empty table stays empty; other columns pass under any name, those named as results are
    replaced.
    """
    made = ("topic", "n_tokens", "probability", "kept")
    columns = [c for c in (docs.columns if columns is None else columns) if c not in made]
    described = describe(docs, columns, topic, tokens, seed)
    cells = count_cells(described)
    state = rake(cells, targets or default_targets(cells, power), fraction, cycles)
    chance = state.select(*KEYS, F.expr("IF(tokens > 0, weight / tokens, 0.0)").alias("probability"))
    return described.join(chance, list(KEYS)).select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)),
        F.expr("substring(v_topic, 2)").alias("topic"),
        F.col("tokens").alias("n_tokens"),
        "probability",
        ((F.col("tokens") > 0) & (F.col("number") < F.col("probability"))).alias("kept"),
    )


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``mix`` keeps, with all their columns as they are."""
    hidden, names = hide(docs, "doc_id", "text", "source", "lang")
    return show(mix(hidden, **options).filter("kept"), names)


def mix_sql(fraction: float = 0.6, power: float = 0.7, cycles: int = 10, seed: str = "mix-1") -> str:
    """The same as DuckDB SQL: every step of the raking is a table of its own."""
    parts = [
        "described AS (SELECT doc_id, text, coalesce('=' || source, '') AS _source, coalesce('=' || lang, '') AS _lang, "
        f"'=' || ({TOPIC}) AS _topic, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS _tokens FROM documents)",
        "cells AS (SELECT _source, _lang, _topic, CAST(sum(_tokens) AS BIGINT) AS _tokens FROM described GROUP BY ALL)",
    ]
    for d in DIMENSIONS:
        parts.append(
            f"goal_{d} AS (SELECT value, f / sum(f) OVER () * (SELECT sum(_tokens) * {fraction} FROM cells) AS goal "
            f"FROM (SELECT _{d} AS value, pow(CAST(sum(_tokens) AS DOUBLE), {power}) AS f FROM cells GROUP BY _{d} HAVING sum(_tokens) > 0) t)"
        )
    parts.append(f"w0 AS MATERIALIZED (SELECT *, _tokens * CAST({fraction} AS DOUBLE) AS _weight FROM cells)")
    last = "w0"
    for cycle in range(1, cycles + 1):
        for d in DIMENSIONS:
            name = f"w{cycle}_{d}"
            parts.append(
                f"{name} AS MATERIALIZED (SELECT _source, _lang, _topic, _tokens, _weight * CASE WHEN total > 0 THEN coalesce(goal, 0) / total "
                f"ELSE 0 END AS _weight FROM (SELECT *, sum(_weight) OVER (PARTITION BY _{d}) AS total FROM {last}) s "
                f"LEFT JOIN goal_{d} ON value = _{d})"
            )
            last = name
        parts.append(
            f"w{cycle} AS MATERIALIZED (SELECT _source, _lang, _topic, _tokens, least(_weight, CAST(_tokens AS DOUBLE)) AS _weight FROM {last})"
        )
        last = f"w{cycle}"
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, substr(_topic, 2) AS topic, CAST(d._tokens AS BIGINT) AS n_tokens,
  round(CASE WHEN c._tokens > 0 THEN _weight / c._tokens ELSE 0 END, 6) AS probability,
  d._tokens > 0 AND CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), md5(text), '') || ':{seed}'), 1, 12) AS BIGINT)
    / {_UNIT} < CASE WHEN c._tokens > 0 THEN _weight / c._tokens ELSE 0 END AS kept
FROM described d JOIN {last} c USING (_source, _lang, _topic)"""
