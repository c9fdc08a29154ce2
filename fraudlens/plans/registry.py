"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``views`` are the derived views its SQL reads."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = _with_views(views, sql)
        return function

    return register


def _with_views(names: tuple[str, ...], sql: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    return f"WITH {views}\n{sql.strip()}"


# The views of FIXTURES.md in DuckDB SQL.
_COUNTRY = (
    "CASE CAST({} AS INT) WHEN 0 THEN 'MA' WHEN 1 THEN 'FR' WHEN 2 THEN 'ES' WHEN 3 THEN 'DE' "
    "WHEN 4 THEN 'US' WHEN 5 THEN 'GB' WHEN 6 THEN 'IT' ELSE 'AE' END"
)
_AWAY = _COUNTRY.format("CASE WHEN k < 80 THEN user_id % 8 ELSE k % 8 END")
_HOME = _COUNTRY.format("user_id % 8")
_EVENTS = "(SELECT e.*, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events e)"
_VALUES = ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS V{i}" for i in range(1, 29))

VIEWS: dict[str, str] = {
    "tx": f"""
SELECT CAST(event_id AS VARCHAR) AS transaction_id, concat('card_', CAST(user_id AS VARCHAR)) AS card_id,
  value AS amount, event_type AS merchant_category, {_AWAY} AS country, {_HOME} AS home_country,
  ts AS event_time, CASE WHEN k >= 90 AND value > 40 THEN 1 ELSE 0 END AS is_fraud,
  round(k / 99.0e0, 4) AS score, CAST(100 + (event_id * 7) % 900 AS DOUBLE) AS latency_ms,
  CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 1 ELSE 2 END AS run_id, event_id, user_id
FROM {_EVENTS} z WHERE value > 0""",
    "alerts": "SELECT * FROM tx WHERE score >= 0.8",
    "tx_raw": f"""
SELECT CAST(event_id AS VARCHAR) AS transaction_id,
  CASE WHEN event_id % 613 = 0 THEN NULL ELSE concat('card_', CAST(user_id AS VARCHAR)) END AS card_id,
  CASE WHEN event_id % 500 = 0 THEN 0.0e0 ELSE value END AS amount,
  event_type AS merchant_category,
  CASE WHEN event_id % 307 = 0 THEN NULL ELSE {_AWAY} END AS country, {_HOME} AS home_country,
  ts AS event_time,
  CASE WHEN event_id % 401 = 0 THEN NULL WHEN k >= 90 THEN 1 ELSE 0 END AS is_fraud,
  CAST(user_id % 3 AS INT) AS part,
  CAST(row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS BIGINT) AS offs
FROM {_EVENTS} z""",
    "silver": """
SELECT transaction_id, card_id, amount, merchant_category, country, home_country, event_time, is_fraud
FROM tx_raw
WHERE transaction_id IS NOT NULL AND card_id IS NOT NULL AND is_fraud IS NOT NULL AND amount > 0""",
    "gold": """
SELECT transaction_id, card_id, event_time, amount, merchant_category,
  count(*) OVER prev AS n_prev,
  CASE WHEN avg(amount) OVER prev IS NULL THEN 1.0e0 ELSE amount / (avg(amount) OVER prev) END AS amount_ratio,
  count(*) OVER hour AS tx_1h,
  coalesce(ts - lag(ts) OVER (PARTITION BY card_id ORDER BY ts, transaction_id), -1) AS sec_since_prev,
  CASE WHEN country <> home_country THEN 1 WHEN country = home_country THEN 0 END AS is_foreign,
  is_fraud
FROM (SELECT *, CAST(floor(epoch(event_time)) AS BIGINT) AS ts FROM tx) t
WINDOW prev AS (PARTITION BY card_id ORDER BY ts, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  hour AS (PARTITION BY card_id ORDER BY ts RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING)""",
    "wide": f"""
SELECT vec_id AS row_id, {_VALUES}, round(abs(CAST(embedding[29] AS DOUBLE)) * 100, 2) AS Amount,
  CASE WHEN label = 0 THEN 1 ELSE 0 END AS is_fraud,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(vec_id) AS event_time
FROM embeddings""",
    "wide_index": """
SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS place, count(*) OVER () AS total FROM wide""",
    "wide_raw": """
SELECT *, 2 * row_id AS offs FROM wide
UNION ALL
SELECT * REPLACE (event_time + INTERVAL 1 DAY AS event_time), 2 * row_id + 1 AS offs
FROM wide WHERE row_id % 50 = 0""",
    "indexed": """
SELECT *, row_number() OVER (ORDER BY event_time, transaction_id) - 1 AS row_idx, count(*) OVER () AS total
FROM tx""",
    "splits": """
SELECT *, CASE WHEN row_idx < floor(total * 0.8e0) THEN 'train' ELSE 'test' END AS split,
  CASE WHEN row_idx < floor(total * 0.6e0) THEN 'train' WHEN row_idx < floor(total * 0.8e0) THEN 'validation'
    ELSE 'test' END AS split3
FROM indexed""",
    "stats": """
SELECT 'stats' AS type, run_id, CAST(floor(epoch(last_time)) AS DOUBLE) AS ts,
  CAST(sum(n) OVER w AS BIGINT) AS processed, CAST(sum(tp) OVER w AS BIGINT) AS tp,
  CAST(sum(fp) OVER w AS BIGINT) AS fp, CAST(sum(fn) OVER w AS BIGINT) AS fn,
  CAST(sum(tn) OVER w AS BIGINT) AS tn, lat_win
FROM (
  SELECT run_id, idx // 250 AS batch, max(event_time) AS last_time, count(*) AS n,
    round(avg(latency_ms), 1) AS lat_win,
    count(*) FILTER (score >= 0.5 AND is_fraud = 1) AS tp, count(*) FILTER (score >= 0.5 AND is_fraud = 0) AS fp,
    count(*) FILTER (score < 0.5 AND is_fraud = 1) AS fn, count(*) FILTER (score < 0.5 AND is_fraud = 0) AS tn
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY event_time, event_id) - 1 AS idx FROM tx) i
  GROUP BY run_id, batch) b
WINDOW w AS (PARTITION BY run_id ORDER BY batch)""",
    "cells": """
SELECT count(*) FILTER (score >= 0.5 AND is_fraud = 1) AS tp, count(*) FILTER (score >= 0.5 AND is_fraud = 0) AS fp,
  count(*) FILTER (score < 0.5 AND is_fraud = 1) AS fn, count(*) FILTER (score < 0.5 AND is_fraud = 0) AS tn
FROM tx""",
    "curve": """
SELECT threshold, sum(pos) OVER w AS tp, sum(n) OVER w AS flagged, sum(pos) OVER () AS positives, pos
FROM (SELECT score AS threshold, count(*) FILTER (is_fraud = 1) AS pos, count(*) AS n FROM tx GROUP BY score) s
WINDOW w AS (ORDER BY threshold DESC)""",
    "validation_costs": """
SELECT t AS threshold, round(5.0e0 * count(*) FILTER (score >= t)
  + coalesce(sum(amount) FILTER (score < t AND is_fraud = 1), 0), 2) AS cost
FROM (SELECT * FROM splits WHERE split3 = 'validation') v,
  (SELECT round(i * 0.02e0, 2) AS t FROM range(1, 50) r(i)) g
GROUP BY t""",
    "best": "SELECT threshold, cost FROM validation_costs ORDER BY cost, threshold LIMIT 1",
}

NEEDS: dict[str, tuple[str, ...]] = {
    "alerts": ("tx",),
    "silver": ("tx_raw",),
    "gold": ("tx",),
    "wide_index": ("wide",),
    "wide_raw": ("wide",),
    "indexed": ("tx",),
    "splits": ("indexed",),
    "stats": ("tx",),
    "cells": ("tx",),
    "curve": ("tx",),
    "validation_costs": ("splits",),
    "best": ("validation_costs",),
}
