"""Panels made of the events table: one by type (dense), one by user (with gaps)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Ticks of a day in these panels.
DAILY_TICKS = 96
_TYPES = "CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END"
_SPARK_DAY = "datediff(CAST(ts AS DATE), DATE '2024-01-01')"
_DUCK_DAY = "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))"


def panel_sql(symbol: str, day: str) -> str:
    return f"""
SELECT CAST({symbol} AS INT) AS symbol_id, CAST({day} AS INT) AS date_id,
  CAST(row_number() OVER (PARTITION BY {symbol}, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS INT) AS time_id,
  CAST(1 + event_id % 3 AS DOUBLE) AS weight,
  CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 101 = 0 THEN value * 20 ELSE value END AS feature_00,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE sqrt(value + event_id % 13) END AS feature_01,
  sqrt(CAST((event_id * 7 + 3) % 101 AS DOUBLE)) - 5 AS responder_0,
  sqrt(CAST((event_id * 11 + 5) % 97 AS DOUBLE)) - 5 AS responder_1,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE sqrt(CAST((event_id * 13 + 1) % 89 AS DOUBLE)) - 5 END AS responder_2
FROM events"""


SYMBOLS = {"dense": _TYPES, "gappy": "user_id"}


def duck_panel(kind: str = "dense") -> str:
    return panel_sql(SYMBOLS[kind], _DUCK_DAY)


def event_panel(spark: SparkSession, sf_dir: str, kind: str = "dense") -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(panel_sql(SYMBOLS[kind], _SPARK_DAY).replace("FROM events", "FROM {events}"), events=events)
