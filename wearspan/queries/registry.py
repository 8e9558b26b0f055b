"""Registered queries: a Spark plan each and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL twin if there is one."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return add


def sql_percentile(key: str) -> str:
    """The scrambled row hash of a key expression, as a number below a hundred."""
    h = f"(({key}) % 1000003)"
    return f"(({h} * {h}) % 1000003 % 100)"


ROW_KEY = 'CAST(engine_id AS BIGINT) * 7919 + "cycle" * 104729'


# --- shared SQL ---------------------------------------------------------------

TELEMETRY = """
telemetry AS MATERIALIZED (
  SELECT CAST(l_suppkey AS INTEGER) AS engine_id,
         CAST(row_number() OVER (PARTITION BY l_suppkey
              ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS INTEGER) AS "cycle",
         CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS DOUBLE) AS setting_1,
         CAST(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS DOUBLE) AS setting_2,
         CAST(100 AS DOUBLE) AS setting_3, CAST(518.67 AS DOUBLE) AS s_1,
         l_quantity AS s_2, l_extendedprice AS s_3, l_discount AS s_4, l_tax AS s_7,
         CAST(l_shipdate AS DATE) AS observed_on
  FROM lineitem),
labelled AS MATERIALIZED (
  SELECT *, max("cycle") OVER (PARTITION BY engine_id) AS last_cycle,
         CAST(least(max("cycle") OVER (PARTITION BY engine_id) - "cycle", 125) AS INTEGER) AS rul,
         CAST(setting_1 * 2 + setting_2 AS INTEGER) AS regime
  FROM telemetry)
"""

EVENTS = """
telemetry_events AS (
  SELECT CAST(user_id AS INTEGER) AS engine_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS "cycle",
         CAST(extract('hour' FROM ts) AS DOUBLE) AS setting_1, value AS s_2,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS s_3
  FROM events),
labelled_events AS (
  SELECT *, CAST(least(max("cycle") OVER (PARTITION BY engine_id) - "cycle", 125) AS INTEGER) AS rul
  FROM telemetry_events)
"""

FINAL_RUL = """
final_rul AS MATERIALIZED (
  SELECT CAST(s_suppkey AS INTEGER) AS engine_id, CAST(20 + s_suppkey % 100 AS INTEGER) AS final_rul
  FROM supplier)
"""

# The train side runs to failure; the test side stops final_rul cycles earlier, so
# its label (observed end - cycle + final_rul) equals the run-to-failure label.
SPLIT = (
    TELEMETRY
    + ","
    + FINAL_RUL
    + """,
split_panel AS MATERIALIZED (
  SELECT l.*, 'train' AS split FROM labelled l WHERE engine_id % 5 <> 0
  UNION ALL
  SELECT l.*, 'test' AS split
  FROM labelled l JOIN final_rul f USING (engine_id)
  WHERE engine_id % 5 = 0 AND "cycle" <= last_cycle - f.final_rul)
"""
)

LIFE = """
life AS (
  SELECT avg(m) AS mean_life, max(m) AS top_life
  FROM (SELECT max("cycle") AS m FROM split_panel WHERE split = 'train' GROUP BY engine_id))
"""


def sql_metrics(y: str = "rul", p: str = "prediction") -> str:
    sse = f"sum(({y} - {p}) * ({y} - {p}))"
    sst = f"(var_pop({y}) * count(*))"
    return f"""
  round(sqrt(avg(({p} - {y}) * ({p} - {y}))), 6) AS rmse,
  round(avg(abs({p} - {y})), 6) AS mae,
  round(CASE WHEN count(*) < 2 THEN NULL
             WHEN min({y}) = max({y}) THEN CASE WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END
             ELSE 1 - {sse} / {sst} END, 6) AS r2,
  round(sum(CASE WHEN {p} < {y} THEN exp(-({p} - {y}) / 13.0) - 1 ELSE exp(({p} - {y}) / 10.0) - 1 END), 2) AS nasa_score"""
