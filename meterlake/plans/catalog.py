"""Registry of named queries over the test tables, each with its SQL twin.

A query is a function (spark, folder) -> DataFrame. The SQL text gives the same
rows on an engine that has the tables as views. Sums of money are rounded in
both, because the order of a floating-point sum is not fixed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.schemas import PRICES
from meterlake.sources.interactions import read_table, read_test_interactions

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-31"
DIGITS = 7


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Entry(fn, sql)
        return fn

    return add


def load_all() -> dict[str, Entry]:
    from meterlake.plans import (  # noqa: F401
        queries_analytics,
        queries_drift,
        queries_embeddings,
        queries_features,
        queries_metrics,
        queries_tables,
        queries_values,
    )

    return CATALOG


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def text(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


def rounded_values(entries: DataFrame) -> DataFrame:
    """Figures that are sums of fractions, to the digits that do not depend on their order."""
    number = F.round(F.col("value").cast("double"), DIGITS).cast(f"decimal(20, {DIGITS})")
    value = F.when(F.col("feature_name").isin("total_cost", "avg_latency"), number.cast("string")).otherwise(F.col("value"))
    return entries.withColumn("value", value)


# --- shared inputs ----------------------------------------------------------


def calls(spark: SparkSession, folder: str) -> DataFrame:
    """Interactions of the events table, with a cache flag for the metrics."""
    rows = read_test_interactions(spark, folder)
    return rows.withColumn("cache_hit", F.col("input_tokens") % 4 != 0).withColumn("operation", F.col("event_type"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


_price_rows = ", ".join(f"('{m}', {i}::DOUBLE, {o}::DOUBLE)" for m, i, o in PRICES)

# CTEs prices and calls: the same rows as calls() above.
CALLS = f"""WITH prices(model, pin, pout) AS (VALUES {_price_rows}),
base AS (
  SELECT concat('int_', event_id::VARCHAR) AS interaction_id,
    concat('user_', user_id::VARCHAR) AS user_id,
    concat('sess_', user_id::VARCHAR, '_', ts::DATE::VARCHAR) AS session_id,
    CASE event_id % 5 WHEN 0 THEN 'gpt-4' WHEN 1 THEN 'gpt-3.5-turbo' WHEN 2 THEN 'claude-3-opus'
      WHEN 3 THEN 'claude-3-sonnet' ELSE 'other-model' END AS model,
    CASE event_id % 5 WHEN 0 THEN 'openai' WHEN 1 THEN 'openai' WHEN 2 THEN 'anthropic'
      WHEN 3 THEN 'anthropic' ELSE 'local' END AS provider,
    concat('Test prompt ', event_id::VARCHAR) AS prompt,
    concat('Test response ', event_id::VARCHAR) AS response,
    json_extract_string(props, '$.k')::INT + 10 AS input_tokens,
    (event_id % 300)::INT + 20 AS output_tokens,
    value * 10 AS latency_ms, ts AS "timestamp", ts::DATE AS date, props AS metadata,
    event_id, event_type AS operation, event_type = 'error' AS is_error
  FROM events),
calls AS (
  SELECT b.*, b.input_tokens + b.output_tokens AS total_tokens,
    b.input_tokens / 1000::DOUBLE * coalesce(p.pin, 0) + b.output_tokens / 1000::DOUBLE * coalesce(p.pout, 0)
      AS cost_usd,
    b.input_tokens % 4 <> 0 AS cache_hit
  FROM base b LEFT JOIN prices p USING (model))"""
