"""Windowed metrics and alert rules."""

from pyspark.sql import functions as F

from meterlake.operators import alerts as R
from meterlake.operators import analytics as A
from meterlake.operators import drift as D
from meterlake.plans.catalog import AS_OF, CALLS, calls, query, rounded, text
from meterlake.plans.session import work_folder
from meterlake.sources.interactions import interactions_from_events, stream_table
from meterlake.streaming.jobs import WATERMARK, landed, start_metric
from meterlake.plans.queries_drift import DRIFT_BY_TYPE
from meterlake.streaming import windows as T


def _windows(df):
    return df.withColumns({c: text(c) for c in ("window_start", "window_end")})


def _sliding(minutes: int, slide: int, figures: str, by: str = "", source: str = "calls") -> str:
    """Rows of every window of the given width that starts at a multiple of the slide."""
    keys = f", {by}" if by else ""
    return f"""{CALLS}, spread AS (
SELECT s.start AS window_start, s.start + INTERVAL {minutes} MINUTE AS window_end, c.* FROM (
  SELECT *, unnest(generate_series(
    time_bucket(INTERVAL {slide} MINUTE, "timestamp") - INTERVAL {minutes - slide} MINUTE,
    time_bucket(INTERVAL {slide} MINUTE, "timestamp"), INTERVAL {slide} MINUTE)) AS start
  FROM {source}) c, LATERAL (SELECT c.start AS start) s),
windowed AS (SELECT window_start, window_end{keys}, {figures} FROM spread GROUP BY window_start, window_end{keys})
SELECT * REPLACE (window_start::VARCHAR AS window_start, window_end::VARCHAR AS window_end) FROM windowed"""


@query("T1_interactions_per_second", _sliding(5, 1, "count(*) AS calls, count(*) / 300 AS per_second"))
def t1(spark, folder):
    return _windows(T.interactions_per_second(calls(spark, folder)))


@query("T2_interactions_per_second_by_model",
       _sliding(5, 1, "count(*) AS calls, count(*) / 300 AS per_second", "model"))
def t2(spark, folder):
    return _windows(T.interactions_per_second_by_model(calls(spark, folder)))


_RATIO = "avg(cache_hit::INT)"


@query("T3_cache_hit_ratio_5m", _sliding(5, 1, f"""sum(cache_hit::INT)::BIGINT AS hits, count(*) AS lookups,
round({_RATIO}, 9) AS hit_ratio,
CASE WHEN {_RATIO} < 0.8 THEN 'red' WHEN {_RATIO} < 0.95 THEN 'yellow' ELSE 'green' END AS band"""))
def t3(spark, folder):
    return rounded(_windows(T.cache_hit_ratio(calls(spark, folder))), "hit_ratio", digits=9)


@query("T4_latency_p95_p99_5m", _sliding(5, 1, """quantile_disc(latency_ms, 0.95) AS p95,
quantile_disc(latency_ms, 0.99) AS p99, count(*) AS calls""", "operation"))
def t4(spark, folder):
    return _windows(T.latency_p95_p99(calls(spark, folder)))


@query("T4_latency_sketch_stream", f"""WITH every AS ({_sliding(5, 1, """quantile_disc(latency_ms, 0.95) AS p95,
quantile_disc(latency_ms, 0.99) AS p99, count(*) AS calls""", "operation")})
SELECT * FROM every WHERE window_end::TIMESTAMP <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)""")
def t4_stream(spark, folder):
    path = work_folder(spark, "latency")
    events = interactions_from_events(stream_table(spark, folder, "events")).withColumn("operation", F.col("event_type"))
    landed(start_metric(T.latency_p95_p99_panes(T.with_event_time(events, WATERMARK)), f"{path}/out", f"{path}/checkpoint"))
    return _windows(spark.read.parquet(f"{path}/out"))


@query("T5_cost_24h", _sliding(1440, 60, "round(sum(cost_usd), 7) AS total_cost"))
def t5(spark, folder):
    return rounded(_windows(T.cost_24h(calls(spark, folder))), "total_cost")


@query("T6_cost_1h_by_model", _sliding(60, 60, "round(sum(cost_usd), 7) AS total_cost", "model"))
def t6(spark, folder):
    return rounded(_windows(T.cost_1h_by_model(calls(spark, folder))), "total_cost")


@query("T7_tokens_per_second_by_model",
       _sliding(5, 1, "sum(total_tokens)::BIGINT AS tokens, sum(total_tokens)::DOUBLE / 300 AS per_second", "model"))
def t7(spark, folder):
    return _windows(T.tokens_per_second_by_model(calls(spark, folder)))


@query("T8_drift_score_total", f"""{DRIFT_BY_TYPE}
SELECT round(sum(psi), 7) AS drift_score_total,
  CASE WHEN sum(psi) < 0.1 THEN 'green' WHEN sum(psi) < 0.2 THEN 'yellow' ELSE 'red' END AS band FROM scores""")
def t8(spark, folder):
    results = D.drift_sweep(calls(spark, folder), ["latency_ms", "total_tokens"], AS_OF, entity="operation")
    return rounded(T.drift_score_total(results), "drift_score_total")


@query("T9_cache_savings_1h", _sliding(60, 60, """sum(cache_hit::INT)::BIGINT AS hits,
round(sum(cost_usd), 7) AS total_cost, round(sum(cache_hit::INT) * 0.0001::DOUBLE, 7) AS cost_saved_usd"""))
def t9(spark, folder):
    return rounded(_windows(T.cache_savings_1h(calls(spark, folder))), "total_cost", "cost_saved_usd")


@query("T14_session_rollup", f"""{CALLS}
SELECT session_id, count(*) AS interaction_count, round(sum(cost_usd), 7) AS total_cost,
  sum(total_tokens)::BIGINT AS total_tokens, min("timestamp")::VARCHAR AS first_interaction,
  max("timestamp")::VARCHAR AS last_interaction FROM calls GROUP BY session_id""")
def t14(spark, folder):
    rows = rounded(A.session_rollup(calls(spark, folder)), "total_cost")
    return rows.withColumns({c: text(c) for c in ("first_interaction", "last_interaction")})


def _alert_sql(body: str, rule: str, subject: str, at: str, value: str, threshold: str, where: str) -> str:
    return f"""SELECT '{rule}' AS rule, {subject} AS subject, {at} AS at, round({value}, 7) AS value,
  {threshold}::DOUBLE AS threshold FROM ({body}) WHERE {where}"""


def _alert(df):
    return rounded(df, "value")


@query("R1_alert_error_rate", _alert_sql(
    _sliding(5, 1, "avg(is_error::INT) AS rate"), "error_rate", "'all'", "window_start", "rate", "0.01", "rate > 0.01"))
def r1(spark, folder):
    return _alert(R.error_rate(calls(spark, folder)))


@query("R2_alert_latency_p99", _alert_sql(
    _sliding(5, 1, "quantile_disc(latency_ms, 0.99) AS p99", "operation"),
    "latency_p99", "operation", "window_start", "p99", "500", "p99 > 500"))
def r2(spark, folder):
    return _alert(R.latency_p99(calls(spark, folder)))


_DAYS = f"{CALLS}, days AS (SELECT date, sum(cost_usd) AS cost FROM calls GROUP BY date)"


@query("R3_alert_cost_spike", f"""{_DAYS}
SELECT 'cost_spike' AS rule, 'all' AS subject, d.date::VARCHAR AS at, round(d.cost / b.cost - 1, 7) AS value,
  0.02::DOUBLE AS threshold FROM days d JOIN days b ON d.date = b.date + 1 WHERE d.cost / b.cost - 1 > 0.02""")
def r3(spark, folder):
    return _alert(R.cost_spike(calls(spark, folder), rise=0.02))


@query("R4_alert_hit_rate", _alert_sql(
    _sliding(5, 1, f"{_RATIO} AS ratio"), "hit_rate", "'all'", "window_start", "ratio", "0.8", "ratio < 0.8"))
def r4(spark, folder):
    return _alert(R.hit_rate(calls(spark, folder)))


@query("R5_alert_drift", f"""{DRIFT_BY_TYPE}
SELECT 'drift' AS rule, feature_name || ':' || entity_id AS subject, '2024-01-31 00:00:00' AS at,
  round(psi, 7) AS value, 0.01::DOUBLE AS threshold FROM scores WHERE psi > 0.01""")
def r5(spark, folder):
    results = D.drift_sweep(calls(spark, folder), ["latency_ms", "total_tokens"], AS_OF, entity="operation")
    return _alert(R.drift(results, limit=0.01))


@query("R6_alert_budget", f"""{_DAYS}, run AS (
SELECT strftime(date, '%Y-%m') AS month, date,
  sum(cost) OVER (PARTITION BY strftime(date, '%Y-%m') ORDER BY date) AS spent FROM days),
hit AS (SELECT month, l.lim, date, spent, row_number() OVER (PARTITION BY month, l.lim ORDER BY date) AS r
  FROM run, (VALUES (40.0::DOUBLE), (50.0::DOUBLE)) l(lim) WHERE spent >= l.lim)
SELECT 'budget' AS rule, month AS subject, date::VARCHAR AS at, round(spent, 7) AS value, lim AS threshold
FROM hit WHERE r = 1""")
def r6(spark, folder):
    return _alert(R.budget(calls(spark, folder)))


@query("R7_alert_daily_cost", f"""{_DAYS}
SELECT 'daily_cost' AS rule, 'all' AS subject, date::VARCHAR AS at, round(cost, 7) AS value, 1.9::DOUBLE AS threshold
FROM days WHERE cost > 1.9""")
def r7(spark, folder):
    return _alert(R.daily_cost(calls(spark, folder), limit_usd=1.9))
