"""Cost, token and latency reports."""

from pyspark.sql import functions as F

from meterlake.operators import analytics as A
from meterlake.operators import features as O
from meterlake.plans.catalog import AS_OF, CALLS, calls, query, rounded, text
from meterlake.plans.passthrough import register, sql_passthrough
from meterlake.sources.interactions import read_table

_TRAIL = f"date >= DATE '{AS_OF}' - INTERVAL 30 DAY"


@query("A1_cost_by_day", f"""{CALLS}
SELECT date::VARCHAR AS date, round(sum(cost_usd), 7) AS total_cost FROM calls WHERE {_TRAIL} GROUP BY date""")
def a1(spark, folder):
    return rounded(A.cost_by_day(calls(spark, folder), AS_OF, 30), "total_cost")


@query("A1_cost_by_day_of_user", f"""{CALLS}
SELECT date::VARCHAR AS date, round(sum(cost_usd), 7) AS total_cost FROM calls
WHERE date >= DATE '{AS_OF}' - INTERVAL 14 DAY AND user_id = 'user_7' GROUP BY date""")
def a1_user(spark, folder):
    return rounded(A.cost_by_day(calls(spark, folder), AS_OF, 14, "user_7"), "total_cost")


@query("A2_cost_by_model", f"""{CALLS}
SELECT model, round(sum(cost_usd), 7) AS total_cost FROM calls WHERE {_TRAIL} GROUP BY model""")
def a2(spark, folder):
    return rounded(A.cost_by_model(calls(spark, folder), AS_OF, 30), "total_cost")


@query("A3_token_stats", f"""{CALLS}
SELECT coalesce(sum(total_tokens), 0)::BIGINT AS total_tokens, round(coalesce(avg(total_tokens), 0), 7) AS avg_tokens_per_request,
  coalesce(sum(input_tokens), 0)::BIGINT AS total_input_tokens,
  coalesce(sum(output_tokens), 0)::BIGINT AS total_output_tokens, count(*) AS interaction_count
FROM calls WHERE {_TRAIL}""")
def a3(spark, folder):
    return rounded(A.token_stats(calls(spark, folder), AS_OF, 30), "avg_tokens_per_request")


_TOP = f"""SELECT user_id, sum(cost_usd) AS total_cost, count(*) AS interaction_count,
  sum(total_tokens)::BIGINT AS total_tokens, avg(latency_ms) AS avg_latency_ms
FROM calls WHERE {_TRAIL} GROUP BY user_id ORDER BY total_cost DESC, user_id LIMIT 10"""


@query("A4_top_users_by_cost", f"""{CALLS}, top AS ({_TOP})
SELECT user_id, round(total_cost, 7) AS total_cost, interaction_count, total_tokens,
  round(avg_latency_ms, 7) AS avg_latency_ms FROM top""")
def a4(spark, folder):
    return rounded(A.top_users_by_cost(calls(spark, folder), AS_OF, 30, 10), "total_cost", "avg_latency_ms")


@query("A5_offline_features", f"""{CALLS}
SELECT user_id AS entity_id, count(*) AS interaction_count, round(sum(cost_usd), 7) AS total_cost,
  sum(total_tokens)::BIGINT AS total_tokens, round(avg(latency_ms), 7) AS avg_latency,
  min("timestamp")::VARCHAR AS first_interaction, max("timestamp")::VARCHAR AS last_interaction
FROM calls WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28' GROUP BY user_id""")
def a5(spark, folder):
    rows = A.offline_features(calls(spark, folder), None, "2024-01-03", "2024-01-28")
    rows = rounded(rows, "total_cost", "avg_latency")
    return rows.withColumns({c: text(c) for c in ("first_interaction", "last_interaction")})


@query("A6_cost_summary", f"""{CALLS}, w AS (SELECT * FROM calls WHERE {_TRAIL}), top AS ({_TOP}),
parts AS (
SELECT 'total_cost' AS section, 'all' AS key, 'total_cost' AS metric, sum(cost_usd) AS value FROM w
UNION ALL SELECT 'cost_by_model', model, 'total_cost', sum(cost_usd) FROM w GROUP BY model
UNION ALL SELECT 'token_stats', 'all', 'total_tokens', sum(total_tokens) FROM w
UNION ALL SELECT 'token_stats', 'all', 'avg_tokens_per_request', avg(total_tokens) FROM w
UNION ALL SELECT 'token_stats', 'all', 'total_input_tokens', sum(input_tokens) FROM w
UNION ALL SELECT 'token_stats', 'all', 'total_output_tokens', sum(output_tokens) FROM w
UNION ALL SELECT 'token_stats', 'all', 'interaction_count', count(*) FROM w
UNION ALL SELECT 'top_users', user_id, 'total_cost', total_cost FROM top
UNION ALL SELECT 'top_users', user_id, 'interaction_count', interaction_count FROM top
UNION ALL SELECT 'top_users', user_id, 'total_tokens', total_tokens FROM top
UNION ALL SELECT 'top_users', user_id, 'avg_latency_ms', avg_latency_ms FROM top)
SELECT section, key, metric, round(value::DOUBLE, 7) AS value FROM parts""")
def a6(spark, folder):
    return rounded(A.cost_summary(calls(spark, folder), AS_OF, 30), "value")


@query("A7_cost_summary_record", f"""{CALLS}
SELECT min("timestamp")::VARCHAR AS period_start, max("timestamp")::VARCHAR AS period_end,
  round(sum(cost_usd), 7) AS total_cost_usd, sum(total_tokens)::BIGINT AS total_tokens, count(*) AS total_interactions,
  round(sum(cost_usd) / count(*), 7) AS avg_cost_per_interaction,
  round(sum(total_tokens)::DOUBLE / count(*), 7) AS avg_tokens_per_interaction,
  round(avg(cache_hit::INT), 7) AS cache_hit_rate, round(sum(cache_hit::INT) * 0.0001::DOUBLE, 7) AS cost_saved_by_cache
FROM calls""")
def a7(spark, folder):
    rows = calls(spark, folder)
    one = A.cost_summary_record(rows, cache_log=rows.select("cache_hit"))
    one = rounded(one, "total_cost_usd", "avg_cost_per_interaction", "avg_tokens_per_interaction",
                  "cache_hit_rate", "cost_saved_by_cache")
    return one.withColumns({c: text(c) for c in ("period_start", "period_end")})


@query("A7_cost_breakdown", f"""{CALLS}
SELECT 'model' AS dimension, model AS key, round(sum(cost_usd), 7) AS total_cost FROM calls GROUP BY model
UNION ALL SELECT 'user', user_id, round(sum(cost_usd), 7) FROM calls GROUP BY user_id""")
def a7_breakdown(spark, folder):
    return rounded(A.cost_breakdown(calls(spark, folder)), "total_cost")


@query("A8_count_by_model", f"{CALLS} SELECT model, count(*) AS count FROM calls GROUP BY model")
def a8(spark, folder):
    return A.count_by_model(calls(spark, folder))


@query("A9_distinct_dates", f"{CALLS} SELECT count(DISTINCT date) AS distinct_dates FROM calls")
def a9(spark, folder):
    return A.distinct_dates(calls(spark, folder))


@query("A10_avg_latency_by_model", f"""{CALLS}
SELECT model, round(avg(latency_ms), 7) AS avg_latency FROM calls
WHERE date >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY model""")
def a10(spark, folder):
    return rounded(A.avg_latency_by_model(calls(spark, folder), AS_OF, 7), "avg_latency")


_STATS = """count(*) AS total_interactions, sum(total_tokens)::BIGINT AS total_tokens,
  round(sum(cost_usd), 7) AS total_cost, round(avg(latency_ms), 7) AS avg_latency_ms"""


@query("A11_interaction_stats", f"""{CALLS}
SELECT provider, {_STATS} FROM calls GROUP BY provider UNION ALL SELECT 'all', {_STATS} FROM calls""")
def a11(spark, folder):
    return rounded(A.interaction_stats(calls(spark, folder)), "total_cost", "avg_latency_ms")


@query("A12_monthly_cost_report", f"""{CALLS}
SELECT strftime(date, '%Y-%m') AS month, model, round(sum(cost_usd), 7) AS total_cost FROM calls GROUP BY 1, 2
UNION ALL SELECT strftime(date, '%Y-%m'), 'all', round(sum(cost_usd), 7) FROM calls GROUP BY 1""")
def a12(spark, folder):
    return rounded(A.monthly_cost_report(calls(spark, folder)), "total_cost")


@query("A13_cost_metric_rollup", f"""{CALLS}, g AS (
SELECT date, operation, model, count(*) AS requests, sum(cost_usd) AS total_cost,
  sum(total_tokens)::BIGINT AS total_tokens, sum(cache_hit::INT)::BIGINT AS cache_hits FROM calls GROUP BY ALL),
d AS (SELECT date, sum(cost_usd) AS day_cost FROM calls GROUP BY date)
SELECT date::VARCHAR AS date, operation, model, requests, round(total_cost, 7) AS total_cost, total_tokens, cache_hits,
  round(day_cost, 7) AS day_cost, round(cache_hits / requests, 7) AS cache_hit_rate,
  round(cache_hits * 0.0001::DOUBLE, 7) AS cost_saved_usd, day_cost > 1.9 AS over_budget
FROM g JOIN d USING (date)""")
def a13(spark, folder):
    metrics = A.cost_metrics(calls(spark, folder), "event_type", F.col("cache_hit"))
    rows = A.cost_metric_rollup(metrics, daily_budget=1.9).withColumn("date", text("date"))
    return rounded(rows, "total_cost", "day_cost", "cache_hit_rate", "cost_saved_usd")


@query("A13_cost_metric_by_user", f"""{CALLS}
SELECT user_id, count(*) AS requests, round(sum(cost_usd), 7) AS total_cost FROM calls GROUP BY user_id""")
def a13_user(spark, folder):
    return rounded(A.cost_metric_by_user(A.cost_metrics(calls(spark, folder))), "total_cost")


@query("A14_cache_hit_rate", f"""{CALLS}
SELECT operation, count(*) FILTER (cache_hit) AS cache_hits, count(*) FILTER (NOT cache_hit) AS cache_misses,
  round(avg(cache_hit::INT), 7) AS cache_hit_rate,
  round(count(*) FILTER (cache_hit) * 0.0001::DOUBLE, 7) AS cost_saved_usd FROM calls GROUP BY operation""")
def a14(spark, folder):
    return rounded(A.cache_hit_rate(calls(spark, folder), ("operation",)), "cache_hit_rate", "cost_saved_usd")


def _ranked(q: float) -> str:
    return f"max(latency_ms) FILTER (r = least(floor(n * {q}::DOUBLE), n - 1)) AS p{round(q * 100)}"


@query("A15_latency_percentiles", f"""{CALLS}, o AS (
SELECT operation, latency_ms, row_number() OVER (PARTITION BY operation ORDER BY latency_ms) - 1 AS r,
  count(*) OVER (PARTITION BY operation) AS n FROM calls)
SELECT operation, {_ranked(0.5)}, {_ranked(0.95)}, {_ranked(0.99)}, round(avg(latency_ms), 7) AS avg,
  min(latency_ms) AS min, max(latency_ms) AS max, count(*) AS count FROM o GROUP BY operation""")
def a15(spark, folder):
    rows = calls(spark, folder).withColumnRenamed("latency_ms", "duration_ms")
    return rounded(A.latency_percentiles(rows), "avg")


_STALE = "date < DATE '2024-01-28' OR user_id NOT LIKE '%3%'"


@query("A16_tier_consistency", f"""{CALLS},
online AS (SELECT user_id, count(*) AS online_count, sum(total_tokens)::BIGINT AS online_tokens, sum(cost_usd) AS online_cost
  FROM calls WHERE {_STALE} GROUP BY user_id),
facts AS (SELECT user_id, count(*) AS fact_count, sum(total_tokens)::BIGINT AS fact_tokens, sum(cost_usd) AS fact_cost
  FROM calls WHERE user_id <> 'user_7' GROUP BY user_id)
SELECT user_id, fact_count, online_count, fact_tokens, online_tokens, round(fact_cost, 7) AS fact_cost, round(online_cost, 7) AS online_cost,
  coalesce(online_count = fact_count AND online_tokens = fact_tokens AND abs(online_cost - fact_cost) <= 0.01, false) AS consistent
FROM online FULL JOIN facts USING (user_id)""")
def a16(spark, folder):
    rows = calls(spark, folder)
    # Some users' online totals are behind, and one user's facts are missing.
    joined = A.tier_consistency(O.online_features_lifetime(rows.where(_STALE)), rows.where("user_id <> 'user_7'"))
    return rounded(joined, "fact_cost", "online_cost")


_PASS = """
WITH revenue AS (
  SELECT n.n_name AS nation, o.o_orderstatus AS status, sum(l.l_extendedprice * (1 - l.l_discount)) AS revenue
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE l.l_quantity >= {low} AND n.n_name <> {skip} GROUP BY n.n_name, o.o_orderstatus)
SELECT nation, status, round(revenue, 2) AS revenue, rank() OVER (PARTITION BY status ORDER BY revenue DESC) AS place
FROM revenue"""


@query("Q1_sql_passthrough", _PASS.format(low="10", skip="'NATION_0'"))
def q1(spark, folder):
    register({t: read_table(spark, folder, t) for t in ("lineitem", "orders", "customer", "nation")})
    return sql_passthrough(spark, _PASS.format(low="?", skip="?"), [10, "NATION_0"])
