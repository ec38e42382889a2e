"""Online, offline and rolling features."""

from datetime import datetime

from pyspark.sql import functions as F

from meterlake.operators import features as O
from meterlake.operators.facts import feature_rows
from meterlake.plans.catalog import AS_OF, CALLS, calls, query, rounded, rounded_values, text
from meterlake.plans.session import work_folder
from meterlake.sources.interactions import interactions_from_events, stream_table
from meterlake.sources.online import online_rows, publish_online_features, read_online
from meterlake.streaming.jobs import WATERMARK, landed
from meterlake.streaming.sessions import open_sessions, publish_sessions
from meterlake.streaming.windows import with_event_time

NOON = datetime(2024, 1, 30, 12)


def _sessions(gap: int, where: str = "true") -> str:
    return f"""{CALLS}, g AS (
SELECT *, CASE WHEN epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w) >= {gap}000000
  OR lag("timestamp") OVER w IS NULL THEN 1 ELSE 0 END AS s FROM calls WHERE {where}
WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", interaction_id)),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY "timestamp", interaction_id)::BIGINT AS session_no FROM g),
sessions AS (
SELECT user_id, session_no, sum(cost_usd) AS total_cost, sum(total_tokens)::BIGINT AS total_tokens,
  count(*) AS interaction_count, avg(latency_ms) AS avg_latency,
  arg_max(model, ("timestamp", interaction_id)) AS last_model, min("timestamp") AS session_start,
  max("timestamp") AS last_interaction_time, max("timestamp") + INTERVAL {gap} SECOND AS expires_at
FROM n GROUP BY user_id, session_no)"""


_SESSION_OUT = """SELECT user_id, session_no, round(total_cost, 7) AS total_cost, total_tokens, interaction_count,
  round(avg_latency, 7) AS avg_latency, last_model, session_start::VARCHAR AS session_start,
  last_interaction_time::VARCHAR AS last_interaction_time, expires_at::VARCHAR AS expires_at FROM sessions"""


def _session_out(df):
    df = rounded(df, "total_cost", "avg_latency")
    return df.withColumns({c: text(c) for c in ("session_start", "last_interaction_time", "expires_at")})


@query("O1_online_features_ttl", f"""{_sessions(300)}
{_SESSION_OUT} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY session_no DESC) = 1""")
def o1(spark, folder):
    return _session_out(O.online_features_ttl(calls(spark, folder)))


@query("O1_activity_sessions_6h", f"{_sessions(21600)} {_SESSION_OUT}")
def o1_long(spark, folder):
    return _session_out(O.activity_sessions(calls(spark, folder), 21600))


@query("O1_online_features_as_of", f"""{_sessions(21600, '"timestamp" <= TIMESTAMP ' + "'2024-01-30 12:00:00'")}
{_SESSION_OUT} WHERE expires_at > TIMESTAMP '2024-01-30 12:00:00'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY session_no DESC) = 1""")
def o1_as_of(spark, folder):
    return _session_out(O.online_features_ttl(calls(spark, folder), "2024-01-30 12:00:00", 21600))


_LIFE = """user_id, round(sum(cost_usd), 7) AS total_cost, sum(total_tokens)::BIGINT AS total_tokens,
  count(*) AS interaction_count, round(avg(latency_ms), 7) AS avg_latency,
  arg_max(model, ("timestamp", interaction_id)) AS last_model, max("timestamp")::VARCHAR AS last_interaction_time"""


def _life_out(df):
    return rounded(df, "total_cost", "avg_latency").withColumn("last_interaction_time", text("last_interaction_time"))


@query("O2_online_features_lifetime", f"{CALLS} SELECT {_LIFE} FROM calls GROUP BY user_id")
def o2(spark, folder):
    return _life_out(O.online_features_lifetime(calls(spark, folder)))


@query("O3_duplicate_policy", f"""{CALLS}, again AS (
SELECT * FROM calls UNION ALL SELECT * FROM calls WHERE operation = 'click')
SELECT 'once' AS policy, user_id, count(*) AS interaction_count, sum(total_tokens)::BIGINT AS total_tokens
FROM calls GROUP BY user_id
UNION ALL SELECT 'every', user_id, count(*), sum(total_tokens)::BIGINT FROM again GROUP BY user_id""")
def o3(spark, folder):
    rows = calls(spark, folder)
    again = rows.unionByName(rows.where("operation = 'click'"))
    columns = ["user_id", "interaction_count", "total_tokens"]
    once = O.online_features_lifetime(again, count_duplicates=False).select(F.lit("once").alias("policy"), *columns)
    every = O.online_features_lifetime(again).select(F.lit("every").alias("policy"), *columns)
    return once.unionByName(every)


def _asked(rows):
    """One request per user and operation, for known and unknown users."""
    users = rows.select("user_id", "operation").distinct()
    known = users.select(F.col("user_id").alias("entity_id"), F.col("operation").alias("request"))
    unknown = users.select(F.concat(F.lit("new_"), F.col("user_id")), "operation")
    return known.union(unknown)


_ASKED = """asked AS (SELECT DISTINCT user_id AS entity_id, operation AS request FROM calls
UNION ALL SELECT DISTINCT 'new_' || user_id, operation FROM calls)"""


@query("O4_get_online_features", f"""{CALLS}, {_ASKED}, t AS (
SELECT user_id, count(*)::VARCHAR AS n, sum(total_tokens)::VARCHAR AS tokens,
  arg_max(model, ("timestamp", interaction_id)) AS model FROM calls GROUP BY user_id)
SELECT entity_id, request, n AS interaction_count, tokens AS total_tokens, model AS last_model
FROM asked LEFT JOIN t ON user_id = entity_id""")
def o4(spark, folder):
    rows = calls(spark, folder)
    names = ["interaction_count", "total_tokens", "last_model"]
    entries = online_rows(O.online_features_lifetime(rows), names, NOON)
    return O.get_online_features(_asked(rows), entries, names)


@query("O5_online_with_fallback", f"""{CALLS}, {_ASKED}, hot AS (
SELECT user_id AS entity_id, count(*)::VARCHAR AS hot FROM calls WHERE date >= DATE '2024-01-30' GROUP BY user_id),
warm AS (SELECT user_id AS entity_id, count(*)::VARCHAR AS warm FROM calls GROUP BY user_id)
SELECT entity_id, request, 'interaction_count' AS feature_name, coalesce(hot, warm) AS value,
  CASE WHEN hot IS NOT NULL THEN 'hot' WHEN warm IS NOT NULL THEN 'warm' ELSE 'none' END AS served_from
FROM asked LEFT JOIN hot USING (entity_id) LEFT JOIN warm USING (entity_id)""")
def o5(spark, folder):
    rows = calls(spark, folder)
    names = ["interaction_count"]
    recent = rows.where(F.col("date") >= F.lit("2024-01-30").cast("date"))
    hot = online_rows(O.online_features_lifetime(recent), names, NOON)
    warm = online_rows(O.online_features_lifetime(rows), names, NOON)
    return O.online_with_fallback(_asked(rows), names, hot, warm)


@query("O5_write_back", f"""{CALLS}, w AS (
SELECT user_id, count(*)::VARCHAR AS value FROM calls GROUP BY user_id HAVING max(date) < DATE '2024-01-30')
SELECT user_id AS entity_id, value FROM w""")
def o5_write_back(spark, folder):
    served = o5(spark, folder)
    root = work_folder(spark, "write-back")
    entries = O.write_back_rows(served).select(
        "entity_id", "feature_name", "value", F.lit(NOON).cast("timestamp_ntz").alias("written_at"),
        (F.lit(NOON).cast("timestamp_ntz") + F.expr("INTERVAL 300 SECONDS")).alias("expires_at"))
    publish_online_features(entries, root)
    return read_online(spark, root, NOON).select("entity_id", "value")


def _event_features(rows):
    """Latency of every call as a stored feature of its user, one feature per operation."""
    return feature_rows(rows.select(
        F.col("operation").alias("feature_name"), F.col("user_id").alias("entity_id"),
        F.col("input_tokens").alias("value"), "timestamp"))


@query("O6_feature_history", f"""{CALLS}
SELECT "timestamp"::VARCHAR AS "timestamp", input_tokens::VARCHAR AS value FROM calls
WHERE user_id = 'user_7' AND operation = 'click' AND date >= DATE '{AS_OF}' - INTERVAL 20 DAY""")
def o6(spark, folder):
    rows = O.feature_history(_event_features(calls(spark, folder)), "user_7", "click", AS_OF, 20)
    return rows.withColumn("timestamp", text("timestamp"))


@query("O6_feature_histories", f"""{CALLS}
SELECT user_id AS entity_id, operation AS feature_name, "timestamp"::VARCHAR AS "timestamp", input_tokens::VARCHAR AS value
FROM calls WHERE operation IN ('click', 'view') AND date >= DATE '{AS_OF}' - INTERVAL 20 DAY""")
def o6_bulk(spark, folder):
    features = _event_features(calls(spark, folder))
    keys = features.where("feature_name IN ('click', 'view')").select("entity_id", "feature_name").distinct()
    return O.feature_histories(features, keys, AS_OF, 20).withColumn("timestamp", text("timestamp"))


@query("O7_latest_feature_values", f"""{CALLS}
SELECT user_id AS entity_id, operation AS feature_name, input_tokens::VARCHAR AS value, 'numeric' AS feature_type,
  "timestamp"::VARCHAR AS "timestamp", 1 AS version FROM calls
QUALIFY row_number() OVER (PARTITION BY user_id, operation ORDER BY "timestamp" DESC) = 1""")
def o7(spark, folder):
    latest = O.latest_feature_values(_event_features(calls(spark, folder)))
    return latest.withColumn("timestamp", text("timestamp"))


@query("O8_materialize_features", f"""{CALLS}, t AS (
SELECT user_id, count(*)::DOUBLE AS n, sum(total_tokens)::DOUBLE AS tokens, round(sum(cost_usd), 7) AS cost,
  round(avg(latency_ms), 7) AS latency FROM calls GROUP BY user_id),
f AS (SELECT user_id AS entity_id, 'interaction_count' AS feature_name, n AS value FROM t
  UNION ALL SELECT user_id, 'total_tokens', tokens FROM t
  UNION ALL SELECT user_id, 'total_cost', cost FROM t
  UNION ALL SELECT user_id, 'avg_latency', latency FROM t)
SELECT 'features' AS target, entity_id, feature_name, value, '2024-01-30 12:00:00' AS at FROM f
UNION ALL SELECT 'online', entity_id, feature_name, value, '2024-01-30 12:05:00' FROM f""")
def o8(spark, folder):
    features, online = O.materialize_features(calls(spark, folder), NOON)
    columns = ["entity_id", "feature_name", "value"]
    both = features.select(F.lit("features").alias("target"), *columns, text("timestamp").alias("at")).union(
        online.select(F.lit("online"), *columns, text("expires_at")))
    # Sums of doubles as text differ in the last digit between runs.
    return both.withColumn("value", F.round(F.col("value").cast("double"), 7))


_ROLL = """SELECT DISTINCT user_id, "timestamp", count(*) OVER w AS interaction_count_7d,
  round(sum(length(prompt)) OVER w::DOUBLE / count(*) OVER w, 7) AS avg_prompt_length_7d,
  round(sum(total_tokens) OVER w::DOUBLE / count(*) OVER w, 7) AS avg_tokens_per_request_7d,
  round(sum(cost_usd) OVER w, 7) AS total_cost_7d FROM calls
WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp" RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)"""
_ROLL_NAMES = ["avg_prompt_length_7d", "avg_tokens_per_request_7d", "total_cost_7d"]


@query("O9_rolling_features", f"""{CALLS}, r AS ({_ROLL})
SELECT * REPLACE ("timestamp"::VARCHAR AS "timestamp") FROM r""")
def o9(spark, folder):
    rolled = rounded(O.rolling_features(calls(spark, folder)), *_ROLL_NAMES)
    return rolled.withColumn("timestamp", text("timestamp"))


_VIEW_USERS = [f"user_{i}" for i in range(0, 40, 2)]


@query("O10_offline_feature_view", f"""{CALLS}, r AS ({_ROLL}),
last AS (SELECT * FROM r WHERE "timestamp"::DATE <= DATE '2024-01-20' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC) = 1),
t AS (SELECT user_id, count(*) AS interaction_count, round(sum(cost_usd), 7) AS total_cost,
  sum(total_tokens)::BIGINT AS total_tokens, round(avg(latency_ms), 7) AS avg_latency FROM calls
  WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND user_id IN ({str(_VIEW_USERS)[1:-1]}) GROUP BY user_id)
SELECT user_id AS entity_id, interaction_count, total_cost, total_tokens, avg_latency, interaction_count_7d,
  avg_prompt_length_7d, avg_tokens_per_request_7d, total_cost_7d FROM t LEFT JOIN last USING (user_id)""")
def o10(spark, folder):
    O.offline_feature_view(calls(spark, folder), _VIEW_USERS, "2024-01-10", "2024-01-20", name="training_features")
    view = spark.sql("SELECT * FROM training_features").drop("first_interaction", "last_interaction")
    return rounded(view, "total_cost", "avg_latency", *_ROLL_NAMES)


@query("O10_offline_feature_view_of_all", f"""{CALLS}, r AS ({_ROLL}),
last AS (SELECT * FROM r WHERE "timestamp"::DATE <= DATE '2024-12-31' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC) = 1),
t AS (SELECT user_id, count(*) AS interaction_count, round(sum(cost_usd), 7) AS total_cost,
  sum(total_tokens)::BIGINT AS total_tokens, round(avg(latency_ms), 7) AS avg_latency FROM calls
  WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-12-31' GROUP BY user_id)
SELECT user_id AS entity_id, interaction_count, total_cost, total_tokens, avg_latency, interaction_count_7d,
  avg_prompt_length_7d, avg_tokens_per_request_7d, total_cost_7d FROM t LEFT JOIN last USING (user_id)""")
def o10_all(spark, folder):
    O.offline_feature_view(calls(spark, folder), None, "2024-01-10", "2024-12-31", name="training_features_of_all")
    view = spark.sql("SELECT * FROM training_features_of_all").drop("first_interaction", "last_interaction")
    return rounded(view, "total_cost", "avg_latency", *_ROLL_NAMES)


@query("O10_point_in_time_view", f"""{CALLS}, r AS ({_ROLL.replace("FROM calls", "FROM calls WHERE NOT is_error")})
SELECT interaction_id, c.user_id AS entity_id, is_error AS label, r."timestamp"::VARCHAR AS feature_time, interaction_count_7d,
  avg_prompt_length_7d, avg_tokens_per_request_7d, total_cost_7d
FROM calls c ASOF LEFT JOIN r ON c.user_id = r.user_id AND r."timestamp" <= c.timestamp""")
def o10_point_in_time(spark, folder):
    rows = calls(spark, folder)
    labels = rows.select(
        "interaction_id", F.col("user_id").alias("entity_id"), F.col("timestamp").alias("label_time"), F.col("is_error").alias("label"))
    figures = O.rolling_features(rows.where("NOT is_error")).withColumnRenamed("user_id", "entity_id")
    view = O.point_in_time(labels, figures).drop("label_time")
    return rounded(view, *_ROLL_NAMES).withColumn("feature_time", text("feature_time"))


_MOMENT = "2024-01-30 12:00:00"


@query("T11_open_online_features", f"""{_sessions(21600, f""""timestamp" <= TIMESTAMP '{_MOMENT}'""")},
newest AS (SELECT * FROM sessions WHERE expires_at > TIMESTAMP '{_MOMENT}'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY session_no DESC) = 1),
six AS (SELECT user_id AS entity_id, expires_at::VARCHAR AS expires_at, round(total_cost, 7)::VARCHAR AS total_cost,
  total_tokens::VARCHAR AS total_tokens, interaction_count::VARCHAR AS interaction_count, round(avg_latency, 7)::VARCHAR AS avg_latency,
  last_model, last_interaction_time::VARCHAR AS last_interaction_time FROM newest)
SELECT entity_id, expires_at, feature_name, CASE WHEN feature_name IN ('total_cost', 'avg_latency') THEN value::DECIMAL(20, 7)::VARCHAR ELSE value END AS value
FROM (UNPIVOT six ON COLUMNS(* EXCLUDE (entity_id, expires_at)) INTO NAME feature_name VALUE value)""")
def t11_open(spark, folder):
    path = work_folder(spark, "open-sessions")
    events = interactions_from_events(stream_table(spark, folder, "events")).where(f"timestamp <= '{_MOMENT}'")
    changes = open_sessions(with_event_time(events, WATERMARK), 21600)
    landed(publish_sessions(changes, f"{path}/online", f"{path}/checkpoint"))
    live = read_online(spark, f"{path}/online", _MOMENT)
    return rounded_values(live).select("entity_id", "feature_name", "value", text("expires_at"))
