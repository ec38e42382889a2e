"""Sources, sinks, validation, tiers and streaming jobs."""

from datetime import datetime

from pyspark.sql import functions as F

from meterlake.operators import features as O
from meterlake.operators import validation as V
from meterlake.operators.facts import insert_features, insert_interactions, rejected_interactions
from meterlake.operators.embeddings import cache_table
from meterlake.plans.catalog import AS_OF, CALLS, calls, documents, query, rounded, rounded_values, text
from meterlake.plans.session import work_folder
from meterlake.schemas import RAW_INTERACTION
from meterlake.sources import online as N
from meterlake.sources.archive import Archive
from meterlake.sources.daily import move_days, read_all_tiers, read_days, write_days
from meterlake.sources.interactions import (
    as_messages,
    decode_json,
    interactions_from_events,
    publish_interactions,
    read_interactions,
    read_table,
    stream_embedding_requests,
    stream_interactions,
    stream_table,
)
from meterlake.streaming import jobs as J
from meterlake.streaming.windows import sessionized_online_features, with_event_time

NOON = datetime(2024, 1, 30, 12)
RAW_NAMES = [f.name for f in RAW_INTERACTION]


def _event():
    return F.substring("interaction_id", 5, 20).cast("long")


def with_faults(rows):
    """Calls as they might arrive: some break a rule, chosen by the event number."""
    n = _event()
    return rows.withColumns({
        "input_tokens": F.when(n % 11 == 0, -5).otherwise(F.col("input_tokens")),
        "provider": F.when(n % 13 == 0, "elsewhere").otherwise(F.col("provider")),
        "prompt": F.when(n % 17 == 0, " \t ").otherwise(F.col("prompt")),
        "response": F.when(n % 19 == 0, "").otherwise(F.col("response")),
    })


def faulty_messages(rows):
    """JSON text of with_faults; every seventh message is cut off."""
    whole = as_messages(with_faults(rows), RAW_NAMES)
    n = F.get_json_object("value", "$.interaction_id").substr(5, 20).cast("long")
    return whole.select(F.when(n % 7 == 0, F.substring("value", 1, 25)).otherwise(F.col("value")).alias("value"))


_REASONS = """list_filter([
  CASE WHEN event_id % 13 = 0 THEN 'provider_unknown' END,
  CASE WHEN event_id % 17 = 0 THEN 'prompt_blank' END,
  CASE WHEN event_id % 11 = 0 THEN 'input_tokens_negative' END], lambda x: x IS NOT NULL)"""
_VALID = "event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0"


# --- sources and sinks ------------------------------------------------------


@query("S1_read_interactions_batch", f"""{CALLS}
SELECT interaction_id, user_id, session_id, provider, total_tokens, round(cost_usd, 9) AS cost_usd,
  "timestamp"::VARCHAR AS "timestamp", date::VARCHAR AS date FROM calls""")
def s1(spark, folder):
    path = work_folder(spark, "json")
    publish_interactions(calls(spark, folder), sink="files", path=path)
    rows = read_interactions(spark, path, "json").select(
        "interaction_id", "user_id", "session_id", "provider", "total_tokens", "cost_usd", text("timestamp"), text("date"))
    return rounded(rows, "cost_usd", digits=9)


@query("S2_stream_interactions", f"""{CALLS}
SELECT interaction_id, model, total_tokens, date::VARCHAR AS date FROM calls""")
def s2(spark, folder):
    path = work_folder(spark, "stream")
    publish_interactions(calls(spark, folder), sink="files", path=f"{path}/in")
    stream = J.decoded_stream(stream_interactions(spark, source="files", path=f"{path}/in"))
    J.landed(J.start_metric(stream, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").select("interaction_id", "model", "total_tokens", text("date"))


@query("S3_stream_embedding_requests", """WITH words AS (
SELECT doc_id, length(text) AS chars, length(replace(text, ' ', '')) AS letters FROM documents)
SELECT doc_id::VARCHAR AS request_id, 'all-MiniLM-L6-v2' AS model, false AS cache_hit, 3 AS dimension,
  [chars::FLOAT, letters::FLOAT, 16::FLOAT]::VARCHAR AS vector FROM words""")
def s3(spark, folder):
    path = work_folder(spark, "embed")
    messages = documents(spark, folder).select(
        F.to_json(F.struct(F.col("doc_id").cast("string").alias("request_id"), "text")).alias("value"))
    messages.write.text(f"{path}/in")

    def sizes(model):
        """Vectors that SQL can check: the text's length, that without blanks, and that of the model's name."""
        return lambda texts: [[len(t), len(t.replace(" ", "")), len(model)] for t in texts]

    J.landed(J.start_embedding_requests(
        stream_embedding_requests(spark, source="files", path=f"{path}/in"),
        cache_table(spark, f"{path}/cache"), f"{path}/responses", f"{path}/refused", f"{path}/checkpoint", sizes))
    return spark.read.parquet(f"{path}/responses").select(
        "request_id", "model", "cache_hit", "dimension", F.format_string("[%s]", F.array_join(F.col("embedding").cast("array<string>"), ", ")).alias("vector"))


@query("S4_split_valid_invalid", f"""{CALLS}, m AS (
SELECT CASE WHEN event_id % 7 = 0 THEN ['malformed_json'] ELSE {_REASONS} END AS reasons FROM calls)
SELECT 'valid' AS side, '' AS reason, count(*) AS messages FROM m WHERE len(reasons) = 0
UNION ALL SELECT 'dead', array_to_string(reasons, ','), count(*) FROM m WHERE len(reasons) > 0 GROUP BY reasons""")
def s4(spark, folder):
    marked = V.mark_messages(decode_json(faulty_messages(calls(spark, folder))))
    valid, dead = V.written_apart(marked, work_folder(spark, "split"))
    count = F.count(F.lit(1)).alias("messages")
    good = valid.groupBy(F.lit("valid").alias("side"), F.lit("").alias("reason")).agg(count)
    return good.unionByName(dead.groupBy(
        F.lit("dead").alias("side"), F.array_join(V.REASONS, ",").alias("reason")).agg(count))


def _repeated(rows):
    """Every third call arrives again, one day later."""
    again = rows.where(_event() % 3 == 0).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
    return again.unionByName(rows)


@query("S5_insert_interactions", f"""{CALLS}
SELECT interaction_id, "timestamp"::VARCHAR AS "timestamp", total_tokens FROM calls WHERE operation <> 'view'""")
def s5(spark, folder):
    rows = calls(spark, folder)
    new = insert_interactions(_repeated(rows), rows.where("operation = 'view'"))
    return new.select("interaction_id", text("timestamp"), "total_tokens")


@query("S5_rejected_interactions", f"""{CALLS}
SELECT interaction_id, (CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN operation = 'view' THEN 1 ELSE 0 END)::BIGINT
  AS rejected FROM calls WHERE event_id % 3 = 0 OR operation = 'view'""")
def s5_rejected(spark, folder):
    rows = calls(spark, folder)
    return rejected_interactions(_repeated(rows), rows.where("operation = 'view'"))


@query("S6_insert_features", f"""{CALLS}
SELECT operation AS feature_name, user_id AS entity_id, input_tokens::VARCHAR AS value, 'numeric' AS feature_type,
  date::VARCHAR AS date, 1 AS version FROM calls WHERE date > DATE '2024-01-05'""")
def s6(spark, folder):
    rows = calls(spark, folder).select(
        F.col("operation").alias("feature_name"), F.col("user_id").alias("entity_id"),
        F.col("input_tokens").alias("value"), "timestamp")
    early = F.to_date("timestamp") <= F.lit("2024-01-05").cast("date")
    stored = insert_features(rows.where(early))
    new = insert_features(rows.unionByName(rows.where("feature_name = 'click'")), stored)
    return new.select("feature_name", "entity_id", "value", "feature_type", text("date"), "version")


def _archive(spark, name="archive"):
    return Archive(spark, work_folder(spark, name))


def _before(day):
    return F.col("date") < F.lit(day).cast("date")


@query("S7_archive_write", f"""{CALLS}
SELECT date::VARCHAR AS date, count(*) AS rows, sum(total_tokens)::BIGINT AS tokens FROM calls GROUP BY date""")
def s7(spark, folder):
    root, rows = work_folder(spark, "days"), calls(spark, folder)
    write_days(rows.where(_before("2024-01-15")), root)
    write_days(rows.where(~_before("2024-01-15")), root)
    write_days(rows.where("false"), root)
    # One day written again replaces itself and no other.
    write_days(rows.where("date = DATE '2024-01-10'"), root, "overwrite")
    return read_days(spark, root).groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_tokens").alias("tokens")).withColumn("date", text("date"))


@query("S8_archive_read", f"""{CALLS}
SELECT interaction_id, date::VARCHAR AS date, model FROM calls
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND user_id = 'user_7'""")
def s8(spark, folder):
    root = work_folder(spark, "days")
    write_days(calls(spark, folder), root)
    rows = read_days(spark, root, "2024-01-05", "2024-01-20", "user_7", limit=0)
    return rows.select("interaction_id", text("date"), "model")


def _commits(spark, folder):
    archive, rows = _archive(spark), calls(spark, folder)
    archive.write_interactions(rows.where("operation = 'click'"))
    archive.write_interactions(rows.where("operation = 'view'"))
    archive.write_interactions(rows.where("operation = 'error'"), mode="overwrite")
    archive.write_interactions(rows.where(~F.col("operation").isin("click", "view", "error")))
    return archive


@query("S9_archive_history", f"""{CALLS}
SELECT 0 AS version, 'append' AS mode, count(*) AS row_count FROM calls WHERE operation = 'click'
UNION ALL SELECT 1, 'append', count(*) FROM calls WHERE operation = 'view'
UNION ALL SELECT 2, 'overwrite', count(*) FROM calls WHERE operation = 'error'
UNION ALL SELECT 3, 'append', count(*) FROM calls WHERE operation NOT IN ('click', 'view', 'error')""")
def s9(spark, folder):
    return _commits(spark, folder).history().select("version", "mode", "row_count")


@query("S10_archive_time_travel", f"""{CALLS}
SELECT 'then' AS at, interaction_id FROM calls WHERE operation IN ('click', 'view')
UNION ALL SELECT 'now', interaction_id FROM calls WHERE operation NOT IN ('click', 'view')""")
def s10(spark, folder):
    archive = _commits(spark, folder)
    then = archive.time_travel(1).select(F.lit("then").alias("at"), "interaction_id")
    return then.union(archive.read().select(F.lit("now"), "interaction_id"))


@query("S11_archive_compact", f"""{CALLS}
SELECT interaction_id, total_tokens, date::VARCHAR AS date FROM calls WHERE operation NOT IN ('click', 'view')""")
def s11(spark, folder):
    archive = _commits(spark, folder)
    archive.optimize()
    return archive.read().select("interaction_id", "total_tokens", text("date"))


@query("S12_archive_move", f"""{CALLS}
SELECT CASE WHEN date < DATE '{AS_OF}' - INTERVAL 15 DAY THEN 'cold' ELSE 'warm' END AS tier, interaction_id FROM calls""")
def s12(spark, folder):
    root, rows = work_folder(spark, "days"), calls(spark, folder)
    # Some days were moved before, and one was left half done.
    move_days(rows.where(_before("2024-01-08") & (F.col("operation") != "click")), root, AS_OF, 15)
    keep = move_days(rows, root, AS_OF, 15)
    warm = keep.select(F.lit("warm").alias("tier"), "interaction_id")
    return warm.union(read_days(spark, root).select(F.lit("cold"), "interaction_id"))


_PLAIN_FIELDS = ["interaction_id", "user_id", "session_id", "model", "provider", "prompt", "response", "metadata",
                 "input_tokens", "output_tokens", "total_tokens"]


@query("S13_publish_interactions", f"""{CALLS}
SELECT user_id AS key, {", ".join(f"{c}::VARCHAR AS {c}" for c in _PLAIN_FIELDS)}, round(latency_ms, 7) AS latency_ms,
  round(cost_usd, 7) AS cost_usd, "timestamp"::VARCHAR AS "timestamp", date::VARCHAR AS date FROM calls""")
def s13(spark, folder):
    messages = as_messages(calls(spark, folder))
    field = lambda name: F.get_json_object("value", f"$.{name}")
    numbers = [F.round(field(c).cast("double"), 7).alias(c) for c in ("latency_ms", "cost_usd")]
    moments = [field("timestamp").cast("timestamp_ntz").cast("string").alias("timestamp"), field("date").alias("date")]
    return messages.select("key", *[field(c).alias(c) for c in _PLAIN_FIELDS], *numbers, *moments)


_SIX = """SELECT user_id AS entity_id, count(*)::VARCHAR AS interaction_count, sum(total_tokens)::VARCHAR AS total_tokens,
  round(sum(cost_usd), 7)::VARCHAR AS total_cost, round(avg(latency_ms), 7)::VARCHAR AS avg_latency,
  arg_max(model, ("timestamp", interaction_id)) AS last_model, max("timestamp")::VARCHAR AS last_interaction_time FROM {}
GROUP BY user_id"""


@query("S14_publish_online_features", f"""{CALLS}, six AS ({_SIX.format("calls WHERE operation <> 'error'")})
SELECT entity_id, feature_name, CASE WHEN feature_name IN ('total_cost', 'avg_latency') THEN value::DECIMAL(20, 7)::VARCHAR ELSE value END AS value,
  '2024-01-30 12:05:00' AS expires_at FROM (UNPIVOT six ON COLUMNS(* EXCLUDE entity_id) INTO NAME feature_name VALUE value)""")
def s14(spark, folder):
    root, rows = work_folder(spark, "online"), calls(spark, folder)
    # Totals of each user, published after the 20th and again at the end.
    for part, moment in ((rows.where(_before("2024-01-20")), datetime(2024, 1, 20)), (rows.where(F.col("operation") != "error"), NOON)):
        N.publish_online_features(N.online_rows(O.online_features_lifetime(part), O.ONLINE_NAMES, moment), root)
    return rounded_values(N.read_online(spark, root, NOON)).select("entity_id", "feature_name", "value", text("expires_at"))


def _entries(spark, folder, ttl=86400):
    """One entry per user and operation, written at its last call."""
    last = calls(spark, folder).groupBy("user_id", "operation").agg(
        F.max("timestamp").alias("written_at"), F.count(F.lit(1)).cast("string").alias("value"))
    rows = last.select(F.col("user_id").alias("entity_id"), F.col("operation").alias("feature_name"), "value", "written_at")
    return N.with_expiry(rows, ttl)


@query("S15_expire_entries", f"""{CALLS}, w AS (
SELECT user_id AS entity_id, operation AS feature_name, max("timestamp") + INTERVAL 86400 SECOND AS e FROM calls GROUP BY 1, 2)
SELECT entity_id, feature_name, e::VARCHAR AS expires_at FROM w WHERE e > TIMESTAMP '2024-01-30 12:00:00'""")
def s15(spark, folder):
    return N.visible(_entries(spark, folder), NOON).select("entity_id", "feature_name", text("expires_at"))


@query("S16_delete_key", """WITH asked(entity_id) AS (VALUES ('user_7'), ('nobody'))
SELECT entity_id, EXISTS (SELECT 1 FROM events WHERE concat('user_', user_id::VARCHAR) = entity_id) AS existed,
  (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events) e
   WHERE concat('user_', e.user_id::VARCHAR) <> entity_id) AS stay FROM asked""")
def s16_key(spark, folder):
    entries, found = _entries(spark, folder), []
    for key in ("user_7", "nobody"):
        stay, existed = N.delete_key(entries, key, "entity_id")
        found.append(existed.select(
            F.lit(key).alias("entity_id"), "existed", stay.agg(F.count("*").alias("n")).scalar().alias("stay")))
    return found[0].union(found[1])


@query("S16_delete_by_pattern", f"""{CALLS}, k AS (
SELECT DISTINCT 'feature:' || user_id || ':' || operation AS key FROM calls)
SELECT 'kept' AS outcome, key, 1::BIGINT AS n FROM k WHERE NOT regexp_matches(key, '^feature:user_1.:c[^a-k]*')
UNION ALL SELECT 'deleted', '', count(*) FROM k WHERE regexp_matches(key, '^feature:user_1.:c[^a-k]*')""")
def s16(spark, folder):
    keyed = _entries(spark, folder).withColumn("key", N.entry_key())
    kept, deleted = N.delete_by_pattern(keyed, "feature:user_1?:c[^a-k]*", "key")
    rest = kept.select(F.lit("kept").alias("outcome"), "key", F.lit(1).cast("long").alias("n"))
    return rest.union(deleted.select(F.lit("deleted"), F.lit(""), "deleted"))


@query("U1_read_all_tiers", f"""{CALLS}
SELECT interaction_id, date::VARCHAR AS date, CASE WHEN date >= DATE '2024-01-10' THEN metadata END AS metadata FROM calls""")
def u1(spark, folder):
    root, rows = work_folder(spark, "days"), calls(spark, folder)
    write_days(rows.where(_before("2024-01-20")).drop("event_type", "is_error", "cache_hit", "operation"), root)
    warm = rows.where(~_before("2024-01-10"))
    return read_all_tiers(warm, read_days(spark, root)).select("interaction_id", text("date"), "metadata")


# --- validation -------------------------------------------------------------


@query("V1_validate_interactions", f"""{CALLS}
SELECT interaction_id, array_to_string({_REASONS}, ',') AS reasons FROM calls""")
def v1(spark, folder):
    # Both sides of the split in one pass: a row that breaks no rule has no reasons.
    marked = V.with_reasons(with_faults(calls(spark, folder)), V.interaction_rules())
    return marked.select("interaction_id", F.array_join(V.REASONS, ",").alias("reasons"))


@query("V2_validate_embedding_requests", """
SELECT doc_id::VARCHAR AS request_id, CASE WHEN doc_id % 3 = 0 THEN 'all-MiniLM-L6-v2' ELSE 'other' END AS model,
  CASE WHEN doc_id % 5 = 0 THEN 'text_empty' ELSE '' END AS reasons FROM documents""")
def v2(spark, folder):
    n = F.col("doc_id")
    rows = documents(spark, folder).select(
        n.cast("string").alias("request_id"),
        F.when(n % 5 == 0, "").when(n % 7 == 0, " ").otherwise(F.col("text")).alias("text"),
        F.when(n % 3 != 0, "other").alias("model"))
    valid, invalid = V.validate_embedding_requests(rows)
    good = valid.select("request_id", "model", F.lit("").alias("reasons"))
    return good.union(invalid.select("request_id", "model", F.array_join(V.REASONS, ",")))


@query("V3_validate_embedding_responses", """
SELECT vec_id::VARCHAR AS request_id, array_to_string(list_filter([
  CASE WHEN vec_id % 4 = 0 THEN 'embedding_empty' END, CASE WHEN vec_id % 6 = 0 THEN 'latency_ms_negative' END,
  CASE WHEN vec_id % 10 = 0 THEN 'cost_usd_negative' END], lambda x: x IS NOT NULL), ',') AS reasons FROM embeddings""")
def v3(spark, folder):
    n = F.col("vec_id")
    rows = read_table(spark, folder, "embeddings").select(
        n.cast("string").alias("request_id"),
        F.when(n % 4 == 0, F.array().cast("array<float>")).otherwise(F.col("embedding")).alias("embedding"),
        F.lit("m").alias("model"), F.lit(False).alias("cache_hit"),
        F.when(n % 6 == 0, -1.0).otherwise(2.0).alias("latency_ms"),
        F.when(n % 10 == 0, -1.0).alias("cost_usd"))
    valid, invalid = V.validate_embedding_responses(rows)
    good = valid.select("request_id", F.lit("").alias("reasons"))
    return good.union(invalid.select("request_id", F.array_join(V.REASONS, ",")))


@query("V4_validate_drift_results", """
SELECT event_id, array_to_string(list_filter([
  CASE WHEN event_id % 6 = 0 THEN 'window_end_missing' END, CASE WHEN value < 5 THEN 'drift_score_negative' END],
  lambda x: x IS NOT NULL), ',') AS reasons FROM events""")
def v4(spark, folder):
    rows = read_table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("feature_name"), F.col("user_id").cast("string").alias("entity_id"),
        F.lit("warning").alias("drift_status"), (F.col("value") - 5).alias("drift_score"), F.lit(0.1).alias("threshold"),
        F.col("ts").alias("window_start"), F.when(F.col("event_id") % 6 != 0, F.col("ts")).alias("window_end"))
    valid, invalid = V.validate_drift_results(rows)
    good = valid.select("event_id", F.lit("").alias("reasons"))
    return good.union(invalid.select("event_id", F.array_join(V.REASONS, ",")))


@query("V5_validate_cost_summaries", f"""{CALLS}, s AS (
SELECT session_id, sum(total_tokens) / 500 AS rate FROM calls GROUP BY session_id)
SELECT session_id, CASE WHEN rate > 1 THEN 'cache_hit_rate_out_of_range' ELSE '' END AS reasons FROM s""")
def v5(spark, folder):
    rows = calls(spark, folder).groupBy("session_id").agg(
        F.min("timestamp").alias("period_start"), F.max("timestamp").alias("period_end"),
        F.sum("cost_usd").alias("total_cost_usd"), F.sum("total_tokens").alias("total_tokens"),
        F.count(F.lit(1)).alias("total_interactions"), F.lit(None).cast("double").alias("cost_saved_by_cache"),
        (F.sum("total_tokens") / 500).alias("cache_hit_rate"))
    valid, invalid = V.validate_cost_summaries(rows)
    good = valid.select("session_id", F.lit("").alias("reasons"))
    return good.union(invalid.select("session_id", F.array_join(V.REASONS, ",")))


@query("V6_apply_defaults", """
SELECT event_id, NULL::VARCHAR AS session_id, CASE WHEN event_id % 2 = 0 THEN props ELSE '{}' END AS metadata,
  CASE WHEN event_id % 3 = 0 THEN '2024-01-30 12:00:00' ELSE ts::VARCHAR END AS "timestamp",
  CASE WHEN event_id % 5 = 0 THEN 1 ELSE 2 END AS version FROM events""")
def v6(spark, folder):
    n = F.col("event_id")
    old = read_table(spark, folder, "events").select(
        "event_id", F.when(n % 2 == 0, F.col("props")).alias("metadata"),
        F.when(n % 3 != 0, F.col("ts")).alias("timestamp"), F.when(n % 5 != 0, 2).alias("version"))
    return V.apply_defaults(old, NOON).withColumn("timestamp", text("timestamp"))


@query("V7_validation_summary", f"""{CALLS}, m AS (SELECT {_REASONS} AS reasons FROM calls)
SELECT 'outcome' AS kind, CASE WHEN len(reasons) = 0 THEN 'valid' ELSE 'invalid' END AS name, count(*) AS rows
FROM m GROUP BY 2
UNION ALL SELECT 'reason', name, count(*) FROM (SELECT unnest(reasons) AS name FROM m) GROUP BY name""")
def v7(spark, folder):
    return V.validation_summary(with_faults(calls(spark, folder)))


# --- streaming jobs ---------------------------------------------------------


def _event_stream(spark, folder):
    return interactions_from_events(stream_table(spark, folder, "events"))


@query("T10_streaming_dedupe", f"{CALLS} SELECT interaction_id, operation AS event_type FROM calls")
def t10(spark, folder):
    path = work_folder(spark, "dedupe")
    twice = _event_stream(spark, folder).unionByName(_event_stream(spark, folder).where("event_type = 'click'"))
    once = J.streaming_dedupe(twice).select("interaction_id", "event_type")
    J.landed(J.start_metric(once, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out")


@query("T11_sessionized_online_features", f"""{CALLS}, g AS (
SELECT *, CASE WHEN epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w) >= 300000000
  OR lag("timestamp") OVER w IS NULL THEN 1 ELSE 0 END AS s FROM calls
WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", interaction_id)),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY "timestamp", interaction_id) AS session_no FROM g),
closed AS (SELECT user_id, min("timestamp") AS session_start, sum(cost_usd) AS total_cost, sum(total_tokens)::BIGINT AS total_tokens,
  count(*) AS interaction_count, arg_max(model, ("timestamp", interaction_id)) AS last_model,
  max("timestamp") AS last_interaction_time FROM n GROUP BY user_id, session_no)
SELECT user_id, session_start::VARCHAR AS session_start, round(total_cost, 7) AS total_cost, total_tokens, interaction_count,
  last_model, last_interaction_time::VARCHAR AS last_interaction_time FROM closed
WHERE last_interaction_time + INTERVAL 299999999 MICROSECOND <=
  (SELECT date_trunc('millisecond', max("timestamp")) - INTERVAL 1 HOUR FROM calls)""")
def t11(spark, folder):
    path = work_folder(spark, "sessions")
    stream = with_event_time(_event_stream(spark, folder), J.WATERMARK)
    sessions = sessionized_online_features(stream).drop("expires_at")
    J.landed(J.start_metric(sessions, f"{path}/out", f"{path}/checkpoint"))
    rows = rounded(spark.read.parquet(f"{path}/out"), "total_cost")
    return rows.withColumns({c: text(c) for c in ("session_start", "last_interaction_time")})


def _ingest(spark, path, on_accepted=None):
    messages = stream_interactions(spark, source="files", path=f"{path}/in")
    J.ingest(messages, f"{path}/facts", f"{path}/work", on_accepted)


@query("T12_ingest", f"""{CALLS}
SELECT 'fact' AS target, interaction_id, total_tokens, date::VARCHAR AS date FROM calls WHERE event_id % 7 <> 0 AND {_VALID}
UNION ALL SELECT 'dead', NULL, count(*)::INT, NULL FROM calls WHERE NOT (event_id % 7 <> 0 AND {_VALID})""")
def t12(spark, folder):
    path, rows = work_folder(spark, "ingest"), calls(spark, folder)
    faulty_messages(rows).write.text(f"{path}/in")
    _ingest(spark, path)
    # The same clicks again in a later batch: refused.
    as_messages(rows.where("operation = 'click'").where(
        (_event() % 7 != 0) & (_event() % 11 != 0) & (_event() % 13 != 0) & (_event() % 17 != 0)), RAW_NAMES
    ).select("value").write.mode("append").text(f"{path}/in")
    _ingest(spark, path)
    stored = J.read_facts(spark, f"{path}/facts").select(F.lit("fact").alias("target"), "interaction_id", "total_tokens", text("date"))
    dead = J.dead_letters(spark, f"{path}/work").agg(F.count(F.lit(1)).cast("int").alias("n"))
    nothing = F.lit(None).cast("string")
    return stored.union(dead.select(F.lit("dead"), nothing, "n", nothing))


@query("T13_late_data", f"{CALLS} SELECT interaction_id, date::VARCHAR AS date FROM calls")
def t13(spark, folder):
    path, rows = work_folder(spark, "late"), calls(spark, folder)
    for part in (rows.where(~_before("2024-01-10")), rows.where(_before("2024-01-10"))):
        as_messages(part, RAW_NAMES).select("value").write.mode("append").text(f"{path}/in")
        _ingest(spark, path)
    return J.read_facts(spark, f"{path}/facts").select("interaction_id", text("date"))


@query("U2_on_interaction", f"""{CALLS}
SELECT model, count(*) AS calls FROM calls WHERE event_id % 7 <> 0 AND {_VALID} GROUP BY model""")
def u2(spark, folder):
    path = work_folder(spark, "callback")
    faulty_messages(calls(spark, folder)).write.text(f"{path}/in")

    def tally(accepted, batch_id):
        counts = accepted.groupBy("model").agg(F.count(F.lit(1)).alias("calls"))
        counts.write.mode("overwrite").parquet(f"{path}/tally/batch={batch_id}")

    _ingest(spark, path, tally)
    seen = spark.read.parquet(f"{path}/tally")
    return seen.groupBy("model").agg(F.sum("calls").alias("calls"))


@query("O2_online_features_stream", f"""{CALLS}, six AS ({_SIX.format("calls")})
SELECT entity_id, feature_name, CASE WHEN feature_name IN ('total_cost', 'avg_latency') THEN value::DECIMAL(20, 7)::VARCHAR ELSE value END AS value
FROM (UNPIVOT six ON COLUMNS(* EXCLUDE entity_id) INTO NAME feature_name VALUE value)""")
def o2_stream(spark, folder):
    path = work_folder(spark, "online")
    J.landed(J.start_online_features(_event_stream(spark, folder), f"{path}/online", f"{path}/checkpoint"))
    return rounded_values(N.stored_entries(spark, f"{path}/online").where("entity_id <> ''")).select("entity_id", "feature_name", "value")
