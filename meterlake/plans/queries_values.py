"""Projections, filters and joins."""

from pyspark.sql import functions as F

from meterlake.functions import filters, scalars as S
from meterlake.functions.keyed import checked_broadcast, skew_join
from meterlake.functions.order_stats import distinct_counts, interpolate, linear_percentile, running_counts
from meterlake.operators import drift as D
from meterlake.operators import embeddings as E
from meterlake.operators import features as O
from meterlake.operators.facts import insert_interactions
from meterlake.operators.pricing import estimate_cost
from meterlake.plans.catalog import AS_OF, CALLS, calls, documents, query, rounded, text
from meterlake.schemas import price_table
from meterlake.sources.interactions import read_table
from meterlake.sources.online import online_rows


@query("P1_total_tokens", f"{CALLS} SELECT interaction_id, total_tokens FROM calls")
def p1(spark, folder):
    return calls(spark, folder).select("interaction_id", S.total_tokens().alias("total_tokens"))


@query("P2_cost_per_token", f"""{CALLS}
SELECT interaction_id, round(CASE WHEN total_tokens > 0 THEN cost_usd / total_tokens ELSE 0 END, 13) AS cost_per_token
FROM calls""")
def p2(spark, folder):
    return calls(spark, folder).select("interaction_id", F.round(S.cost_per_token(), 13).alias("cost_per_token"))


@query("P3_event_date", "SELECT event_id, ts::DATE::VARCHAR AS date FROM events")
def p3(spark, folder):
    events = read_table(spark, folder, "events")
    return events.select("event_id", S.event_date("ts").cast("string").alias("date"))


@query("P4_estimate_cost", f"{CALLS} SELECT interaction_id, model, round(cost_usd, 9) AS cost FROM calls")
def p4(spark, folder):
    rows = calls(spark, folder).select("interaction_id", "model", "input_tokens", "output_tokens")
    return estimate_cost(rows, column="cost").select("interaction_id", "model", F.round("cost", 9).alias("cost"))


WORD = (r"[^\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
        r"\x{202f}\x{205f}\x{3000}]+")


@query("P5_whitespace_token_count", f"""
SELECT 'documents' AS source_table, doc_id AS id, len(regexp_extract_all(text, '{WORD}'))::BIGINT AS tokens FROM documents
UNION ALL
SELECT 'conversations', conv_id * 1000 + turn, len(regexp_extract_all(text, '{WORD}'))::BIGINT FROM conversations""")
def p5(spark, folder):
    tokens = S.whitespace_token_count("text").cast("long").alias("tokens")
    docs = documents(spark, folder).select(
        F.lit("documents").alias("source_table"), F.col("doc_id").alias("id"), tokens)
    turns = read_table(spark, folder, "conversations").select(
        F.lit("conversations"), F.col("conv_id") * 1000 + F.col("turn"), tokens)
    return docs.union(turns)


def _sql_json(column: str) -> str:
    inner = f"to_json({column})::VARCHAR"
    return (
        f"array_to_string(list_transform(string_split({inner}, ''), lambda c: CASE WHEN unicode(c) BETWEEN 1 AND 126 "
        "THEN c ELSE '\\u' || printf('%04x', unicode(c)) END), '')"
    )


def sql_cache_key(text_column: str, model: str, digits: int = 16) -> str:
    body = f"'[' || {_sql_json(text_column)} || ', ' || {_sql_json(model)} || ']'"
    return f"'embedding:' || substr(sha256({body}), 1, {digits})"


@query("P6_cache_key", f"""
SELECT doc_id, {sql_cache_key('text', 'source')} AS cache_key FROM documents""")
def p6(spark, folder):
    return documents(spark, folder).select("doc_id", S.cache_key("embedding", "text", "source").alias("cache_key"))


@query("P7_dimension", "SELECT vec_id, len(embedding)::INT AS dimension FROM embeddings")
def p7(spark, folder):
    return read_table(spark, folder, "embeddings").select("vec_id", S.dimension().alias("dimension"))


_HALVES = """SELECT user_id, avg(CASE WHEN date < DATE '2024-01-16' THEN latency_ms END) AS h,
  avg(CASE WHEN date >= DATE '2024-01-16' THEN latency_ms END) AS c FROM calls GROUP BY user_id"""


@query("P8_mean_change_percent", f"""{CALLS}, halves AS ({_HALVES})
SELECT user_id, round(CASE WHEN h <> 0 AND c <> 0 THEN (c - h) / h * 100 END, 6) AS mean_change_percent FROM halves""")
def p8(spark, folder):
    early = F.col("date") < F.lit("2024-01-16").cast("date")
    means = calls(spark, folder).groupBy("user_id").agg(
        F.avg(F.when(early, F.col("latency_ms"))).alias("h"),
        F.avg(F.when(~early, F.col("latency_ms"))).alias("c"))
    return means.select("user_id", F.round(S.mean_change_percent("h", "c"), 6).alias("mean_change_percent"))


@query("P9_averages_per_interaction", f"""{CALLS}
SELECT user_id, round(sum(cost_usd) / count(*), 14) AS avg_cost_per_interaction,
  round(sum(total_tokens)::DOUBLE / count(*), 7) AS avg_tokens_per_interaction FROM calls GROUP BY user_id""")
def p9(spark, folder):
    totals = calls(spark, folder).groupBy("user_id").agg(
        F.sum("cost_usd").alias("cost"), F.sum("total_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    return totals.select(
        "user_id",
        F.round(S.safe_ratio("cost", "n"), 14).alias("avg_cost_per_interaction"),
        F.round(S.safe_ratio("tokens", "n"), 7).alias("avg_tokens_per_interaction"))


@query("P10_cost_saved", f"""{CALLS}
SELECT model, round(sum(CASE WHEN cache_hit THEN 0.0001::DOUBLE ELSE 0 END), 7) AS cost_saved FROM calls GROUP BY model""")
def p10(spark, folder):
    saved = calls(spark, folder).groupBy("model").agg(F.sum(S.cost_saved()).alias("cost_saved"))
    return rounded(saved, "cost_saved")


@query("P11_drift_detected", f"""{CALLS}, s AS (
SELECT interaction_id, CASE WHEN latency_ms > 1000 THEN 'critical' WHEN latency_ms > 500 THEN 'warning'
  ELSE 'no_drift' END AS drift_status FROM calls)
SELECT interaction_id, drift_status <> 'no_drift' AS drift_detected FROM s""")
def p11(spark, folder):
    status = D.drift_status(F.col("latency_ms"), 500.0)
    return calls(spark, folder).select(
        "interaction_id", S.drift_detected(status).alias("drift_detected"))


@query("P12_stringify_and_parse", """
SELECT vec_id, len(embedding)::INT AS n, true AS same, label::VARCHAR AS label_text, label::DOUBLE AS label_value
FROM embeddings""")
def p12(spark, folder):
    stored = read_table(spark, folder, "embeddings").select(
        "vec_id", "embedding", S.stringify_value("embedding", True).alias("value"),
        S.stringify_value("label").alias("label_text"))
    back = stored.withColumn("back", S.parse_vector("value"))
    return back.select(
        "vec_id", F.size("back").alias("n"), (F.col("back") == F.col("embedding")).alias("same"),
        "label_text", S.parse_numeric("label_text").alias("label_value"))


@query("P13_serialize_interaction", f"""{CALLS}
SELECT interaction_id, model, total_tokens, round(cost_usd, 9) AS cost_usd, "timestamp"::VARCHAR AS "timestamp"
FROM calls""")
def p13(spark, folder):
    names = ["interaction_id", "model", "total_tokens", "cost_usd", "timestamp"]
    messages = calls(spark, folder).select(S.serialize_interaction(*names).alias("value"))
    schema = "interaction_id string, model string, total_tokens int, cost_usd double, timestamp timestamp_ntz"
    back = messages.select(F.from_json("value", schema).alias("r")).select("r.*")
    return rounded(back, "cost_usd", digits=9).withColumn("timestamp", text("timestamp"))


# --- filters ----------------------------------------------------------------


@query("F1_trailing_days", f"""{CALLS}
SELECT interaction_id FROM calls WHERE date >= DATE '{AS_OF}' - INTERVAL 7 DAY""")
def f1(spark, folder):
    return filters.trailing_days(calls(spark, folder), AS_OF, 7).select("interaction_id")


@query("F2_date_range", f"""{CALLS}
SELECT interaction_id FROM calls WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'""")
def f2(spark, folder):
    return filters.date_range(calls(spark, folder), "2024-01-05", "2024-01-12").select("interaction_id")


@query("F3_entity_in", f"""{CALLS}
SELECT 'listed' AS form, interaction_id FROM calls WHERE user_id IN ('user_1', 'user_2', 'user_3')
UNION ALL
SELECT 'joined', interaction_id FROM calls WHERE user_id IN
  (SELECT 'user_' || c_custkey::VARCHAR FROM customer WHERE c_acctbal > 5000)""")
def f3(spark, folder):
    rows = calls(spark, folder)
    rich = read_table(spark, folder, "customer").where("c_acctbal > 5000").select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("user_id"))
    listed = filters.entity_in(rows, ["user_1", "user_2", "user_3"]).select(F.lit("listed").alias("form"), "interaction_id")
    return listed.union(filters.entity_in(rows, rich).select(F.lit("joined"), "interaction_id"))


@query("F4_optional_user", f"""{CALLS}
SELECT 'one' AS form, count(*) AS n FROM calls WHERE user_id = 'user_7'
UNION ALL SELECT 'all', count(*) FROM calls""")
def f4(spark, folder):
    rows = calls(spark, folder)
    one = filters.optional_user(rows, "user_7").agg(F.lit("one").alias("form"), F.count(F.lit(1)).alias("n"))
    every = filters.optional_user(rows, "").agg(F.lit("all"), F.count(F.lit(1)))
    return one.union(every)


@query("F5_key_equality", """
SELECT event_id, value::VARCHAR IS NOT NULL AS has_value FROM events WHERE event_type = 'click' AND user_id = 7""")
def f5(spark, folder):
    features = read_table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("feature_name"), F.col("user_id").cast("string").alias("entity_id"), "value")
    rows = filters.for_key(features, "7", "click")
    return rows.select("event_id", F.col("value").isNotNull().alias("has_value"))


@query("V8_lookback_check", """
SELECT event_id, (event_id % 800)::INT - 200 AS days,
  CASE WHEN event_id % 800 - 200 <= 0 THEN 'error' WHEN event_id % 800 - 200 > 365 THEN 'warning' ELSE 'ok' END AS verdict
FROM events""")
def v8(spark, folder):
    rows = read_table(spark, folder, "events").select("event_id", ((F.col("event_id") % 800).cast("int") - 200).alias("days"))
    return rows.withColumn("verdict", filters.lookback_verdict("days"))


# --- joins ------------------------------------------------------------------


@query("J1_price_lookup", f"""{CALLS}
SELECT c.model, count(*) AS n, max(coalesce(p.pin, 0)) AS price_in, max(coalesce(p.pout, 0)) AS price_out
FROM calls c LEFT JOIN prices p USING (model) GROUP BY c.model""")
def j1(spark, folder):
    priced = calls(spark, folder).select("model").join(checked_broadcast(price_table(spark)), "model", "left")
    return priced.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.coalesce("price_in", F.lit(0.0))).alias("price_in"),
        F.max(F.coalesce("price_out", F.lit(0.0))).alias("price_out"))


def _requests(spark, folder):
    return documents(spark, folder).select(
        F.col("doc_id").alias("request_id"), "text", F.lit("m").alias("model"), "source", "lang")


@query("J2_cache_lookup", """
SELECT doc_id, EXISTS (SELECT 1 FROM documents b WHERE b.text = a.text AND b.lang = 'en') AS cache_hit FROM documents a""")
def j2(spark, folder):
    asked = E.with_cache_key(_requests(spark, folder))
    cached = asked.where("lang = 'en'").select("cache_key").distinct().withColumn("cache_hit", F.lit(True))
    # One text may make up most of the requests.
    found = skew_join(asked, cached, ["cache_key"], "left")
    return found.select(F.col("request_id").alias("doc_id"), F.coalesce("cache_hit", F.lit(False)).alias("cache_hit"))


@query("J3_cache_misses", """
SELECT doc_id FROM documents a WHERE NOT EXISTS (SELECT 1 FROM documents b WHERE b.text = a.text AND b.lang = 'en')""")
def j3(spark, folder):
    asked = E.with_cache_key(_requests(spark, folder))
    cached = asked.where("lang = 'en'").select("cache_key")
    return asked.join(cached, "cache_key", "left_anti").select(F.col("request_id").alias("doc_id"))


@query("J4_dedupe_against_table", f"""{CALLS}
SELECT interaction_id, date::VARCHAR AS date FROM calls WHERE date > DATE '2024-01-10'""")
def j4(spark, folder):
    rows = calls(spark, folder)
    stored = rows.where(F.col("date") <= F.lit("2024-01-10").cast("date"))
    return insert_interactions(rows, stored).select("interaction_id", text("date"))


@query("J5_online_lookup", f"""{CALLS}, t AS (
SELECT user_id, count(*) AS n, sum(total_tokens) AS tokens FROM calls GROUP BY user_id)
SELECT c_custkey AS position, 'user_' || c_custkey::VARCHAR AS entity_id,
  t.n::VARCHAR AS interaction_count, t.tokens::VARCHAR AS total_tokens
FROM customer LEFT JOIN t ON t.user_id = 'user_' || c_custkey::VARCHAR""")
def j5(spark, folder):
    totals = O.online_features_lifetime(calls(spark, folder))
    entries = online_rows(totals, ["interaction_count", "total_tokens"], "2024-01-31")
    asked = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("position"),
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("entity_id"))
    return O.get_online_features(asked, entries, ["interaction_count", "total_tokens"])


@query("J6_two_sample_alignment", f"""{CALLS}
SELECT total_tokens::DOUBLE AS value, count(*) FILTER (date < DATE '2024-01-24') AS hist,
  count(*) FILTER (date >= DATE '2024-01-24') AS cur FROM calls GROUP BY 1""")
def j6(spark, folder):
    samples = D.samples_from_columns(calls(spark, folder), ["total_tokens"], AS_OF)
    return D._collapse(samples).select("value", "hist", "cur")


@query("J7_bin_assignment", f"""{CALLS}, q AS (
SELECT operation, quantile_cont(latency_ms, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
FROM calls GROUP BY operation)
SELECT operation, len(list_filter(edges, lambda x: x <= latency_ms))::INT AS bin, count(*) AS n
FROM calls JOIN q USING (operation) GROUP BY 1, 2""")
def j7(spark, folder):
    rows = calls(spark, folder).select("operation", F.col("latency_ms").alias("value"))
    counted = distinct_counts(rows, ["operation"], "value", n=F.lit(1))
    ranked = running_counts(counted, ["operation"], "value", ["n"])
    lows, edges = ["max(all_n) AS total"], []
    for i, q in enumerate(D._inner_edges(), start=1):
        low, high = linear_percentile("value", "cum_n", "all_n", q)
        lows += [f"{low} AS low{i}", f"{high} AS high{i}"]
        edges.append(interpolate(f"low{i}", f"high{i}", "total", q))
    per_key = ranked.groupBy("operation").agg(*map(F.expr, lows)).selectExpr(
        "operation", f"array({', '.join(edges)}) AS edges")
    placed = skew_join(counted, per_key, ["operation"], "inner").selectExpr(
        "operation", "size(filter(edges, e -> e <= value)) AS bin", "n")
    return placed.groupBy("operation", "bin").agg(F.sum("n").alias("n"))
