"""Embedding cache and similarity."""

from datetime import datetime

from pyspark.sql import functions as F

from meterlake.operators import embeddings as E
from meterlake.operators import vector_index as X
from meterlake.operators.validation import REASONS, embedding_response_rules, with_reasons
from meterlake.plans.catalog import documents, query, rounded, text
from meterlake.plans.queries_values import sql_cache_key
from meterlake.plans.session import work_folder
from meterlake.sources.interactions import read_table
from meterlake.sources.online import with_expiry

NOW = datetime(2024, 1, 31)
MODEL = "all-MiniLM-L6-v2"


def requests(spark, folder):
    """One request per document and per benchmark item; German texts use a second model."""
    model = F.when(F.col("lang") == "de", "multilingual").otherwise(MODEL)
    docs = documents(spark, folder).select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("request_id"), "text", model.alias("model"))
    items = read_table(spark, folder, "benchmark").select(
        F.concat(F.lit("item_"), F.col("item_id").cast("string")), "text", F.lit(MODEL))
    return docs.union(items).select(
        "request_id", "text", "model", F.lit(None).cast("int").alias("cache_ttl"),
        F.lit(NOW).cast("timestamp_ntz").alias("timestamp"))


_REQ = f"""WITH req AS (
SELECT 'doc_' || doc_id::VARCHAR AS request_id, text, CASE WHEN lang = 'de' THEN 'multilingual' ELSE '{MODEL}' END AS model,
  source FROM documents
UNION ALL SELECT 'item_' || item_id::VARCHAR, text, '{MODEL}', NULL FROM benchmark)"""


def stored(spark, folder):
    """Cache entries for the texts of the sources src1*: those of src10 to src14 are
    too old, the others were written half a day ago."""
    model = F.when(F.col("lang") == "de", "multilingual").otherwise(MODEL)
    rows = documents(spark, folder).where("source LIKE 'src1%'").withColumn("model", model)
    old = F.col("source").isin("src10", "src11", "src12", "src13", "src14")
    moment = F.when(old, F.lit(datetime(2024, 1, 30))).otherwise(F.lit(datetime(2024, 1, 30, 12)))
    keyed = E.with_cache_key(rows).select(
        "cache_key", "model", F.array(F.col("n_chars").cast("float")).alias("embedding"),
        moment.cast("timestamp_ntz").alias("written_at"))
    return with_expiry(keyed, 86400)


_LIVE = """live AS (SELECT DISTINCT text, CASE WHEN lang = 'de' THEN 'multilingual' ELSE 'all-MiniLM-L6-v2' END AS model, n_chars
FROM documents WHERE source LIKE 'src1%' AND source NOT IN ('src10', 'src11', 'src12', 'src13', 'src14'))"""


@query("E1_cache_lookup", f"""{_REQ}, {_LIVE}
SELECT request_id, r.model, l.text IS NOT NULL AS cache_hit, l.n_chars::DOUBLE AS stored
FROM req r LEFT JOIN live l ON r.text = l.text AND r.model = l.model""")
def e1(spark, folder):
    found = E.cache_lookup(requests(spark, folder), stored(spark, folder), NOW)
    return found.select("request_id", "model", "cache_hit", F.get("embedding", F.lit(0)).cast("double").alias("stored"))


@query("E2_embed_misses", f"""{_REQ}, {_LIVE}
SELECT DISTINCT model, {sql_cache_key('text', 'model', 64)} AS cache_key, 384 AS dimension, 1.0::DOUBLE AS norm
FROM req r WHERE NOT EXISTS (SELECT 1 FROM live l WHERE r.text = l.text AND r.model = l.model)""")
def e2(spark, folder):
    wanted = E.misses(requests(spark, folder), stored(spark, folder), NOW)
    vectors = E.embed_texts(wanted)
    return vectors.select(
        "model", "cache_key", F.size("embedding").alias("dimension"),
        F.round(F.sqrt(E.dot("embedding", "embedding")), 4).alias("norm"))


@query("E3_cache_write_back", f"""{_REQ}, {_LIVE}
SELECT model, count(DISTINCT text) AS entries, '2024-02-01 00:00:00' AS expires_at FROM req r
WHERE NOT EXISTS (SELECT 1 FROM live l WHERE r.text = l.text AND r.model = l.model) GROUP BY model""")
def e3(spark, folder):
    table = E.cache_table(spark, work_folder(spark, "cache"))
    wanted = E.misses(requests(spark, folder), stored(spark, folder), NOW)
    table.add(E.cache_entries(E.embed_texts(wanted), NOW))
    live = E.current_entries(table.read(), NOW)
    return live.groupBy("model", text("expires_at")).agg(F.count(F.lit(1)).alias("entries"))


@query("E4_embed_requests", f"""{_REQ}, {_LIVE}
SELECT request_id, r.model, l.text IS NOT NULL AS cache_hit, 0::DOUBLE AS cost_usd,
  CASE WHEN l.text IS NOT NULL THEN 1 ELSE 384 END AS dimension, true AS accepted,
  l.n_chars::DOUBLE AS stored, CASE WHEN l.text IS NULL THEN 1.0::DOUBLE END AS norm
FROM req r LEFT JOIN live l ON r.text = l.text AND r.model = l.model""")
def e4(spark, folder):
    table = E.cache_table(spark, work_folder(spark, "cache"))
    table.add(stored(spark, folder))
    responses, _ = E.embed_requests(requests(spark, folder), table, NOW)
    checked = with_reasons(responses, embedding_response_rules())
    return checked.select("request_id", "model", "cache_hit", "cost_usd", "dimension", (F.size(REASONS) == 0).alias("accepted"),
                          F.when(F.col("cache_hit"), F.col("embedding")[0].cast("double")).alias("stored"),
                          F.round(F.when(~F.col("cache_hit"), F.sqrt(E.dot("embedding", "embedding"))), 4).alias("norm"))


@query("E4_refused_requests", f"""{_REQ}, odd AS (
SELECT request_id, CASE WHEN length(text) % 3 = 0 THEN '' ELSE text END AS text, model FROM req)
SELECT request_id, true AS blank FROM odd WHERE text = ''""")
def e4_refused(spark, folder):
    table = E.cache_table(spark, work_folder(spark, "cache"))
    odd = requests(spark, folder).withColumn("text", F.when(F.length("text") % 3 == 0, "").otherwise(F.col("text")))
    _, refused = E.embed_requests(odd, table, NOW)
    return refused.select("request_id", (F.size(REASONS) > 0).alias("blank"))


@query("E5_embedding_batch_metrics", f"""{_REQ}, {_LIVE}, f AS (
SELECT l.text IS NOT NULL AS hit FROM req r LEFT JOIN live l ON r.text = l.text AND r.model = l.model)
SELECT count(*) AS total_requests, count(*) FILTER (hit) AS cache_hits, count(*) FILTER (NOT hit) AS cache_misses,
  round(avg(hit::INT), 7) AS cache_hit_rate, round(count(*) FILTER (hit) * 0.0001::DOUBLE, 7) AS cost_saved_usd,
  '{MODEL}' AS model FROM f""")
def e5(spark, folder):
    found = E.cache_lookup(requests(spark, folder), stored(spark, folder), NOW)
    return rounded(E.embedding_batch_metrics(found, MODEL), "cache_hit_rate", "cost_saved_usd")


@query("E5_without_cache", f"""{_REQ}
SELECT count(*) AS total_requests, 0 AS cache_hits, count(*) AS cache_misses, 0::DOUBLE AS cache_hit_rate,
  0::DOUBLE AS cost_saved_usd, '{MODEL}' AS model FROM req""")
def e5_without_cache(spark, folder):
    table = E.cache_table(spark, work_folder(spark, "cache"))
    table.add(stored(spark, folder))
    responses, _ = E.embed_requests(requests(spark, folder), table, NOW, use_cache=False)
    return rounded(E.embedding_batch_metrics(responses, MODEL), "cache_hit_rate", "cost_saved_usd")


@query("E6_get_many", f"""{_LIVE.replace('live AS', 'WITH live AS')}
SELECT doc_id AS position, l.n_chars::DOUBLE AS stored FROM documents d LEFT JOIN live l
  ON d.text = l.text AND CASE WHEN d.lang = 'de' THEN 'multilingual' ELSE 'all-MiniLM-L6-v2' END = l.model""")
def e6(spark, folder):
    model = F.when(F.col("lang") == "de", "multilingual").otherwise(MODEL)
    asked = E.with_cache_key(documents(spark, folder).withColumn("model", model))
    keys = asked.select(F.col("doc_id").alias("position"), "cache_key")
    rows = E.get_many(keys, stored(spark, folder), NOW)
    return rows.select("position", F.get("embedding", F.lit(0)).cast("double").alias("stored"))


@query("E7_cache_stats", f"""{_REQ}, {_LIVE}, f AS (
SELECT l.text IS NOT NULL AS hit FROM req r LEFT JOIN live l ON r.text = l.text AND r.model = l.model)
SELECT count(*) FILTER (hit) AS cache_hits, count(*) FILTER (NOT hit) AS cache_misses, count(*) AS total_requests,
  round(avg(hit::INT), 7) AS cache_hit_rate, (SELECT count(*) FROM live) AS entries,
  (SELECT count(*) * 4 FROM live) AS bytes FROM f""")
def e7(spark, folder):
    cache = stored(spark, folder)
    found = E.cache_lookup(requests(spark, folder), cache, NOW)
    return rounded(E.cache_stats(found, cache, NOW).drop("cost_saved_usd"), "cache_hit_rate")


@query("E8_vector_top_k", """WITH cells AS (
SELECT label, i, avg(embedding[i]::DOUBLE) AS x FROM embeddings, range(1, 65) r(i) GROUP BY label, i),
centers AS (SELECT label, list(x ORDER BY i) AS centroid FROM cells GROUP BY label),
scored AS (SELECT label, vec_id, round(list_inner_product(embedding::DOUBLE[], centroid), 7) AS score
  FROM embeddings JOIN centers USING (label))
SELECT label, vec_id, score, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id)::INT AS rank FROM scored
QUALIFY rank <= 5""")
def e8(spark, folder):
    vectors = read_table(spark, folder, "embeddings")
    return E.vector_top_k(vectors, E.centroids(vectors, "label"), 5, "label", digits=7)


@query("E8_nearest_of_all", """WITH cells AS (
SELECT label, i, avg(embedding[i]::DOUBLE) AS x FROM embeddings, range(1, 65) r(i) GROUP BY label, i),
centers AS (SELECT label AS probe_id, list(x ORDER BY i) AS centroid FROM cells GROUP BY label),
scored AS (SELECT probe_id, vec_id, round(list_inner_product(embedding::DOUBLE[], centroid), 7) AS score FROM embeddings, centers)
SELECT probe_id, row_number() OVER (PARTITION BY probe_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= 5""")
def e8_all(spark, folder):
    vectors = read_table(spark, folder, "embeddings")
    probes = E.centroids(vectors, "label").select(F.col("label").alias("probe_id"), F.col("centroid").alias("probe"))
    return E.nearest_of_all(vectors, probes, 5)


@query("E8_nearest_of_all_by_rows", """WITH probes AS (SELECT vec_id AS probe_id, embedding AS probe FROM embeddings WHERE vec_id % 100 = 0),
scored AS (SELECT probe_id, vec_id, round(list_inner_product(embedding::DOUBLE[], probe::DOUBLE[]), 7) AS score FROM embeddings, probes)
SELECT probe_id, row_number() OVER (PARTITION BY probe_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= 5""")
def e8_all_by_rows(spark, folder):
    vectors = read_table(spark, folder, "embeddings")
    probes = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("probe_id"), F.col("embedding").alias("probe"))
    return E.nearest_of_all(vectors, probes, 5)


@query("E8_index_search", """WITH probes AS (SELECT vec_id AS probe_id, embedding AS probe FROM embeddings WHERE vec_id % 100 = 0),
scored AS (SELECT probe_id, vec_id, round(list_inner_product(embedding::DOUBLE[], probe::DOUBLE[]), 7) AS score FROM embeddings, probes)
SELECT probe_id, row_number() OVER (PARTITION BY probe_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= 5""")
def e8_index(spark, folder):
    vectors = read_table(spark, folder, "embeddings")
    probes = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("probe_id"), F.col("embedding").alias("probe"))
    path = work_folder(spark, "vector-index")
    found, _ = X.search(X.build_index(vectors, f"{path}/cells"), probes, 5, f"{path}/first-round")
    return found.withColumnRenamed("id", "vec_id")


@query("U3_pluggable_embedder", f"""{_REQ}
SELECT DISTINCT {sql_cache_key('text', 'model', 64)} AS cache_key, length(text)::DOUBLE AS chars, length(model)::DOUBLE AS salt
FROM req""")
def u3(spark, folder):
    import numpy as np

    def factory(model):
        def embed(texts):
            return np.array([[float(len(t)), float(len(model))] for t in texts])

        return embed

    vectors = E.embed_texts(E.misses(requests(spark, folder), None, NOW), factory)
    return vectors.select(
        "cache_key", F.col("embedding")[0].cast("double").alias("chars"), F.col("embedding")[1].cast("double").alias("salt"))
