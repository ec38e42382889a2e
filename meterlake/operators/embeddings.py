"""Text embeddings with a shared cache: look up, embed what is missing, write back."""

from __future__ import annotations

import hashlib
import time
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions import scalars as S
from meterlake.functions.keyed import first_per_key, latest_per_key, skew_join, top_per_key
from meterlake.operators.analytics import cache_hit_rate
from meterlake.operators.validation import REASONS, validate_embedding_requests
from meterlake.plans.session import work_folder
from meterlake.schemas import (
    EMBEDDING_BATCH_SIZE,
    EMBEDDING_CACHE,
    EMBEDDING_DIMENSION,
    EMBEDDING_TTL_SECONDS,
)
from meterlake.sources.online import visible, with_expiry

# Maps a list of texts to a (len(texts), dimension) array.
Embedder = Callable[[list[str]], np.ndarray]
# Builds an embedder for a model name; runs once per Python worker and model.
EmbedderFactory = Callable[[str], Embedder]


def hash_embedder(model: str, dimension: int = EMBEDDING_DIMENSION) -> Embedder:
    """Deterministic stand-in for a model: signed word counts, scaled to length 1."""
    salt = zlib.crc32(model.encode())

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension), dtype=np.float32)
        for row, text in enumerate(texts):
            codes = np.array([zlib.crc32(word.encode(), salt) for word in text.split()], dtype=np.int64)
            signs = np.where(codes & 1, 1.0, -1.0)
            out[row] = np.bincount((codes >> 1) % dimension, weights=signs, minlength=dimension)
        norms = np.linalg.norm(out, axis=1)
        out[norms == 0, 0] = 1.0
        return out / np.where(norms == 0, 1.0, norms)[:, None]

    return embed


def with_cache_key(df: DataFrame, text: str = "text", model: str = "model") -> DataFrame:
    # The whole digest: a shorter key would give some texts another's vector.
    return df.withColumn("cache_key", S.cache_key("embedding", text, model, digits=64))


def current_entries(cache: DataFrame, as_of) -> DataFrame:
    """The newest unexpired entry per key."""
    return latest_per_key(visible(cache, as_of), ["cache_key"], ["written_at", "expires_at"])


def _hits(keys: DataFrame, cache: DataFrame, as_of) -> DataFrame:
    """cache_key and embedding of the given keys (no repeats) that the cache can serve.

    The keys go to the cache: where it is bucketed by key, it is neither
    exchanged nor sorted across tasks.
    """
    return current_entries(cache, as_of).select("cache_key", "embedding").join(keys.select("cache_key"), "cache_key")


def cache_lookup(requests: DataFrame, cache: DataFrame, as_of) -> DataFrame:
    """Requests with cache_key, embedding (null on a miss) and cache_hit.

    The key covers text and model, so models never share an entry.
    """
    keyed = with_cache_key(requests)
    hits = _hits(keyed.select("cache_key").distinct(), cache, as_of)
    # One text may make up most of the requests.
    found = skew_join(keyed, hits, ["cache_key"], "left")
    return found.withColumn("cache_hit", F.col("embedding").isNotNull())


def _asked(keyed: DataFrame) -> DataFrame:
    """Distinct (cache_key, model) with the time to live asked for last; no text is grouped or moved."""
    newest = F.max(F.struct("timestamp", "request_id", "cache_ttl"))
    asked = keyed.groupBy("cache_key", "model").agg(newest.alias("_last"))
    return asked.select("cache_key", "model", F.col("_last.cache_ttl").alias("cache_ttl"))


def _with_text(asked: DataFrame, keyed: DataFrame) -> DataFrame:
    """asked with the text of each key: every task sends one copy of a text at most."""
    texts = first_per_key(keyed.select("cache_key", "text"), ["cache_key"], [F.col("cache_key")])
    return asked.join(texts, "cache_key").select("cache_key", "model", "text", "cache_ttl")


def misses(requests: DataFrame, cache: DataFrame | None, as_of) -> DataFrame:
    """Distinct (cache_key, model, text) that the cache cannot serve, with the
    time to live asked for last."""
    keyed = with_cache_key(requests)
    wanted = _asked(keyed)
    if cache is not None:
        wanted = wanted.join(visible(cache, as_of).select("cache_key"), "cache_key", "left_anti")
    return _with_text(wanted, keyed)


def embed_texts(
    texts: DataFrame,
    factory: EmbedderFactory = hash_embedder,
    batch_size: int = EMBEDDING_BATCH_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """Replace text by embedding and latency_ms, its share of the time of its batch.

    texts has cache_key, model, text and cache_ttl.

    Encoding costs far more than moving a row, so rows are spread over a fixed
    number of partitions: adaptive execution would merge them by their bytes.
    The default is one per core, or the shuffle partitions where those are more.
    """
    session = texts.sparkSession
    parallel = partitions or max(
        session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions"))
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded: dict[str, Embedder] = {}
        for pdf in batches:
            for model, part in pdf.groupby("model", sort=False):
                if model not in loaded:
                    loaded[model] = factory(model)
                for start in range(0, len(part), batch_size):
                    piece = part.iloc[start:start + batch_size]
                    began = time.perf_counter()
                    vectors = np.asarray(loaded[model](piece["text"].tolist()), dtype=np.float32)
                    each = (time.perf_counter() - began) * 1000 / len(piece)
                    yield piece.drop(columns="text").assign(embedding=list(vectors), latency_ms=each)

    schema = "cache_key string, model string, cache_ttl int, embedding array<float>, latency_ms double"
    rows = texts.select("cache_key", "model", F.col("cache_ttl").cast("int").alias("cache_ttl"), "text")
    return rows.repartition(parallel).mapInPandas(encode, schema)


def cache_entries(embedded: DataFrame, written_at) -> DataFrame:
    """Rows for the cache table; the default time to live is one day."""
    ttl = F.coalesce("cache_ttl", F.lit(EMBEDDING_TTL_SECONDS))
    stamped = embedded.withColumn("written_at", F.lit(written_at).cast("timestamp_ntz"))
    return with_expiry(stamped, ttl).select(*[f.name for f in EMBEDDING_CACHE])


CACHE_BUCKETS = 32


class EmbeddingCache:
    """Cache entries under a folder, as a Parquet table bucketed by key.

    Adding appends one file per bucket; the newest entry of a key counts. The
    table is bucketed with the hash that joins use, so a lookup exchanges the
    keys asked for and never the cache. Take more buckets for a larger cache, and the same
    number whenever the folder is opened.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = CACHE_BUCKETS):
        self.spark, self.root, self.buckets = spark, root, buckets
        self.name = f"embedding_cache_{hashlib.md5(root.encode()).hexdigest()}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EMBEDDING_CACHE)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet CLUSTERED BY (cache_key)"
                  f" SORTED BY (cache_key) INTO {buckets} BUCKETS LOCATION '{root}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, entries: DataFrame, mode: str = "append") -> None:
        rows = entries.select(*[F.col(f.name) if f.name in entries.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EMBEDDING_CACHE])
        writer = rows.repartition(self.buckets, "cache_key").write.mode(mode).format("parquet").option("path", self.root)
        writer.bucketBy(self.buckets, "cache_key").sortBy("cache_key").saveAsTable(self.name)


def cache_table(spark: SparkSession, root: str, buckets: int = CACHE_BUCKETS) -> EmbeddingCache:
    return EmbeddingCache(spark, root, buckets)


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compact_cache(cache: EmbeddingCache, as_of) -> None:
    """Rewrite the cache with the newest entry of every key, without those that have expired."""
    cache.add(_kept(current_entries(cache.read(), as_of), "cache"), "overwrite")


def embed_requests(
    requests: DataFrame, cache: EmbeddingCache, as_of, factory: EmbedderFactory = hash_embedder,
    use_cache: bool = True, **options,
) -> tuple[DataFrame, DataFrame]:
    """(responses, refused requests); new vectors are added to the cache.

    The cache is read once, for the keys asked for. New entries are written
    aside and read back, so the model runs once per distinct text whatever is
    done with the responses, and a lost executor does not cause texts to be
    embedded again. With use_cache=False nothing counts as a hit and every
    distinct text is embedded.
    """
    good, bad = validate_embedding_requests(requests)
    keyed = with_cache_key(good)
    asked = _asked(keyed)
    if use_cache:
        entries = current_entries(cache.read(), as_of).select("cache_key", "embedding")
        found = _kept(asked.join(entries, "cache_key", "left"), "asked")
        missing = found.where("embedding IS NULL").drop("embedding")
    else:
        found = missing = asked.withColumn("embedding", F.lit(None).cast("array<float>"))
    new = _kept(cache_entries(embed_texts(_with_text(missing.drop("embedding"), keyed), factory, **options), as_of), "embedded")
    cache.add(new)
    hits = found.where("embedding IS NOT NULL").select("cache_key", "embedding", F.lit(True).alias("cache_hit"), F.lit(0.0).alias("took"))
    served = hits.unionByName(new.select("cache_key", "embedding", F.lit(False).alias("cache_hit"), F.coalesce("latency_ms", F.lit(0.0)).alias("took")))
    # The hit flag is settled per key, so the requests are joined once; a hit takes no time of the model.
    rows = skew_join(keyed, served, ["cache_key"], "left")
    responses = rows.select(
        "request_id", "embedding", "model", "cache_hit", F.col("took").alias("latency_ms"), F.lit(0.0).alias("cost_usd"),
        F.lit(as_of).cast("timestamp_ntz").alias("timestamp"), S.dimension().alias("dimension"))
    return responses, bad.select("request_id", REASONS)


def embedding_batch_metrics(lookups: DataFrame, model: str | None = None) -> DataFrame:
    """Requests, hits, misses, rate and savings; every repeat of a text counts."""
    total = cache_hit_rate(lookups)
    return total.withColumns({
        "total_requests": F.col("cache_hits") + F.col("cache_misses"),
        "model": F.lit(model),
    })


def get_many(keys: DataFrame, cache: DataFrame, as_of) -> DataFrame:
    """(position, cache_key, embedding) aligned with the asked positions, null for misses."""
    hits = _hits(keys.select("cache_key").distinct(), cache, as_of)
    found = skew_join(keys.select("position", "cache_key"), hits, ["cache_key"], "left")
    return found.select("position", "cache_key", "embedding")


def cache_stats(lookups: DataFrame, cache: DataFrame, as_of) -> DataFrame:
    """One row: hits, misses, requests, rate, live entries and their bytes."""
    live = current_entries(cache, as_of).agg(
        F.count(F.lit(1)).alias("entries"),
        F.coalesce(F.sum(F.size("embedding").cast("long") * 4), F.lit(0)).alias("bytes"),
    )
    used = cache_hit_rate(lookups).withColumn("total_requests", F.col("cache_hits") + F.col("cache_misses"))
    return used.withColumns({
        "entries": live.select("entries").scalar(), "bytes": live.select("bytes").scalar(),
    })


# --- similarity -------------------------------------------------------------


def dot(a, b) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def centroids(vectors: DataFrame, by: str, embedding: str = "embedding") -> DataFrame:
    """Mean vector per group; what is gathered per group is one row per dimension."""
    cells = vectors.select(by, F.posexplode(embedding).alias("pos", "x"))
    means = cells.groupBy(by, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = means.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("cells"))
    return ordered.select(by, F.transform("cells", lambda c: c["x"]).alias("centroid"))


def vector_top_k(
    corpus: DataFrame, probes: DataFrame, k: int, on: str, id_column: str = "vec_id",
    embedding: str = "embedding", probe: str = "centroid", digits: int | None = None,
) -> DataFrame:
    """The k corpus rows nearest to the probe of their block, by dot product.

    Rows meet probes through an equi join on the block column, and the ranking
    keeps k rows per task and block before the exchange.
    """
    score = dot(embedding, probe)
    scored = skew_join(corpus, probes, [on], "inner").select(
        on, id_column, (F.round(score, digits) if digits else score).alias("score")
    )
    return top_per_key(scored, [on], [F.desc("score"), F.col(id_column)], k)


QUERY_BLOCK = 1000
PART_ROWS = 8192
PROBE_ROWS = 1024


def vector_search(
    corpus: DataFrame, queries: list[list[float]], k: int, id_column: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """Top k per query vector for a list of vectors given by the caller.

    The corpus is read once and every batch is scored against the list, a block
    of it at a time; only the k best rows per batch and query leave the Python
    worker.
    """
    if not queries:
        raise ValueError("no query vectors")
    matrix = np.asarray(queries, dtype=np.float64)
    id_type = corpus.schema[id_column].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = pdf[id_column].to_numpy()
            rows = np.stack(pdf[embedding].to_numpy()).astype(np.float64)
            for start in range(0, len(matrix), QUERY_BLOCK):
                scores = rows @ matrix[start : start + QUERY_BLOCK].T
                for q in range(scores.shape[1]):
                    best = np.lexsort((ids, -scores[:, q]))[:k]
                    yield pd.DataFrame({"query": start + q, id_column: ids[best], "score": scores[best, q]})

    schema = f"query int, {id_column} {id_type}, score double"
    scored = corpus.select(id_column, embedding).mapInPandas(score, schema)
    return top_per_key(scored, ["query"], [F.desc("score"), F.col(id_column)], k)


def nearest_of_all(
    corpus: DataFrame, probes: DataFrame, k: int, id_column: str = "vec_id", embedding: str = "embedding",
    probe_id: str = "probe_id", probe: str = "probe", parts: int | None = None, blocks: int | None = None, digits: int = 7,
) -> DataFrame:
    """probe_id, rank, id, score: each probe's k best rows of the whole corpus by dot product.

    The corpus is dealt into parts and the probes into blocks, and every part
    meets every block once, as one matrix product in a task; k rows per probe
    leave it. There may be any number of probes. parts and blocks follow the
    row counts unless they are given, so that a task holds about PART_ROWS rows
    and PROBE_ROWS probes. Rows of either side without an id or vector take no
    part, ties go to the smaller id.
    """
    parts = parts or max(-(-corpus.count() // PART_ROWS), 1)
    blocks = blocks or max(-(-probes.count() // PROBE_ROWS), 1)
    id_type, probe_type = (df.schema[c].dataType.simpleString() for df, c in ((corpus, id_column), (probes, probe_id)))
    usable = F.col(id_column).isNotNull() & F.col(embedding).isNotNull()
    rows = corpus.where(usable).select(
        F.col(id_column).alias("id"), F.col(embedding).cast("array<double>").alias("vector"),
        F.pmod(F.xxhash64(id_column), F.lit(parts)).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
    )
    asked = probes.where(F.col(probe_id).isNotNull() & F.col(probe).isNotNull()).select(
        F.col(probe_id).alias("asked"), F.col(probe).cast("array<double>").alias("wanted"),
        F.pmod(F.xxhash64(probe_id), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
    )

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            ids = left["id"].to_numpy()
            scores = np.round(np.stack(right["wanted"].to_numpy()) @ np.stack(left["vector"].to_numpy()).T, digits)
            for name, line in zip(right["asked"], scores, strict=True):
                best = np.lexsort((ids, -line))[:k]
                found.append(pd.DataFrame({"asked": name, "id": ids[best], "score": line[best]}))
        return pd.concat(found) if found else pd.DataFrame({"asked": [], "id": [], "score": []})

    schema = f"asked {probe_type}, id {id_type}, score double"
    met = rows.groupBy("part", "block").cogroup(asked.groupBy("part", "block")).applyInPandas(score, schema)
    best = top_per_key(met, ["asked"], [F.desc("score"), F.col("id")], k)
    return best.select(F.col("asked").alias(probe_id), "rank", F.col("id").alias(id_column), "score")
