"""Streaming jobs: ingest into the fact table, online features, metrics, embeddings."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from meterlake.functions import scalars as S
from meterlake.operators.embeddings import EmbedderFactory, EmbeddingCache, embed_requests, hash_embedder
from meterlake.operators.facts import INTERACTION_KEY
from meterlake.operators.features import online_features_lifetime
from meterlake.operators.validation import OUTCOME, REASONS, apply_defaults, mark_messages, split_messages
from meterlake.schemas import INTERACTION
from meterlake.sources.interactions import decode_embedding_requests, decode_json, with_derived
from meterlake.sources.online import online_rows, publish_online_features
from meterlake.streaming.windows import with_event_time

WATERMARK = "1 hour"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
AVAILABLE_NOW = {"availableNow": True}
LIFETIME_NAMES = ["total_cost", "total_tokens", "interaction_count", "avg_latency", "last_model",
                  "last_interaction_time"]


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def streaming_dedupe(stream: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """One row per interaction_id among rows that arrive within the delay of each
    other; state older than the watermark is dropped. Any repeat that comes
    later is refused by the ids that the ingest keeps."""
    return with_event_time(stream, delay).dropDuplicatesWithinWatermark(INTERACTION_KEY)


# --- ingest -------------------------------------------------------------------

# What is written once per message: the interaction, and why it was refused.
INBOX = StructType([
    *INTERACTION.fields,
    *[StructField(name, StringType()) for name in ("value", "source_partition", "source_offset")],
    StructField(REASONS, ArrayType(StringType())),
    StructField(OUTCOME, StringType()),
])


def _made(spark: SparkSession, path: str) -> str:
    """The folder, made if it is not there; a write by partitions without rows leaves no file."""
    spark.createDataFrame([], "interaction_id string, part int").write.mode("append").partitionBy("part").parquet(path)
    return path


def start_decoding(messages: DataFrame, work: str, trigger: dict | None = None) -> StreamingQuery:
    """Raw messages -> work/inbox, by outcome: each message is decoded and checked once.

    The dead letters are the inbox's folder of that outcome. The file sink
    keeps its own record of finished batches, so a repeated one adds nothing.
    """
    marked = apply_defaults(mark_messages(decode_json(messages)))
    derived = {"total_tokens": S.total_tokens(), "date": S.event_date()}
    for name in ("source_partition", "source_offset"):
        if name not in marked.columns:
            derived[name] = F.lit(None).cast("string")
    rows = marked.withColumns(derived).select(*[F.col(f.name).cast(f.dataType) for f in INBOX])
    writer = rows.writeStream.format("parquet").partitionBy(OUTCOME).option("path", f"{work}/inbox")
    return writer.option("checkpointLocation", f"{work}/decode").trigger(**(trigger or AVAILABLE_NOW)).start()


def dead_letters(spark: SparkSession, work: str) -> DataFrame:
    rows = spark.read.schema(INBOX).parquet(f"{work}/inbox").where(F.col(OUTCOME) == "dead")
    return rows.select("value", "source_partition", "source_offset", REASONS)


def new_interactions(spark: SparkSession, work: str) -> DataFrame:
    """Stream of the inbox's valid rows whose id has not been seen, in this stream or in work/known.

    The ids live in the keyed state store, so a batch costs what the batch
    holds, however many facts there are. No watermark applies: a late row is
    new as long as its id is. Of rows with one id in one batch any is taken.
    """
    names = [f.name for f in INTERACTION]
    rows = spark.readStream.schema(INBOX).parquet(_made(spark, f"{work}/inbox"))
    rows = rows.where(F.col(OUTCOME) == "valid").select(*names, F.lit(False).alias("_known"))
    ids = spark.readStream.schema("interaction_id string").parquet(_made(spark, f"{work}/known"))
    ids = ids.withColumn("_known", F.lit(True))
    seen_once = rows.unionByName(ids, allowMissingColumns=True).dropDuplicates(INTERACTION_KEY)
    return seen_once.where("NOT _known").drop("_known")


def read_facts(spark: SparkSession, facts: str) -> DataFrame:
    """The rows of all runs; a filter on the date prunes folders."""
    rows = spark.read.schema(INTERACTION).option("basePath", facts).parquet(_made(spark, facts))
    return rows.select(*[f.name for f in INTERACTION])


def start_facts(
    spark: SparkSession,
    work: str,
    facts: str,
    on_accepted: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Inbox -> fact table, a plain folder by run, batch and date.

    A batch that is run again replaces its own folder and changes nothing
    else. Late rows land under their own date. on_accepted is called with the
    rows of every batch, read back from the table.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    run = hashlib.md5(work.encode()).hexdigest()[:8]

    def load(batch: DataFrame, batch_id: int) -> None:
        path = f"{facts}/run={run}/batch={batch_id}"
        batch.write.mode("overwrite").partitionBy("date").parquet(path)
        if on_accepted is not None:
            on_accepted(spark.read.schema(INTERACTION).parquet(path), batch_id)

    writer = new_interactions(spark, work).writeStream.foreachBatch(load)
    return writer.option("checkpointLocation", f"{work}/facts").trigger(**(trigger or AVAILABLE_NOW)).start()


def seed_known_ids(existing: DataFrame, work: str, facts: str) -> None:
    """Put the ids of facts that this run has not written into its state, once, before anything is decoded."""
    existing.select(*INTERACTION_KEY).distinct().write.mode("append").parquet(f"{work}/known")
    landed(start_facts(existing.sparkSession, work, facts))


def landed(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def ingest(messages: DataFrame, facts: str, work: str, on_accepted: Callable[[DataFrame, int], None] | None = None) -> None:
    """Take in all messages there are: decode them into the inbox, then load the facts.

    work belongs to one run of the job and holds its inbox, checkpoints and
    state. For a job that goes on, start start_decoding and start_facts with a
    trigger. A run that goes on where another one's facts are is given their
    ids by seed_known_ids.
    """
    landed(start_decoding(messages, work))
    landed(start_facts(messages.sparkSession, work, facts, on_accepted))


def decoded_stream(messages: DataFrame) -> DataFrame:
    """Valid typed interactions of a message stream; rows without a time are left out,
    since they have no place in event time."""
    valid, _ = split_messages(decode_json(messages))
    return with_derived(valid.where(F.col("timestamp").isNotNull()))


def start_online_features(
    interactions: DataFrame, online: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Lifetime totals per user, published to the online store for the users of each batch.

    The totals live in the state store and full values are written, so a
    repeated batch publishes the same entries again. So do the ids that were
    counted, however late a row is, on disk and not in memory.
    """
    interactions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    # Without a watermark: a late row counts, as it does in the facts.
    totals = online_features_lifetime(interactions.dropDuplicates(INTERACTION_KEY))

    def publish(batch: DataFrame, batch_id: int) -> None:
        publish_online_features(online_rows(batch, LIFETIME_NAMES, _now()), online)

    writer = totals.writeStream.outputMode("update").foreachBatch(publish)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start()


def start_metric(
    metric: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a windowed metric to Parquet, one row per window once it is final.

    metric is any operator of streaming.windows over a stream with a watermark.
    """
    writer = metric.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start()


def start_embedding_requests(
    messages: DataFrame,
    cache: EmbeddingCache,
    responses: str,
    refused: str,
    checkpoint: str,
    factory: EmbedderFactory = hash_embedder,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Embedding requests -> responses by batch; misses are embedded and cached. A batch run again replaces its own folders."""

    def serve(batch: DataFrame, batch_id: int) -> None:
        requests = decode_embedding_requests(batch).persist()
        try:
            done, bad = embed_requests(requests, cache, _now(), factory)
            bad.write.mode("overwrite").parquet(f"{refused}/batch={batch_id}")
            done.write.mode("overwrite").parquet(f"{responses}/batch={batch_id}")
        finally:
            requests.unpersist()

    writer = messages.writeStream.foreachBatch(serve).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()
