"""Reading and publishing interaction events, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from meterlake.functions import scalars as S
from meterlake.operators.pricing import estimate_cost
from meterlake.schemas import (
    ARCHIVE_COLUMNS,
    EMBEDDING_REQUEST,
    INTERACTION,
    RAW_INTERACTION,
    STR,
    TOPIC_EMBEDDING_REQUESTS,
    TOPIC_INTERACTIONS,
)

CORRUPT = "_corrupt"


def with_derived(df: DataFrame) -> DataFrame:
    """Add total_tokens and date, and put the columns in table order."""
    df = df.withColumn("total_tokens", S.total_tokens()).withColumn("date", S.event_date())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INTERACTION])


def read_interactions(spark: SparkSession, path, format: str = "parquet", **options) -> DataFrame:
    """Load interactions with the declared schema; nothing is inferred.

    Columns missing in older files are read as null.
    """
    raw = spark.read.format(format).schema(RAW_INTERACTION).options(**options).load(path)
    return with_derived(raw)


def _stream(spark, source, topic, path, max_offsets, servers, options) -> DataFrame:
    reader = spark.readStream
    if source == "kafka":
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
        )
        if max_offsets is not None:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets)
        raw = reader.options(**options).load()
        return raw.select(
            F.col("value").cast("string").alias("value"),
            F.col("partition").cast("string").alias("source_partition"),
            F.col("offset").cast("string").alias("source_offset"),
        )
    raw = reader.format("text").options(**options).load(path)
    return raw.select(
        "value",
        F.col("_metadata.file_name").alias("source_partition"),
        F.col("_metadata.file_block_start").cast("string").alias("source_offset"),
    )


def stream_interactions(
    spark: SparkSession,
    source: str = "kafka",
    path: str | None = None,
    topic: str = TOPIC_INTERACTIONS,
    servers: str = "localhost:9092",
    max_offsets: int | None = None,
    **options,
) -> DataFrame:
    """Raw JSON messages of the interaction topic, or of a folder of JSON lines.

    max_offsets limits the number of records taken per trigger from a broker; by
    default a trigger takes all there are.
    """
    return _stream(spark, source, topic, path, max_offsets, servers, options)


def stream_embedding_requests(
    spark: SparkSession,
    source: str = "kafka",
    path: str | None = None,
    topic: str = TOPIC_EMBEDDING_REQUESTS,
    servers: str = "localhost:9092",
    max_offsets: int | None = None,
    **options,
) -> DataFrame:
    return _stream(spark, source, topic, path, max_offsets, servers, options)


def decode_json(messages: DataFrame, schema: StructType = RAW_INTERACTION, value: str = "value") -> DataFrame:
    """Decode one JSON object per row. A row that is not valid JSON, or whose types
    do not fit, keeps its text in _corrupt. Other columns of messages are kept."""
    wide = StructType(list(schema.fields) + [StructField(CORRUPT, STR, True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # As a generator the text is parsed once; a plain column would be parsed again
    # for every field that a later filter looks at.
    return messages.select("*", F.inline(F.array(F.from_json(value, wide, options))))


def decode_embedding_requests(messages: DataFrame) -> DataFrame:
    return decode_json(messages, EMBEDDING_REQUEST)


def as_messages(interactions: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Events as (key, value) messages: value is the JSON object, key the user."""
    names = columns or [c for c in ARCHIVE_COLUMNS + ["metadata"] if c in interactions.columns]
    return interactions.select(
        F.col("user_id").alias("key"), S.serialize_interaction(*names).alias("value")
    )


def publish_interactions(
    interactions: DataFrame,
    sink: str = "kafka",
    path: str | None = None,
    topic: str = TOPIC_INTERACTIONS,
    servers: str = "localhost:9092",
    **options,
) -> None:
    """Send events to the topic, or append them as JSON lines to a folder."""
    messages = as_messages(interactions)
    if sink == "kafka":
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
        writer.option("topic", topic).options(**options).save()
    else:
        messages.select("value").write.mode("append").options(**options).text(path)


# --- events of the test data ------------------------------------------------


def interactions_from_events(events: DataFrame) -> DataFrame:
    """Interaction rows made from a generic event table (event_id, ts, user_id,
    event_type, value, props). Adds is_error and event_type for the metrics."""
    calls = events.selectExpr(
        "concat('int_', event_id) AS interaction_id",
        "concat('user_', user_id) AS user_id",
        "concat('sess_', user_id, '_', to_date(ts)) AS session_id",
        "CASE event_id % 5 WHEN 0 THEN 'gpt-4' WHEN 1 THEN 'gpt-3.5-turbo' WHEN 2 THEN 'claude-3-opus' "
        "WHEN 3 THEN 'claude-3-sonnet' ELSE 'other-model' END AS model",
        "CASE WHEN event_id % 5 < 2 THEN 'openai' WHEN event_id % 5 < 4 THEN 'anthropic' ELSE 'local' END AS provider",
        "concat('Test prompt ', event_id) AS prompt",
        "concat('Test response ', event_id) AS response",
        "CAST(get_json_object(props, '$.k') AS INT) + 10 AS input_tokens",
        "CAST(event_id % 300 AS INT) + 20 AS output_tokens",
        "input_tokens + output_tokens AS total_tokens",
        "value * 10 AS latency_ms",
        "ts AS timestamp",
        "to_date(ts) AS date",
        "props AS metadata",
        "event_type",
        "event_type = 'error' AS is_error",
    )
    return estimate_cost(calls).select(*[f.name for f in INTERACTION], "event_type", "is_error")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_test_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return interactions_from_events(read_table(spark, folder, "events"))


def stream_table(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    """A test table as a file stream."""
    schema = read_table(spark, folder, name).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.options(**options).parquet(folder)
