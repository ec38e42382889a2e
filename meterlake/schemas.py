"""Table schemas and fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(*fields) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


STR, INT, LONG, DBL = StringType(), IntegerType(), LongType(), DoubleType()
TS, DAY, BOOL = TimestampNTZType(), DateType(), BooleanType()
VECTOR = ArrayType(FloatType())

# What a producer sends. Everything is nullable here: the rules in
# operators.validation decide what is required, so that a bad record can be
# kept with its reasons instead of failing the read.
RAW_INTERACTION = _struct(
    ("interaction_id", STR, True),
    ("user_id", STR, True),
    ("session_id", STR, True),
    ("model", STR, True),
    ("provider", STR, True),
    ("prompt", STR, True),
    ("response", STR, True),
    ("input_tokens", INT, True),
    ("output_tokens", INT, True),
    ("latency_ms", DBL, True),
    ("cost_usd", DBL, True),
    ("timestamp", TS, True),
    ("metadata", STR, True),
)

INTERACTION = _struct(
    ("interaction_id", STR, False),
    ("user_id", STR, False),
    ("session_id", STR, True),
    ("model", STR, False),
    ("provider", STR, False),
    ("prompt", STR, False),
    ("response", STR, False),
    ("input_tokens", INT, False),
    ("output_tokens", INT, False),
    ("total_tokens", INT, False),
    ("latency_ms", DBL, False),
    ("cost_usd", DBL, False),
    ("timestamp", TS, False),
    ("date", DAY, False),
    ("metadata", STR, True),
)

# The archive keeps every interaction column but metadata.
ARCHIVE_COLUMNS = [f.name for f in INTERACTION if f.name != "metadata"]

FEATURE = _struct(
    ("feature_name", STR, False),
    ("entity_id", STR, False),
    ("value", STR, False),
    ("feature_type", STR, False),
    ("timestamp", TS, False),
    ("date", DAY, False),
    ("version", INT, True),
    ("metadata", STR, True),
)
FEATURE_KEY = ["feature_name", "entity_id", "timestamp"]

ONLINE_FEATURE = _struct(
    ("entity_id", STR, False),
    ("feature_name", STR, False),
    ("value", STR, True),
    ("written_at", TS, False),
    ("expires_at", TS, False),
)

EMBEDDING_REQUEST = _struct(
    ("request_id", STR, True),
    ("text", STR, True),
    ("model", STR, True),
    ("entity_id", STR, True),
    ("interaction_id", STR, True),
    ("cache_ttl", INT, True),
    ("timestamp", TS, True),
)

EMBEDDING_RESPONSE = _struct(
    ("request_id", STR, False),
    ("embedding", VECTOR, True),
    ("model", STR, False),
    ("cache_hit", BOOL, False),
    ("latency_ms", DBL, True),
    ("cost_usd", DBL, False),
    ("timestamp", TS, False),
    ("dimension", INT, True),
)

EMBEDDING_CACHE = _struct(
    ("cache_key", STR, False),
    ("model", STR, False),
    ("embedding", VECTOR, False),
    ("written_at", TS, False),
    ("expires_at", TS, False),
    ("latency_ms", DBL, True),
)

DRIFT_RESULT = _struct(
    ("feature_name", STR, False),
    ("entity_id", STR, False),
    ("drift_status", STR, False),
    ("drift_score", DBL, False),
    ("threshold", DBL, False),
    ("historical_mean", DBL, True),
    ("current_mean", DBL, True),
    ("historical_std", DBL, True),
    ("current_std", DBL, True),
    ("window_start", TS, False),
    ("window_end", TS, False),
    ("details", MapType(STR, STR), True),
)

COST_METRIC = _struct(
    ("timestamp", TS, False),
    ("operation", STR, False),
    ("model", STR, False),
    ("user_id", STR, True),
    ("input_tokens", INT, False),
    ("output_tokens", INT, False),
    ("total_tokens", INT, False),
    ("cost_usd", DBL, False),
    ("latency_ms", DBL, False),
    ("cache_hit", BOOL, False),
)

PERF_METRIC = _struct(
    ("timestamp", TS, False),
    ("operation", STR, False),
    ("duration_ms", DBL, False),
    ("success", BOOL, False),
    ("error", STR, True),
)

# --- fixed values -----------------------------------------------------------

PROVIDERS = ["openai", "anthropic", "cohere", "huggingface", "local"]
FEATURE_TYPES = ["embedding", "numeric", "categorical", "text", "cost"]

# USD per 1000 tokens: (model, input, output)
PRICES = [
    ("gpt-4", 0.03, 0.06),
    ("gpt-4-32k", 0.06, 0.12),
    ("gpt-3.5-turbo", 0.0015, 0.002),
    ("claude-3-opus", 0.015, 0.075),
    ("claude-3-sonnet", 0.003, 0.015),
]

DEFAULT_EMBEDDING_MODEL = "all-MiniLM-L6-v2"
EMBEDDING_DIMENSION = 384
EMBEDDING_BATCH_SIZE = 32
EMBEDDING_TTL_SECONDS = 86400
FEATURE_TTL_SECONDS = 300
COST_SAVED_PER_HIT = 0.0001

DRIFT_THRESHOLD = 0.1
DRIFT_WINDOW_DAYS = 7
PSI_BINS = 10
PSI_EMPTY_SHARE = 0.0001

TOPIC_INTERACTIONS = "llm-interactions"
TOPIC_EMBEDDING_REQUESTS = "embedding-requests"

ARCHIVE_RETENTION_HOURS = 720
ARCHIVE_AFTER_DAYS = 90


def price_table(spark: SparkSession, prices=None) -> DataFrame:
    """The price list as a small dimension table (model, price_in, price_out)."""
    rows = PRICES if prices is None else prices
    entries = [
        F.struct(F.lit(model).alias("model"), F.lit(float(cost_in)).alias("price_in"),
                 F.lit(float(cost_out)).alias("price_out"))
        for model, cost_in, cost_out in rows
    ]
    return spark.sql("SELECT 1").select(F.inline(F.array(*entries)))
