"""Row rules as column predicates: valid rows on one side, the rest with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import scalars as S
from meterlake.schemas import DEFAULT_EMBEDDING_MODEL, FEATURE_TYPES, PROVIDERS

REASONS = "reject_reasons"
OUTCOME = "outcome"


def _missing(name: str) -> Column:
    return F.col(name).isNull()


def _negative(name: str) -> Column:
    return F.col(name) < 0


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add the array of names of the rules a row breaks. A rule that is null holds."""
    failed = [F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]
    return df.withColumn(REASONS, F.array_compact(F.array(*failed)))


def split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    marked = with_reasons(df, rules)
    ok = F.size(REASONS) == 0
    return marked.where(ok).drop(REASONS), marked.where(~ok)


def interaction_rules() -> dict[str, Column]:
    required = [
        "interaction_id", "user_id", "model", "provider", "prompt", "response",
        "input_tokens", "output_tokens", "latency_ms", "cost_usd",
    ]
    rules = {f"{name}_missing": _missing(name) for name in required}
    rules["provider_unknown"] = ~F.col("provider").isin(PROVIDERS)
    rules["prompt_blank"] = S.is_blank("prompt")
    for name in ["input_tokens", "output_tokens", "latency_ms", "cost_usd"]:
        rules[f"{name}_negative"] = _negative(name)
    return rules


def validate_interactions(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(df, interaction_rules())


def embedding_request_rules() -> dict[str, Column]:
    return {
        "request_id_missing": _missing("request_id"),
        "text_missing": _missing("text"),
        # One blank is a text; only the empty string is refused.
        "text_empty": F.length("text") == 0,
    }


def validate_embedding_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = df.withColumn("model", F.coalesce("model", F.lit(DEFAULT_EMBEDDING_MODEL)))
    return split(df, embedding_request_rules())


def embedding_response_rules() -> dict[str, Column]:
    return {
        "request_id_missing": _missing("request_id"),
        "embedding_missing": _missing("embedding"),
        "embedding_empty": F.size("embedding") == 0,
        "model_missing": _missing("model"),
        "cache_hit_missing": _missing("cache_hit"),
        "latency_ms_missing": _missing("latency_ms"),
        "latency_ms_negative": _negative("latency_ms"),
        "cost_usd_negative": _negative("cost_usd"),
    }


def validate_embedding_responses(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = df.withColumn("cost_usd", F.coalesce("cost_usd", F.lit(0.0)))
    return split(df, embedding_response_rules())


def validate_drift_results(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    required = ["feature_name", "entity_id", "drift_status", "drift_score", "threshold",
                "window_start", "window_end"]
    rules = {f"{name}_missing": _missing(name) for name in required}
    rules["drift_status_unknown"] = ~F.col("drift_status").isin("no_drift", "warning", "critical")
    rules["drift_score_negative"] = _negative("drift_score")
    rules["threshold_negative"] = _negative("threshold")
    return split(df, rules)


def validate_cost_summaries(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    totals = ["total_cost_usd", "total_tokens", "total_interactions"]
    rules = {f"{name}_missing": _missing(name) for name in ["period_start", "period_end", *totals]}
    rules |= {f"{name}_negative": _negative(name) for name in totals}
    rules["cache_hit_rate_out_of_range"] = ~F.col("cache_hit_rate").between(0, 1)
    rules["cost_saved_by_cache_negative"] = _negative("cost_saved_by_cache")
    return split(df, rules)


def validate_features(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    rules = {f"{name}_missing": _missing(name) for name in ["feature_name", "entity_id", "value", "feature_type"]}
    rules["feature_type_unknown"] = ~F.col("feature_type").isin(FEATURE_TYPES)
    return split(df, rules)


def apply_defaults(df: DataFrame, ingest_time=None) -> DataFrame:
    """Fill optional columns, adding those an older record does not have.

    session_id stays null, metadata becomes an empty object, timestamp the
    ingest time and version 1 (only where the table has a version).
    """
    now = F.current_timestamp() if ingest_time is None else F.lit(ingest_time)
    now = now.cast("timestamp_ntz")
    for name, default in [("session_id", F.lit(None).cast("string")),
                          ("metadata", F.lit("{}")), ("timestamp", now)]:
        df = df.withColumn(name, F.coalesce(name, default) if name in df.columns else default)
    if "version" in df.columns:
        df = df.withColumn("version", F.coalesce("version", F.lit(1)))
    return df


def validation_summary(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Long summary: rows valid and invalid, then rows per reason.

    One pass: every row yields its outcome and its reasons, which are counted.
    """
    marked = with_reasons(df, rules or interaction_rules())
    outcome = F.when(F.size(REASONS) == 0, F.lit("valid")).otherwise(F.lit("invalid"))
    labels = F.concat(
        F.array(F.struct(F.lit("outcome").alias("kind"), outcome.alias("name"))),
        F.transform(REASONS, lambda r: F.struct(F.lit("reason").alias("kind"), r.alias("name"))),
    )
    exploded = marked.select(F.explode(labels).alias("label")).select("label.*")
    return exploded.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("rows"))


def message_rules(corrupt: str = "_corrupt") -> dict[str, Column]:
    """The rules of interactions behind that of the text: a message that did not parse has no fields to check."""
    broken = F.col(corrupt).isNotNull() | F.col("value").isNull()
    return {"malformed_json": broken} | {name: ~broken & rule for name, rule in interaction_rules().items()}


def mark_messages(decoded: DataFrame, corrupt: str = "_corrupt") -> DataFrame:
    """Decoded messages with their reasons and their outcome: valid or dead.

    Text that is not JSON and rows that break a rule are dead; they keep the
    raw text, which a valid row no longer needs. Neither stops the load. One
    frame holds both sides, so that a stream or a table decodes a message once.
    """
    marked = with_reasons(decoded, message_rules(corrupt))
    dead = F.size(REASONS) > 0
    marked = marked.withColumn("value", F.when(dead, F.col("value"))).drop(corrupt)
    return marked.withColumn(OUTCOME, F.when(dead, "dead").otherwise("valid"))


def written_apart(marked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, the rest with reasons) of a frame with reasons, which is scanned and checked once.

    The frame is written by outcome, and each side reads its own folder.
    """
    if OUTCOME not in marked.columns:
        marked = marked.withColumn(OUTCOME, F.when(F.size(REASONS) > 0, "dead").otherwise("valid"))
    marked.write.partitionBy(OUTCOME).parquet(path)
    back = marked.sparkSession.read.schema(marked.schema).parquet(path)
    side = lambda name: back.where(F.col(OUTCOME) == name).drop(OUTCOME)
    return side("valid").drop(REASONS), side("dead")


def split_messages(decoded: DataFrame, corrupt: str = "_corrupt") -> tuple[DataFrame, DataFrame]:
    """Decoded messages -> (valid rows, dead letters with the raw text, where it came from, and the reasons)."""
    marked = mark_messages(decoded, corrupt)
    context = [c for c in ("value", "source_partition", "source_offset") if c in decoded.columns]
    valid = marked.where(F.col(OUTCOME) == "valid").drop(*context, REASONS, OUTCOME)
    return valid, marked.where(F.col(OUTCOME) == "dead").select(*context, REASONS)
