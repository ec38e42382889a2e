"""Operational metrics over event-time windows, for batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import scalars as S
from meterlake.functions.order_stats import distinct_counts, running_counts, value_at_rank
from meterlake.schemas import COST_SAVED_PER_HIT, FEATURE_TTL_SECONDS

FIVE_MINUTES, ONE_MINUTE, ONE_HOUR, ONE_DAY = "5 minutes", "1 minute", "1 hour", "24 hours"
WINDOW_SECONDS = 300


EVENT_TIME = "event_time"


def with_event_time(stream: DataFrame, delay: str) -> DataFrame:
    """Add the watermark column. A watermark needs a time with zone; the session
    zone has to be UTC, as everywhere here, so that the cast keeps the clock."""
    return stream.withColumn(EVENT_TIME, F.col("timestamp").cast("timestamp")).withWatermark(EVENT_TIME, delay)


def _time(df: DataFrame) -> str:
    return EVENT_TIME if EVENT_TIME in df.columns else "timestamp"


def _edge(name: str) -> Column:
    return F.col(f"w.{name}").cast("timestamp_ntz").alias(f"window_{name}")


def windowed_sums(
    df: DataFrame, sums: dict[str, Column], width: str, slide: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Sums per window (window_start, window_end) and group.

    A batch frame is first added up per slide, and the few slide totals are
    then spread over the windows that cover them; rows are never multiplied.
    A stream aggregates the windows directly, which keeps one stateful step.
    The width has to be a multiple of the slide.
    """
    time = _time(df)
    if slide and not df.isStreaming:
        panes = df.groupBy(F.window(time, slide).alias("pane"), *by).agg(
            *[F.sum(c).alias(name) for name, c in sums.items()]
        )
        panes = panes.withColumn("_at", F.col("pane.start"))
        grouped = panes.groupBy(F.window("_at", width, slide).alias("w"), *by).agg(
            *[F.sum(name).alias(name) for name in sums]
        )
    else:
        grouped = df.groupBy(F.window(time, width, slide).alias("w"), *by).agg(
            *[F.sum(c).alias(name) for name, c in sums.items()]
        )
    return grouped.select(
        _edge("start"), _edge("end"), *by, *sums
    )


def interactions_per_second(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    counts = windowed_sums(df, {"calls": F.lit(1)}, FIVE_MINUTES, ONE_MINUTE, by)
    return counts.withColumn("per_second", F.col("calls") / WINDOW_SECONDS)


def interactions_per_second_by_model(df: DataFrame) -> DataFrame:
    return interactions_per_second(df, ["model"])


def ratio_band(ratio="hit_ratio", low: float = 0.8, high: float = 0.95) -> Column:
    value = F.col(ratio) if isinstance(ratio, str) else ratio
    return F.when(value < low, "red").when(value < high, "yellow").otherwise("green")


def cache_hit_ratio(df: DataFrame) -> DataFrame:
    hit = F.col("cache_hit").cast("int")
    counts = windowed_sums(df, {"hits": hit, "lookups": F.lit(1)}, FIVE_MINUTES, ONE_MINUTE)
    return counts.withColumn("hit_ratio", S.safe_ratio("hits", "lookups")).withColumn("band", ratio_band())


def latency_p95_p99(df: DataFrame, by: str = "operation", value: str = "latency_ms", **options) -> DataFrame:
    """Exact p95 and p99 (the smallest value with that share of the calls at or below it) per 5-minute window.

    For batch frames. Values are counted per slide first; only distinct values are
    spread over the windows and ranked in blocks.
    """
    named = df.select(F.window(_time(df), ONE_MINUTE)["start"].alias("_at"), F.col(by).alias(by), F.col(value).cast("double").alias(value))
    panes = distinct_counts(named, ["_at", by], value, n=F.lit(1))
    spread = panes.groupBy(F.window("_at", FIVE_MINUTES, ONE_MINUTE).alias("w"), by, value).agg(F.sum("n").alias("n"))
    ranked = running_counts(spread, ["w", by], value, ["n"], **options)
    grouped = ranked.groupBy("w", by).agg(
        *[F.expr(value_at_rank(value, "cum_n", f"(ceil(all_n * {q}BD) - 1)")).alias(name) for name, q in (("p95", 0.95), ("p99", 0.99))],
        F.sum("n").alias("calls"),
    )
    return grouped.select(_edge("start"), _edge("end"), by, "p95", "p99", "calls")


def latency_p95_p99_sketch(
    df: DataFrame, by: str = "operation", value: str = "latency_ms", accuracy: int = 10_000
) -> DataFrame:
    """p95 and p99 per 5-minute window and operation, from a bounded sketch per group; for streams too.

    A group with no more distinct values than the accuracy gets values of its
    own rows at the exact rank.
    """
    grouped = df.groupBy(F.window(_time(df), FIVE_MINUTES, ONE_MINUTE).alias("w"), by).agg(
        F.percentile_approx(value, F.array(F.lit(0.95), F.lit(0.99)), accuracy).alias("p"),
        F.count(value).alias("calls"),
    )
    return grouped.select(
        _edge("start"), _edge("end"), by,
        F.col("p")[0].alias("p95"), F.col("p")[1].alias("p99"), "calls",
    )


# Size of the sketches: the rank of a result is off by more than KLL_ERROR in one case of a hundred.
KLL_SIZE = 800
KLL_ERROR = 2.296 / KLL_SIZE**0.9723


def latency_p95_p99_panes(
    df: DataFrame, by: str = "operation", value: str = "latency_ms", size: int = KLL_SIZE
) -> DataFrame:
    """p95 and p99 per 5-minute window, from mergeable sketches of one-minute panes; for streams too.

    A call is sketched once, whatever the number of windows over it, and five
    sketches of a bounded size are merged per window. A group of fewer values
    than the sketch's size gets the exact values.
    """
    panes = df.groupBy(F.window(_time(df), ONE_MINUTE).alias("pane"), by).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch"), F.count(value).alias("calls"))
    merged = panes.groupBy(F.window("pane", FIVE_MINUTES, ONE_MINUTE).alias("w"), by).agg(
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"), F.sum("calls").alias("calls"))
    at = lambda q: F.kll_sketch_get_quantile_double("sketch", F.lit(q))
    return merged.where("calls > 0").select(_edge("start"), _edge("end"), by, at(0.95).alias("p95"), at(0.99).alias("p99"), "calls")


def cost_24h(df: DataFrame) -> DataFrame:
    return windowed_sums(df, {"total_cost": F.col("cost_usd")}, ONE_DAY, ONE_HOUR)


def cost_1h_by_model(df: DataFrame) -> DataFrame:
    return windowed_sums(df, {"total_cost": F.col("cost_usd")}, ONE_HOUR, None, ["model"])


def tokens_per_second_by_model(df: DataFrame) -> DataFrame:
    tokens = windowed_sums(df, {"tokens": F.col("total_tokens")}, FIVE_MINUTES, ONE_MINUTE, ["model"])
    return tokens.withColumn("per_second", F.col("tokens") / WINDOW_SECONDS)


def drift_score_total(results: DataFrame) -> DataFrame:
    """Sum of the drift scores with its band (0.1 and 0.2)."""
    total = results.agg(F.coalesce(F.sum("drift_score"), F.lit(0.0)).alias("drift_score_total"))
    score = F.col("drift_score_total")
    return total.withColumn(
        "band", F.when(score < 0.1, "green").when(score < 0.2, "yellow").otherwise("red")
    )


def cache_savings_1h(df: DataFrame) -> DataFrame:
    """Cost saved by the cache next to the cost, per hour."""
    saved = F.col("cache_hit").cast("int")
    hours = windowed_sums(df, {"hits": saved, "total_cost": F.col("cost_usd")}, ONE_HOUR)
    return hours.withColumn("cost_saved_usd", F.col("hits") * COST_SAVED_PER_HIT)


def sessionized_online_features(df: DataFrame, gap_seconds: int = FEATURE_TTL_SECONDS) -> DataFrame:
    """Per-user totals that restart after a gap, as a session window.

    A session window still merges an event exactly one gap after the last one,
    whose totals have expired by then; a gap one microsecond shorter splits
    there. Sessions are merged per task before the exchange when
    spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition is on.
    """
    session = F.session_window(_time(df), f"{gap_seconds * 1_000_000 - 1} microseconds")
    grouped = df.groupBy("user_id", session.alias("s")).agg(
        F.sum("cost_usd").alias("total_cost"),
        F.sum("total_tokens").alias("total_tokens"),
        F.count(F.lit(1)).alias("interaction_count"),
        F.max(F.struct("timestamp", "interaction_id", "model")).alias("last"),
    )
    return grouped.select(
        "user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
        "total_cost", "total_tokens", "interaction_count",
        F.col("last.model").alias("last_model"),
        F.col("last.timestamp").alias("last_interaction_time"),
        (F.col("last.timestamp") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("expires_at"),
    )
