"""Cost, token and latency analytics over trailing day windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import scalars as S
from meterlake.functions.filters import date_range, entity_in, optional_user, trailing_days
from meterlake.functions.order_stats import distinct_counts, nearest_rank, running_counts

def _rows() -> Column:
    return F.count(F.lit(1))


def _zero(aggregate: Column) -> Column:
    return F.coalesce(aggregate, F.lit(0))


def cost_by_day(df: DataFrame, as_of, days: int = 30, user_id: str | None = None) -> DataFrame:
    """(date as text, total_cost), ascending. Days without rows are absent."""
    rows = optional_user(trailing_days(df, as_of, days), user_id)
    by_day = rows.groupBy("date").agg(F.sum("cost_usd").alias("total_cost")).orderBy("date")
    return by_day.select(F.col("date").cast("string").alias("date"), "total_cost")


def cost_by_model(df: DataFrame, as_of, days: int = 30) -> DataFrame:
    rows = trailing_days(df, as_of, days)
    totals = rows.groupBy("model").agg(F.sum("cost_usd").alias("total_cost"))
    return totals.orderBy(F.desc("total_cost"), "model")


def _token_aggregates() -> list[Column]:
    return [
        _zero(F.sum("total_tokens")).alias("total_tokens"),
        _zero(F.avg("total_tokens")).alias("avg_tokens_per_request"),
        _zero(F.sum("input_tokens")).alias("total_input_tokens"),
        _zero(F.sum("output_tokens")).alias("total_output_tokens"),
        _rows().alias("interaction_count"),
    ]


def token_stats(df: DataFrame, as_of, days: int = 30) -> DataFrame:
    """One row; all zero when nothing is in the window."""
    return trailing_days(df, as_of, days).agg(*_token_aggregates())


def top_users_by_cost(df: DataFrame, as_of, days: int = 30, limit: int = 10) -> DataFrame:
    totals = trailing_days(df, as_of, days).groupBy("user_id").agg(
        F.sum("cost_usd").alias("total_cost"),
        _rows().alias("interaction_count"),
        F.sum("total_tokens").alias("total_tokens"),
        F.avg("latency_ms").alias("avg_latency_ms"),
    )
    return totals.orderBy(F.desc("total_cost"), "user_id").limit(limit)


def offline_features(df: DataFrame, entity_ids=None, start=None, end=None) -> DataFrame:
    """Per entity totals over an inclusive date range, for training."""
    rows = entity_in(date_range(df, start, end), entity_ids)
    return rows.groupBy(F.col("user_id").alias("entity_id")).agg(
        _rows().alias("interaction_count"),
        F.sum("cost_usd").alias("total_cost"),
        F.sum("total_tokens").alias("total_tokens"),
        F.avg("latency_ms").alias("avg_latency"),
        F.min("timestamp").alias("first_interaction"),
        F.max("timestamp").alias("last_interaction"),
    )


def _with_total_row(rows: DataFrame, key: str, sums: dict[str, Column]) -> DataFrame:
    """(overall, key, sums): one row per key value and one for everything, which is
    zero when there are no rows. The rows are read once; the second, tiny
    aggregation only makes sure of the total row."""
    level = rows.groupingSets([[F.col(key)], []], F.col(key)).agg(
        (F.grouping(key) == 1).alias("overall"), *[c.alias(name) for name, c in sums.items()]
    )
    zero = rows.sparkSession.sql("SELECT true AS overall").select(
        "overall", F.lit(None).cast("string").alias(key), *[F.lit(0).alias(name) for name in sums]
    )
    return level.unionByName(zero).groupBy("overall", key).agg(*[F.sum(n).alias(n) for n in sums])


def cost_summary(df: DataFrame, as_of, days: int = 30, top: int = 10) -> DataFrame:
    """Total, by model, token figures and top users as (section, key, metric, value).

    Grouping sets read the rows once for the totals and the models together;
    the users are a second pass that ends in a top-k, not a sort.
    """
    rows = trailing_days(df, as_of, days).select(
        "model", "cost_usd", "input_tokens", "output_tokens", "total_tokens"
    )
    sums = {"total_cost": "cost_usd", "total_tokens": "total_tokens",
            "total_input_tokens": "input_tokens", "total_output_tokens": "output_tokens"}
    level = _with_total_row(
        rows, "model", {**{name: F.sum(c) for name, c in sums.items()}, "interaction_count": _rows()}
    ).withColumn("avg_tokens_per_request", S.safe_ratio("total_tokens", "interaction_count"))
    token_metrics = ["total_tokens", "avg_tokens_per_request", "total_input_tokens",
                     "total_output_tokens", "interaction_count"]

    def entry(section: str, key: Column, metric: str, value: str) -> Column:
        return F.struct(
            F.lit(section).alias("section"), key.alias("key"),
            F.lit(metric).alias("metric"), F.col(value).cast("double").alias("value"),
        )

    everything = F.lit("all")
    overall = F.array(
        entry("total_cost", everything, "total_cost", "total_cost"),
        *[entry("token_stats", everything, m, m) for m in token_metrics],
    )
    model = F.array(entry("cost_by_model", F.col("model"), "total_cost", "total_cost"))
    head = level.select(F.inline(F.when(F.col("overall"), overall).otherwise(model)))
    user_metrics = ["total_cost", "interaction_count", "total_tokens", "avg_latency_ms"]
    users = top_users_by_cost(df, as_of, days, top).select(
        F.inline(F.array(*[entry("top_users", F.col("user_id"), m, m) for m in user_metrics]))
    )
    return head.unionByName(users)


def cost_summary_record(df: DataFrame, start=None, end=None, cache_log: DataFrame | None = None) -> DataFrame:
    """One row of totals for a period, with the derived averages.

    cache_log (one row per lookup, with cache_hit) gives the hit rate and the
    cost saved by the cache; without it both are null.
    """
    rows = date_range(df, start, end)
    totals = rows.agg(
        F.min("timestamp").alias("period_start"),
        F.max("timestamp").alias("period_end"),
        _zero(F.sum("cost_usd")).cast("double").alias("total_cost_usd"),
        _zero(F.sum("total_tokens")).alias("total_tokens"),
        _rows().alias("total_interactions"),
    )
    totals = totals.withColumns({
        "avg_cost_per_interaction": S.safe_ratio("total_cost_usd", "total_interactions"),
        "avg_tokens_per_interaction": S.safe_ratio("total_tokens", "total_interactions"),
    })
    nothing = F.lit(None).cast("double")
    if cache_log is None:
        return totals.withColumns({"cache_hit_rate": nothing, "cost_saved_by_cache": nothing})
    hits = cache_hit_rate(cache_log)
    return totals.withColumns({
        "cache_hit_rate": hits.select("cache_hit_rate").scalar(),
        "cost_saved_by_cache": hits.select("cost_saved_usd").scalar(),
    })


def cost_breakdown(df: DataFrame, start=None, end=None) -> DataFrame:
    """The per-model and per-user maps of the record as (dimension, key, total_cost).

    Long rows instead of maps: the number of users has no bound, so it must not
    become one value of one row.
    """
    rows = date_range(df, start, end).select("model", "user_id", "cost_usd")
    grouped = rows.groupingSets(
        [[F.col("model")], [F.col("user_id")]], F.col("model"), F.col("user_id")
    ).agg(F.grouping("model").alias("by_user"), F.sum("cost_usd").alias("total_cost"))
    is_user = F.col("by_user") == 1
    return grouped.select(
        F.when(is_user, F.lit("user")).otherwise(F.lit("model")).alias("dimension"),
        F.when(is_user, F.col("user_id")).otherwise(F.col("model")).alias("key"),
        "total_cost",
    )


def count_by_model(df: DataFrame) -> DataFrame:
    return df.groupBy("model").agg(_rows().alias("count"))


def distinct_dates(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("date").alias("distinct_dates"))


def avg_latency_by_model(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    return trailing_days(df, as_of, days).groupBy("model").agg(F.avg("latency_ms").alias("avg_latency"))


def interaction_stats(df: DataFrame) -> DataFrame:
    """(provider, figures); the row with provider 'all' is the total."""
    level = _with_total_row(df, "provider", {
        "total_interactions": _rows(),
        "total_tokens": F.sum("total_tokens"),
        "total_cost": F.sum("cost_usd"),
        "latency": F.sum("latency_ms"),
    })
    name = F.when(F.col("overall"), F.lit("all")).otherwise(F.col("provider"))
    return level.select(
        name.alias("provider"), "total_interactions", "total_tokens", "total_cost",
        S.safe_ratio("latency", "total_interactions").alias("avg_latency_ms"),
    )


def monthly_cost_report(df: DataFrame) -> DataFrame:
    """(month, model, total_cost); model 'all' is the month."""
    months = df.select(F.date_format("date", "yyyy-MM").alias("month"), "model", "cost_usd")
    grouped = months.groupingSets(
        [[F.col("month"), F.col("model")], [F.col("month")]], F.col("month"), F.col("model")
    ).agg(F.grouping("model").alias("whole"), F.sum("cost_usd").alias("total_cost"))
    name = F.when(F.col("whole") == 1, F.lit("all")).otherwise(F.col("model"))
    return grouped.select("month", name.alias("model"), "total_cost")


def cost_metrics(df: DataFrame, operation: str = "event_type", cache_hit: Column | None = None) -> DataFrame:
    """Cost-metric events of interactions (operation, tokens, cost, cache hit)."""
    hit = F.lit(False) if cache_hit is None else cache_hit
    return df.select(
        "timestamp", "date", F.col(operation).alias("operation"), "model", "user_id", "input_tokens",
        "output_tokens", "total_tokens", "cost_usd", "latency_ms", hit.alias("cache_hit"),
    )


def cost_metric_rollup(metrics: DataFrame, daily_budget: float) -> DataFrame:
    """Per day, operation and model: cost, calls, hit rate, savings; with the
    cost of the whole day and whether that is over the budget.

    The day total is a second small aggregate joined back, so no window has to
    gather a day.
    """
    day = F.to_date("timestamp")
    grouped = metrics.groupBy(day.alias("date"), "operation", "model").agg(
        _rows().alias("requests"),
        F.sum("cost_usd").alias("total_cost"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum(F.col("cache_hit").cast("int")).alias("cache_hits"),
    )
    days = grouped.groupBy("date").agg(F.sum("total_cost").alias("day_cost"))
    return grouped.join(days, "date").withColumns({
        "cache_hit_rate": S.safe_ratio("cache_hits", "requests"),
        "cost_saved_usd": F.col("cache_hits") * S.COST_SAVED_PER_HIT,
        "over_budget": F.col("day_cost") > daily_budget,
    })


def cost_metric_by_user(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("user_id").agg(
        _rows().alias("requests"), F.sum("cost_usd").alias("total_cost")
    )


def cache_hit_rate(lookups: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Hits, misses and hits / lookups (0.0 when there is none), with the cost saved."""
    grouped = lookups.groupBy(*keys) if keys else lookups
    hit = F.col("cache_hit")
    counted = grouped.agg(
        F.count_if(hit).alias("cache_hits"),
        F.count_if(~hit).alias("cache_misses"),
    )
    return counted.withColumns({
        "cache_hit_rate": S.safe_ratio("cache_hits", F.col("cache_hits") + F.col("cache_misses")),
        "cost_saved_usd": F.col("cache_hits") * S.COST_SAVED_PER_HIT,
    })


def latency_percentiles(
    df: DataFrame, keys=("operation",), value: str = "duration_ms", quantiles=(0.5, 0.95, 0.99), **options
) -> DataFrame:
    """Exact p50, p95, p99 by index int(n * q) of the sorted values, with mean, min and max.

    Values are collapsed and ranked in blocks, so one operation may hold most
    of the rows.
    """
    keys = list(keys)
    collapsed = distinct_counts(df, keys, value, n=F.lit(1))
    ranked = running_counts(collapsed, keys, value, ["n"], **options)
    names = [f"p{round(q * 100)}" for q in quantiles]
    grouped = ranked.groupBy(*keys) if keys else ranked
    return grouped.agg(
        *[F.expr(nearest_rank(value, "cum_n", "all_n", q)).alias(n) for n, q in zip(names, quantiles)],
        (F.sum(F.col(value) * F.col("n")) / F.sum("n")).alias("avg"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.sum("n").alias("count"),
    )


def latency_percentiles_approx(
    df: DataFrame, keys=("operation",), value: str = "duration_ms", quantiles=(0.5, 0.95, 0.99), accuracy: int = 10_000
) -> DataFrame:
    """The same figures in one pass with a bounded sketch per group."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(value, q, accuracy).alias(f"p{round(q * 100)}") for q in quantiles],
        F.avg(value).alias("avg"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.count(value).alias("count"),
    )


def tier_consistency(online: DataFrame, facts: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Online totals next to fact totals per user; consistent is true where they agree."""
    totals = facts.groupBy("user_id").agg(
        _rows().alias("fact_count"),
        F.sum("total_tokens").alias("fact_tokens"),
        F.sum("cost_usd").alias("fact_cost"),
    )
    hot = online.select(
        "user_id",
        F.col("interaction_count").alias("online_count"),
        F.col("total_tokens").alias("online_tokens"),
        F.col("total_cost").alias("online_cost"),
    )
    same = (
        F.col("online_count").eqNullSafe(F.col("fact_count"))
        & F.col("online_tokens").eqNullSafe(F.col("fact_tokens"))
        & (F.abs(F.col("online_cost") - F.col("fact_cost")) <= tolerance)
    )
    joined = hot.join(totals, "user_id", "full_outer")
    return joined.withColumn("consistent", F.coalesce(same, F.lit(False)))


def session_rollup(df: DataFrame) -> DataFrame:
    """Calls grouped by session; rows without a session are left out."""
    return df.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        _rows().alias("interaction_count"),
        F.sum("cost_usd").alias("total_cost"),
        F.sum("total_tokens").alias("total_tokens"),
        F.min("timestamp").alias("first_interaction"),
        F.max("timestamp").alias("last_interaction"),
    )
