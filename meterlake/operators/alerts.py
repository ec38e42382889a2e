"""Alert rules. Each returns alert rows (rule, subject, at, value, threshold)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import scalars as S
from meterlake.functions.filters import as_date
from meterlake.streaming.windows import (
    FIVE_MINUTES,
    ONE_MINUTE,
    cache_hit_ratio,
    latency_p95_p99,
    windowed_sums,
)

MONTHLY_BUDGET_USD = 50.0
BUDGET_LEVELS = (0.8, 1.0)


def _alerts(df: DataFrame, rule: str, subject, at, value: str, threshold) -> DataFrame:
    column = lambda c: c if isinstance(c, Column) else F.col(c)
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.select(
        F.lit(rule).alias("rule"),
        column(subject).alias("subject"),
        column(at).cast("string").alias("at"),
        F.col(value).cast("double").alias("value"),
        limit.alias("threshold"),
    )


def _daily_cost(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.sum("cost_usd").alias("total_cost"))


def error_rate(df: DataFrame, limit: float = 0.01, error: str = "is_error") -> DataFrame:
    counts = windowed_sums(
        df, {"errors": F.col(error).cast("int"), "calls": F.lit(1)}, FIVE_MINUTES, ONE_MINUTE
    )
    rates = counts.withColumn("rate", S.safe_ratio("errors", "calls")).where(F.col("rate") > limit)
    return _alerts(rates, "error_rate", F.lit("all"), "window_start", "rate", limit)


def latency_p99(df: DataFrame, limit_ms: float = 500.0, by: str = "operation") -> DataFrame:
    slow = latency_p95_p99(df, by).where(F.col("p99") > limit_ms)
    return _alerts(slow, "latency_p99", by, "window_start", "p99", limit_ms)


def cost_spike(df: DataFrame, rise: float = 0.2) -> DataFrame:
    """Days whose cost is more than rise above the calendar day before.

    The day totals are shifted and joined on the date, so a missing day is not
    skipped over.
    """
    days = _daily_cost(df)
    before = days.select(F.date_add("date", 1).alias("date"), F.col("total_cost").alias("previous"))
    change = days.join(before, "date").where(F.col("previous") > 0).withColumn(
        "change", F.col("total_cost") / F.col("previous") - 1
    )
    return _alerts(change.where(F.col("change") > rise), "cost_spike", F.lit("all"), "date", "change", rise)


def hit_rate(df: DataFrame, limit: float = 0.8) -> DataFrame:
    low = cache_hit_ratio(df).where(F.col("hit_ratio") < limit)
    return _alerts(low, "hit_rate", F.lit("all"), "window_start", "hit_ratio", limit)


def drift(results: DataFrame, limit: float = 0.2) -> DataFrame:
    bad = results.where(F.col("drift_score") > limit)
    subject = F.concat_ws(":", "feature_name", "entity_id")
    return _alerts(bad, "drift", subject, "window_end", "drift_score", limit)


def budget(
    df: DataFrame, monthly_budget: float = MONTHLY_BUDGET_USD, levels=BUDGET_LEVELS
) -> DataFrame:
    """The first day of each month on which its spend reaches each level of the budget.

    The running sum is over the day totals of one month, 31 rows at most.
    """
    days = _daily_cost(df).withColumn("month", F.date_format("date", "yyyy-MM"))
    w = Window.partitionBy("month").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    spent = days.withColumn("spent", F.sum("total_cost").over(w))
    limits = F.explode(F.array(*[F.lit(monthly_budget * level) for level in levels]))
    crossed = spent.withColumn("limit", limits).where(F.col("spent") >= F.col("limit"))
    first = crossed.groupBy("month", "limit").agg(
        F.min(F.struct("date", "spent")).alias("first")
    ).select("month", "limit", "first.date", "first.spent")
    return _alerts(first, "budget", "month", "date", "spent", F.col("limit"))


def daily_cost(df: DataFrame, limit_usd: float = 10.0) -> DataFrame:
    over = _daily_cost(df).where(F.col("total_cost") > limit_usd)
    return _alerts(over, "daily_cost", F.lit("all"), "date", "total_cost", limit_usd)


def month_to_date(df: DataFrame, as_of) -> DataFrame:
    """Spend of the month of as_of, up to and including that day."""
    day = as_date(as_of)
    rows = df.where((F.col("date") >= F.trunc(day, "month")) & (F.col("date") <= day))
    return rows.agg(F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("total_cost"))
