"""Distribution drift for many features in one job.

Input is a long frame (feature_name, entity_id, side, value) whose side is
'historical' or 'current'. Values are collapsed to counts per distinct value
once; the percentiles, both distribution functions, the means and the
deviations are all read from those counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions import scalars as S
from meterlake.functions.filters import as_date, check_lookback
from meterlake.functions.keyed import null_safe_join
from meterlake.functions.order_stats import distinct_counts, interpolate, linear_percentile, running_counts
from meterlake.schemas import DRIFT_THRESHOLD, DRIFT_WINDOW_DAYS, PSI_BINS, PSI_EMPTY_SHARE

KEY = ["feature_name", "entity_id"]
HISTORICAL, CURRENT = "historical", "current"


def _collapse(samples: DataFrame) -> DataFrame:
    return distinct_counts(
        samples, KEY, "value",
        hist=(F.col("side") == HISTORICAL), cur=(F.col("side") == CURRENT),
    )


def _inner_edges() -> list[float]:
    # The percentages as a linear grid over 0..100, as fractions of 100.
    return [100.0 / PSI_BINS * i / 100.0 for i in range(1, PSI_BINS)]


_BOTH_SIDES = "all_hist > 0 AND all_cur > 0"
_CDF_GAP = "max(abs(cum_hist / all_hist - cum_cur / all_cur))"


_STEP = f"{2.0**62}D"
# A double as three whole numbers, in units of 1, 2^-62 and 2^-124; exact from 2^-72 to 2^62.
_WHOLE = "rint(value)"
_MIDDLE = f"(value - {_WHOLE}) * {_STEP}"
_SMALL = f"({_MIDDLE} - rint({_MIDDLE})) * {_STEP}"


def _mean(counts: str) -> str:
    """Aggregate: the mean of the counted values, the same whatever the order they are added in.

    A sum of doubles follows the order in which tasks finish. Here the parts of
    the values are added as whole numbers; beyond the range of these it is the sum of doubles.
    """
    fits = f"bool_and(abs(value) < {_STEP} AND {_SMALL} = rint({_SMALL}) AND {counts} < 10000000000)"
    sums = [
        f"CAST(try_sum(CASE WHEN abs({part}) < {_STEP} THEN CAST(rint({part}) AS DECIMAL(19, 0)) END * try_cast({counts} AS DECIMAL(10, 0))) AS DOUBLE)"
        for part in (_WHOLE, _MIDDLE, _SMALL)
    ]
    exact = f"CASE WHEN {fits} THEN {sums[0]} + ({sums[1]} + {sums[2]} / {_STEP}) / {_STEP} END"
    return f"coalesce({exact}, sum(value * {counts})) / sum({counts})"


def _group_statistics(ranked: DataFrame) -> DataFrame:
    """Per key: sizes, means, KS distance, and the inner PSI edges e1..e9."""
    neighbours, edges = [], []
    for i, q in enumerate(_inner_edges(), start=1):
        low, high = linear_percentile("value", "cum_hist", "all_hist", q)
        neighbours += [f"{low} AS low{i}", f"{high} AS high{i}"]
        edges.append(interpolate(f"low{i}", f"high{i}", "n_hist", q) + f" AS e{i}")
    grouped = ranked.where(_BOTH_SIDES).groupBy(*KEY).agg(*map(F.expr, [
        "max(all_hist) AS n_hist",
        "max(all_cur) AS n_cur",
        f"{_mean('hist')} AS mean_hist",
        f"{_mean('cur')} AS mean_cur",
        f"{_CDF_GAP} AS ks_statistic",
        *neighbours,
    ]))
    return grouped.selectExpr(*KEY, "n_hist", "n_cur", "mean_hist", "mean_cur", "ks_statistic", *edges)


def _psi_score() -> str:
    """Sum of (a - e) * ln(a / e) over the bins; an empty bin has a small share."""
    def share(count: str, total: str) -> str:
        return f"(CASE WHEN {count} = 0 THEN {PSI_EMPTY_SHARE}D ELSE {count} / {total} END)"

    terms = []
    for b in range(PSI_BINS):
        expected, actual = share(f"hist{b}", "n_hist"), share(f"cur{b}", "n_cur")
        terms.append(f"({actual} - {expected}) * ln({actual} / {expected})")
    return " + ".join(terms)


def drift_statistics(samples: DataFrame, **options) -> DataFrame:
    """Per (feature, entity) with both samples: sizes, PSI, KS distance, means, deviations."""
    return statistics_of_counts(_collapse(samples), **options)


def statistics_of_counts(collapsed: DataFrame, **options) -> DataFrame:
    """drift_statistics of samples that are collapsed to KEY, value, hist, cur.

    The second pass joins the one row per key back to the distinct values; a
    key with very many of them is split there.
    """
    stats = _group_statistics(running_counts(collapsed, KEY, "value", ["hist", "cur"], **options))
    bin_no = " + ".join(f"CAST(value >= e{i} AS INT)" for i in range(1, PSI_BINS))
    placed = null_safe_join(collapsed, stats, KEY, "inner").selectExpr("*", f"{bin_no} AS bin")
    carried = ["n_hist", "n_cur", "mean_hist", "mean_cur", "ks_statistic"]
    grouped = placed.groupBy(*KEY).agg(*map(F.expr, [
        *[f"max({c}) AS {c}" for c in carried],
        *[f"sqrt(sum(pow(value - mean_{s}, 2) * {s}) / sum({s})) AS std_{s}" for s in ("hist", "cur")],
        *[
            f"sum(CASE WHEN bin = {b} THEN {s} ELSE 0 END) AS {s}{b}"
            for b in range(PSI_BINS) for s in ("hist", "cur")
        ],
    ]))
    return grouped.selectExpr(*KEY, *carried, "std_hist", "std_cur", f"{_psi_score()} AS psi")


def psi(samples: DataFrame, **options) -> DataFrame:
    return drift_statistics(samples, **options).select(*KEY, "psi")


def ks_statistic(samples: DataFrame, **options) -> DataFrame:
    """Largest distance of the two empirical distribution functions per key."""
    ranked = running_counts(_collapse(samples), KEY, "value", ["hist", "cur"], **options)
    return ranked.where(_BOTH_SIDES).groupBy(*KEY).agg(
        F.expr(_CDF_GAP).alias("ks_statistic"),
        F.max("all_hist").alias("n_hist"),
        F.max("all_cur").alias("n_cur"),
    )


def ks_pvalue_asymptotic(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sided Kolmogorov tail 2 * sum (-1)^(j-1) exp(-2 j^2 x^2), x = sqrt(n1 n2/(n1+n2)) d.

    The series converges badly near 0, where the tail is 1 to 15 digits.
    """
    # As doubles: the product of two large counts leaves the range of a long.
    size = n1.cast("double") * n2 / (n1 + n2)
    x2 = size * d * d
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda j: F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * x2),
    )
    series = 2.0 * F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    return F.when(x2 < 0.03, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def exact_ks_pvalue(d: float, n1: int, n2: int) -> float:
    """P(D >= d) for two samples of n1 and n2 values without ties.

    Every order of the pooled sample is a lattice path from (0, 0) to (n1, n2).
    The probability of having touched |i/n1 - j/n2| >= d is carried forward
    along the diagonals i + j = k, over the band of points inside only; a point
    outside has 1.
    """
    bound, both = round(d * n1 * n2) - 0.5, n1 + n2
    if bound <= 0:
        return 1.0
    previous, low = np.zeros(1), 0
    for k in range(1, both + 1):
        # Inside: |i n2 - (k - i) n1| = |i (n1 + n2) - k n1| < bound.
        new_low = max(0, k - n2, math.floor((k * n1 - bound) / both) + 1)
        new_high = min(n1, k, math.ceil((k * n1 + bound) / both) - 1)
        if new_low > new_high:
            return 1.0
        i = np.arange(new_low, new_high + 1)
        padded = np.concatenate([[1.0], previous, [1.0]])
        # Paths come from (i - 1, j) and from (i, j - 1); off the lattice the weight is 0.
        from_i = padded[np.clip(i - low, 0, len(padded) - 1)]
        from_j = padded[np.clip(i - low + 1, 0, len(padded) - 1)]
        previous, low = (from_i * i + from_j * (k - i)) / k, new_low
    return float(min(1.0, previous[0]))


def _exact_pvalues(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    values = [
        exact_ks_pvalue(float(x), int(a), int(b))
        for x, a, b in zip(d, n1, n2)
    ]
    return pd.Series(values)


def with_pvalue(stats: DataFrame, exact: bool = False) -> DataFrame:
    """Add ks_pvalue and ks_method: the limit series, or the exact value where it is asked for.

    The method never follows the sample sizes. The exact recursion takes
    up to n_hist * n_cur steps for a result row, so it is for small samples; the
    limit series differs from it by less than 0.01 from 50 values a side on.
    """
    d, n1, n2 = F.col("ks_statistic"), F.col("n_hist"), F.col("n_cur")
    series = ks_pvalue_asymptotic(d, n1, n2)
    if not exact:
        return stats.withColumns({"ks_pvalue": series, "ks_method": F.lit("asymptotic")})
    exact_pvalue = F.pandas_udf(_exact_pvalues, "double")
    return stats.withColumns({"ks_pvalue": exact_pvalue(d, n1, n2), "ks_method": F.lit("exact")})


def sample_stats(samples: DataFrame) -> DataFrame:
    """Mean and population deviation of both samples, straight from the rows."""
    def of(side: str) -> Column:
        return F.when(F.col("side") == side, F.col("value"))

    return samples.groupBy(*KEY).agg(
        F.avg(of(HISTORICAL)).alias("historical_mean"),
        F.avg(of(CURRENT)).alias("current_mean"),
        F.stddev_pop(of(HISTORICAL)).alias("historical_std"),
        F.stddev_pop(of(CURRENT)).alias("current_std"),
    )


def drift_status(score="psi", threshold: float = DRIFT_THRESHOLD) -> Column:
    value = F.col(score) if isinstance(score, str) else score
    return (
        F.when(value > threshold * 2, "critical").when(value > threshold, "warning").otherwise("no_drift")
    )


def check_drift(
    samples: DataFrame, as_of, threshold: float = DRIFT_THRESHOLD, days: int = DRIFT_WINDOW_DAYS,
    exact: bool = False, **options,
) -> DataFrame:
    """One drift row per (feature, entity).

    A key that has only one of the two samples gets score 0, no_drift and the
    method 'insufficient data'. The KS figures are details; the status follows
    the PSI alone.
    """
    check_lookback(days)
    stats = drift_statistics(samples, **options)
    return _drift_rows(samples.select(*KEY).distinct(), stats, as_of, threshold, days, exact)


def _drift_rows(keys: DataFrame, stats: DataFrame, as_of, threshold: float, days: int, exact: bool) -> DataFrame:
    stats = with_pvalue(stats, exact)
    joined = null_safe_join(keys, stats, KEY, "left")
    score = F.coalesce("psi", F.lit(0.0))
    known = F.col("psi").isNotNull()
    end = F.lit(as_of).cast("timestamp_ntz")
    text = lambda c: F.col(c).cast("string")
    details = F.when(known, F.create_map(
        F.lit("psi"), text("psi"), F.lit("ks_statistic"), text("ks_statistic"),
        F.lit("ks_pvalue"), text("ks_pvalue"), F.lit("ks_method"), F.col("ks_method"),
        F.lit("method"), F.lit("PSI + KS Test"),
    )).otherwise(F.create_map(F.lit("method"), F.lit("insufficient data")))
    result = joined.select(
        *KEY,
        drift_status(score, threshold).alias("drift_status"),
        score.alias("drift_score"),
        F.lit(threshold).alias("threshold"),
        F.col("mean_hist").alias("historical_mean"),
        F.col("mean_cur").alias("current_mean"),
        F.col("std_hist").alias("historical_std"),
        F.col("std_cur").alias("current_std"),
        (end - F.make_dt_interval(days=F.lit(days))).alias("window_start"),
        end.alias("window_end"),
        details.alias("details"),
        "ks_statistic", "ks_pvalue",
    )
    return result.withColumns({
        "drift_detected": S.drift_detected(),
        "mean_change_percent": S.mean_change_percent(),
    })


def samples_from_features(features: DataFrame, as_of, current_days: int = DRIFT_WINDOW_DAYS) -> DataFrame:
    """Split stored feature values at as_of - current_days. Text that is not a
    finite number is left out; unparsed_values counts it."""
    check_lookback(current_days)
    side = F.when(F.col("date") >= F.date_sub(as_date(as_of), current_days), CURRENT).otherwise(HISTORICAL)
    rows = features.select(*KEY, side.alias("side"), S.parse_numeric("value").alias("value"))
    return rows.where(F.col("value").isNotNull())


def unparsed_values(features: DataFrame) -> DataFrame:
    bad = F.col("value").isNotNull() & S.parse_numeric("value").isNull()
    return features.groupBy("feature_name").agg(F.count_if(bad).alias("unparsed"))


def samples_from_columns(
    df: DataFrame, columns, as_of, current_days: int = DRIFT_WINDOW_DAYS, entity: str | None = None
) -> DataFrame:
    """Samples of fact columns, for all rows together ('all') or per entity column."""
    check_lookback(current_days)
    side = F.when(F.col("date") >= F.date_sub(as_date(as_of), current_days), CURRENT).otherwise(HISTORICAL)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature_name"), F.col(c).cast("double").alias("value")) for c in columns
    ])
    who = F.col(entity).cast("string") if entity else F.lit("all")
    return df.select(who.alias("entity_id"), side.alias("side"), F.inline(pairs)).select(*KEY, "side", "value")


def drift_from_history(features: DataFrame, as_of, current_days: int = DRIFT_WINDOW_DAYS, **options) -> DataFrame:
    return check_drift(samples_from_features(features, as_of, current_days), as_of, days=current_days, **options)


def drift_sweep(df: DataFrame, columns, as_of, current_days: int = DRIFT_WINDOW_DAYS, entity=None, **options) -> DataFrame:
    """Drift of every column (and entity) in one job."""
    samples = samples_from_columns(df, columns, as_of, current_days, entity)
    return check_drift(samples, as_of, days=current_days, **options)


COUNTS = "feature_name string, entity_id string, value double, n bigint, date date"


def refresh_daily_counts(df: DataFrame, root: str, columns, entity: str | None = None) -> None:
    """Counts of the distinct values of each column on each day of df, kept as plain Parquet by date.

    The days of df are replaced and no other is touched, so a sweep gives the
    days that are new or have late rows, whole, and nothing else is read.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature_name"), F.col(c).cast("double").alias("value")) for c in columns])
    who = F.col(entity).cast("string") if entity else F.lit("all")
    rows = df.select(who.alias("entity_id"), "date", F.inline(pairs))
    # Without a value a row still shows that its key is there.
    value = F.when(~F.isnan("value"), F.col("value")).alias("value")
    counts = rows.groupBy("feature_name", "entity_id", value, "date").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("feature_name", "entity_id", "value", "n", "date").hint("rebalance", F.col("date"))
    writer = counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(root)


def drift_from_counts(
    spark: SparkSession, root: str, as_of, current_days: int = DRIFT_WINDOW_DAYS, threshold: float = DRIFT_THRESHOLD,
    exact: bool = False, **options,
) -> DataFrame:
    """drift_sweep from the daily counts: they are added up on both sides of the cut, and no fact is read."""
    check_lookback(current_days)
    counts = spark.read.schema(COUNTS).parquet(root)
    current = F.col("date") >= F.date_sub(as_date(as_of), current_days)
    n = lambda side: F.coalesce(F.sum(F.when(side, F.col("n"))), F.lit(0))
    collapsed = counts.where("value IS NOT NULL").groupBy(*KEY, "value").agg(n(~current).alias("hist"), n(current).alias("cur"))
    return _drift_rows(counts.select(*KEY).distinct(), statistics_of_counts(collapsed, **options), as_of, threshold, current_days, exact)


def spc_limits(samples: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Control limits per key from the historical sample."""
    return samples.where(F.col("side") == HISTORICAL).groupBy(*KEY).agg(
        F.avg("value").alias("center"), F.stddev_pop("value").alias("sigma")
    ).withColumns({
        "lower_limit": F.col("center") - sigmas * F.col("sigma"),
        "upper_limit": F.col("center") + sigmas * F.col("sigma"),
    })


def spc_violations(samples: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Current values outside the limits of their key."""
    limits = spc_limits(samples, sigmas)
    points = samples.where(F.col("side") == CURRENT).drop("side")
    outside = (F.col("value") < F.col("lower_limit")) | (F.col("value") > F.col("upper_limit"))
    return null_safe_join(points, limits, KEY, "inner").where(outside)


def drift_alerts(results: DataFrame) -> DataFrame:
    return results.where(S.drift_detected()).select(
        *KEY, "drift_status", "drift_score", "threshold", "window_start", "window_end"
    )
