"""Exact order statistics per group when one group may be very large.

A window over a whole group would bring that group to one task, and the
built-in exact percentile keeps a map of all its values. Here rows are first
collapsed to distinct (group, value) pairs with counts. The values are then
cut at quantiles of *all* the distinct pairs, so a (group, cut) block holds at
most about 1 / MAX_CUTS of them (or less, see _levels), whichever group they belong to. Running
counts are local to a block, and a prefix sum over the few blocks of each
group adds what came before.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A power of two: finding the block of a value is then LEVELS halving steps.
LEVELS = 10
MAX_CUTS = 2**LEVELS


def _levels(df: DataFrame) -> int:
    """More cuts where the session has more shuffle partitions, so that blocks don't grow with the data."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(LEVELS, math.ceil(math.log2(4 * partitions)))


ROWS_PER_CUT = 1_000_000


def distinct_counts(df: DataFrame, keys: Sequence[str], value: str, **counts: Column) -> DataFrame:
    """One row per (keys, value) with sums of the given 0/1 columns.

    Null keys are keys; values that are null or NaN have no place in an order
    and are left out.
    """
    usable = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    sums = counts or {"n": F.lit(1)}
    return usable.groupBy(*keys, value).agg(
        *[F.sum(c.cast("long")).alias(name) for name, c in sums.items()]
    )


def _cuts(collapsed: DataFrame, value: str, columns: Sequence[str], rows_per_cut: int) -> Column:
    """Scalar array of cut points: none for small data, quantiles of the values else."""
    # Naming every column keeps this branch equal to the other uses of collapsed,
    # so that Spark computes its exchange once and reuses it.
    missing = F.col(columns[0]).isNull()
    for c in columns[1:]:
        missing = missing | F.col(c).isNull()
    rows = F.count_if(missing) + F.count_if(~missing)
    cuts = 2 ** _levels(collapsed)
    grid = ", ".join(f"{i / cuts}D" for i in range(1, cuts))
    quantiles = F.expr(f"percentile_approx(`{value}`, array({grid}), {10 * cuts})")
    empty = F.array().cast("array<double>")
    return collapsed.agg(
        F.when(rows > rows_per_cut, quantiles).otherwise(empty).alias("cuts")
    ).scalar()


def cut_pieces(
    collapsed: DataFrame, value: str, counts: Sequence[str], rows_per_cut: int = ROWS_PER_CUT
) -> DataFrame:
    """Add _cut, the number of cut points <= value; 0 everywhere for small data.

    It is found by halving, and never null: a null check on it would be pushed
    below the exchange.
    """
    halves = ", ".join(str(2**level) for level in reversed(range(_levels(collapsed))))
    search = (
        f"CASE WHEN size(_cuts) = 0 THEN 0 ELSE coalesce(aggregate(array({halves}), 0, (at, step) -> "
        f"CASE WHEN get(_cuts, at + step - 1) <= `{value}` THEN at + step ELSE at END), 0) END"
    )
    cuts = _cuts(collapsed, value, counts, rows_per_cut)
    return collapsed.withColumn("_cuts", cuts).withColumn("_cut", F.expr(search)).drop("_cuts")


def running_counts(
    collapsed: DataFrame,
    keys: Sequence[str],
    value: str,
    counts: Sequence[str],
    rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Add cum_<c> (over values <= this one) and all_<c> (over the group) per count column.

    collapsed has one row per (keys, value). Counts may be any exact numeric
    type and may be negative, so this is also a running sum.
    """
    keys = list(keys)
    pieces = cut_pieces(collapsed, value, counts, rows_per_cut)
    # As one struct, so that null keys meet in the join.
    key = F.struct(*keys) if keys else F.lit(0)
    pieces = pieces.withColumn("_key", key)
    group = Window.partitionBy("_key")
    earlier = group.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("_key", "_cut").agg(*[F.sum(c).alias(c) for c in counts])
    blocks = blocks.select(
        "_key",
        "_cut",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in counts],
        *[F.sum(c).over(group).alias(f"all_{c}") for c in counts],
    )
    inside = Window.partitionBy("_key", "_cut").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    joined = pieces.join(blocks, ["_key", "_cut"])
    return joined.select(
        *keys,
        value,
        *counts,
        *[(F.col(f"_before_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in counts],
        *[f"all_{c}" for c in counts],
    )


# The aggregates below are SQL text: a report takes dozens of them.


def value_at_rank(value: str, cum: str, rank: str) -> str:
    """Aggregate: the value at a 0-based rank among the counted rows of a group."""
    return f"min(CASE WHEN {cum} > {rank} THEN {value} END)"


def linear_percentile(value: str, cum: str, total: str, q: float) -> tuple[str, str]:
    """Aggregates for the two neighbours of the linear-interpolated percentile q."""
    position = f"({total} - 1) * {q!r}D"
    return (
        value_at_rank(value, cum, f"floor({position})"),
        value_at_rank(value, cum, f"ceil({position})"),
    )


def interpolate(low: str, high: str, total: str, q: float) -> str:
    position = f"({total} - 1) * {q!r}D"
    return f"{low} + ({high} - {low}) * ({position} - floor({position}))"


def nearest_rank(value: str, cum: str, total: str, q: float) -> str:
    """Aggregate: the sorted values indexed at int(n * q), the last one at most."""
    return value_at_rank(value, cum, f"least(floor({total} * {q!r}D), {total} - 1)")
