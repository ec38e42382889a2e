"""Helpers that pick rows per key or join on a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most max_rows rows; counts no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after a bounded count has shown that df is small.

    A bigger frame is returned as it is, and the join is then planned as a
    shuffled join.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join rows to a side that has one row per key, where one key may hold most of left.

    Adaptive execution splits a skewed partition only where both sides of the
    join have an exchange of their own, and the right side, an aggregate by the
    key, would be joined without one. A hash of the key as a second join column,
    equal whenever the keys are, gives it one. It also keeps an aggregation by
    the key after the join from running inside the skewed partition.
    """
    check = F.xxhash64(*keys)
    joined = left.withColumn("_key_hash", check).join(right.withColumn("_key_hash", check), [*keys, "_key_hash"], how)
    return joined.drop("_key_hash")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """skew_join in which null keys meet: a struct of nulls is a value like any other."""
    key = F.struct(*keys)
    right = right.withColumn("_key", key).drop(*keys)
    return skew_join(left.withColumn("_key", key), right, ["_key"], how).drop("_key")


def without_known(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in known; adaptive execution splits a key with very many rows."""
    return rows.join(known.select(*keys), list(keys), "left_anti")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key by the given order.

    row_number() = 1 is planned with a group limit before the exchange: every
    task sends one row per key at most, so many copies of one key never meet
    in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of every key, with their rank; also limited before the exchange."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
