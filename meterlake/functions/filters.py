"""Row filters. All are plain predicates on raw columns, so they reach the scan."""

from __future__ import annotations

import warnings
from datetime import date
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keyed import checked_broadcast, skew_join

# Longer id lists become a semi join instead of an ever longer predicate.
INLINE_IDS = 200


def as_date(value) -> Column:
    return F.lit(value if isinstance(value, date) else date.fromisoformat(str(value)))


def check_lookback(days: int) -> int:
    """A look-back of 0 or fewer days is an error, of more than a year a warning."""
    if days <= 0:
        raise ValueError(f"days must be positive, got {days}")
    if days > 365:
        warnings.warn(f"look-back of {days} days scans more than one year", stacklevel=3)
    return days


def lookback_verdict(days: str) -> Column:
    """The same rule for a column of look-backs: error, warning or ok; null is an error."""
    value = F.col(days)
    return F.when(value.isNull() | (value <= 0), "error").when(value > 365, "warning").otherwise("ok")


def trailing_days(df: DataFrame, as_of, days: int, column: str = "date") -> DataFrame:
    """Rows on or after as_of - days. There is no upper bound."""
    check_lookback(days)
    return df.where(F.col(column) >= F.date_sub(as_date(as_of), days))


def date_range(df: DataFrame, start=None, end=None, column: str = "date") -> DataFrame:
    """Both ends inclusive, each optional."""
    if start:
        df = df.where(F.col(column) >= as_date(start))
    if end:
        df = df.where(F.col(column) <= as_date(end))
    return df


def entity_in(df: DataFrame, ids: Sequence[str] | DataFrame | None, column: str = "user_id") -> DataFrame:
    """Rows whose column is in ids; no ids means no filter.

    ids is a list, or a frame whose first column holds them. A short list is an
    IN predicate that is pushed to the scan; anything longer is a semi join.
    """
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
        return skew_join(df, checked_broadcast(wanted), [column], "left_semi")
    ids = list(ids)
    if not ids:
        return df
    if len(ids) <= INLINE_IDS:
        return df.where(F.col(column).isin(ids))
    listed = df.sparkSession.createDataFrame([(i,) for i in ids], f"`{column}` string").distinct()
    return skew_join(df, checked_broadcast(listed), [column], "left_semi")


def optional_user(df: DataFrame, user_id: str | None = None) -> DataFrame:
    return df.where(F.col("user_id") == user_id) if user_id else df


def for_key(df: DataFrame, entity_id: str, feature_name: str) -> DataFrame:
    return df.where((F.col("entity_id") == entity_id) & (F.col("feature_name") == feature_name))
