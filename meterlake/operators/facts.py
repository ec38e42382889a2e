"""Inserting into the fact and feature tables: first row per key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import scalars as S
from meterlake.functions.keyed import first_per_key, without_known
from meterlake.schemas import FEATURE, FEATURE_KEY

INTERACTION_KEY = ["interaction_id"]


def new_rows(
    batch: DataFrame,
    keys: Sequence[str],
    existing: DataFrame | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Rows of batch to append: the first per key whose key is not in existing.

    order says what "first" means when a batch repeats a key; the default is
    the timestamp, then the whole row, so that repeated runs agree. A row with
    a null in its key is refused, as in any table with a key. Each task sends
    one row per key at most, and no job runs while the plan is built.
    """
    keys = list(keys)
    if order is None:
        row = F.xxhash64(*[F.col(c) for c in sorted(batch.columns)])
        order = [F.col("timestamp"), row]
    once = first_per_key(batch.dropna(subset=keys), keys, order)
    return once if existing is None else without_known(once, existing, keys)


def insert_interactions(
    batch: DataFrame, existing: DataFrame | None = None, order: Sequence[Column] | None = None
) -> DataFrame:
    return new_rows(batch, INTERACTION_KEY, existing, order)


def rejected_interactions(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """interaction_id and number of rows that an insert of batch refuses; all of those without an id."""
    seen = batch.groupBy(*INTERACTION_KEY).agg(F.count(F.lit(1)).alias("rows"))
    if existing is None:
        refused = seen.withColumn("rejected", F.col("rows") - F.col("interaction_id").isNotNull().cast("int"))
    else:
        known = existing.select(*INTERACTION_KEY, F.lit(1).alias("_known")).distinct()
        refused = seen.join(known, INTERACTION_KEY, "left").withColumn(
            "rejected", F.col("rows") - F.when(F.col("_known").isNull() & F.col("interaction_id").isNotNull(), 1).otherwise(0)
        )
    return refused.where("rejected > 0").select(*INTERACTION_KEY, "rejected")


def feature_rows(df: DataFrame, complex_value: bool = False) -> DataFrame:
    """Long feature rows in table form: value as text, defaults filled, date derived."""
    defaults = {
        "version": F.lit(1), "metadata": F.lit("{}"), "feature_type": F.lit("numeric"),
    }
    for name, default in defaults.items():
        df = df.withColumn(name, F.coalesce(name, default) if name in df.columns else default)
    df = df.withColumn("value", S.stringify_value("value", complex_value))
    df = df.withColumn("date", S.event_date())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURE])


def insert_features(batch: DataFrame, existing: DataFrame | None = None, complex_value: bool = False) -> DataFrame:
    rows = feature_rows(batch, complex_value)
    return new_rows(rows, FEATURE_KEY, existing)
