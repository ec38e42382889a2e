"""Online feature entries: long rows with an expiry, stored by bucket of the entity.

A store is plain Parquet, root/bucket=<n>/*.parquet, with one row per (entity,
feature). An update reads and rewrites only the buckets that its entities fall
into, so a read takes the rows as they are.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from meterlake.functions.keyed import latest_per_key
from meterlake.functions.scalars import glob_to_regex
from meterlake.plans.session import work_folder
from meterlake.schemas import FEATURE_TTL_SECONDS, ONLINE_FEATURE

ONLINE_KEY = ["entity_id", "feature_name"]


def with_expiry(df: DataFrame, ttl_seconds=FEATURE_TTL_SECONDS, written_at: str = "written_at") -> DataFrame:
    """expires_at = written_at + ttl. ttl is a number of seconds or a column."""
    ttl = ttl_seconds if isinstance(ttl_seconds, Column) else F.lit(ttl_seconds)
    return df.withColumn("expires_at", F.col(written_at) + F.make_dt_interval(secs=ttl))


def visible(df: DataFrame, as_of) -> DataFrame:
    """Entries not yet expired; an entry is gone exactly at its expiry."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    return df.where(F.col("expires_at") > moment)


def merge_online(existing: DataFrame | None, updates: DataFrame) -> DataFrame:
    """The newest entry of every (entity, feature)."""
    rows = updates if existing is None else existing.unionByName(updates)
    return latest_per_key(rows, ONLINE_KEY, ["written_at", "value"])


def online_rows(wide: DataFrame, names: list[str], written_at, ttl_seconds=FEATURE_TTL_SECONDS,
                entity: str = "user_id", expires_at: Column | None = None) -> DataFrame:
    """One entry per (entity, name) from one wide row per entity; expires_at replaces the time to live."""
    moment = written_at if isinstance(written_at, Column) else F.lit(written_at)
    entries = F.array(*[
        F.struct(F.lit(n).alias("feature_name"), F.col(n).cast("string").alias("value")) for n in names
    ])
    rows = wide.select(
        F.col(entity).alias("entity_id"),
        F.inline(entries),
        moment.cast("timestamp_ntz").alias("written_at"),
        *([] if expires_at is None else [expires_at.alias("expires_at")]),
    ).where("value IS NOT NULL")
    rows = with_expiry(rows, ttl_seconds) if expires_at is None else rows
    return rows.select(*[f.name for f in ONLINE_FEATURE])


BUCKETS = 64
STORED = StructType([*ONLINE_FEATURE.fields, StructField("bucket", IntegerType())])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("entity_id"), F.lit(buckets)).cast("int").alias("bucket")


def stored_entries(spark: SparkSession, root: str) -> DataFrame:
    """All entries of the store with their bucket, expired ones too; none where nothing has been published."""
    spark.createDataFrame([], STORED).write.mode("append").partitionBy("bucket").parquet(root)
    return spark.read.schema(STORED).parquet(root)


def touched_entries(spark: SparkSession, root: str, updates: DataFrame) -> DataFrame:
    """Entries of the buckets of updates (which has a bucket column); other buckets are not read."""
    # At most as many numbers as there are buckets.
    buckets = [r.bucket for r in updates.select("bucket").distinct().collect()]
    return stored_entries(spark, root).where(F.col("bucket").isin(buckets))


def publish_online_features(updates: DataFrame, root: str, as_of=None, buckets: int = BUCKETS) -> None:
    """Upsert entries: of one key the newest counts, whether stored or given, repeated or late.

    The merged buckets are written aside first and replace the old ones when
    they are whole, so a failed update can be repeated. With as_of, entries of
    these buckets that have expired are dropped. Choose more buckets for a
    larger store, and always the same number for one store.
    """
    spark, names = updates.sparkSession, [f.name for f in ONLINE_FEATURE]
    aside = work_folder(spark, "online")
    updates = merge_online(None, updates.select(*names)).select(*names, _bucket(buckets))
    updates.write.parquet(f"{aside}/updates")
    updates = spark.read.schema(STORED).parquet(f"{aside}/updates")
    kept = touched_entries(spark, root, updates).select(*names, "bucket")
    merged = latest_per_key(kept.unionByName(updates), [*ONLINE_KEY, "bucket"], ["written_at", "value"])
    if as_of is not None:
        merged = visible(merged, as_of)
    # An emptied bucket needs a row to be replaced; its marker has expired at once.
    moment = F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz")
    marker = updates.select("bucket").distinct().select(
        F.lit("").alias("entity_id"), F.lit("").alias("feature_name"), F.lit(None).cast("string").alias("value"),
        moment.alias("written_at"), moment.alias("expires_at"), "bucket")
    merged = latest_per_key(merged.unionByName(marker), [*ONLINE_KEY, "bucket"], ["written_at", "value"])
    merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{aside}/merged")
    whole = spark.read.schema(STORED).parquet(f"{aside}/merged")
    writer = whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(root)


def read_online(spark: SparkSession, root: str, as_of, entity_ids: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Entries that have not expired; for a list of entities only their buckets are read."""
    rows = stored_entries(spark, root)
    if entity_ids is not None:
        wanted = [F.pmod(F.xxhash64(F.lit(e)), F.lit(buckets)).cast("int") for e in entity_ids]
        rows = rows.where(F.col("bucket").isin(wanted) & F.col("entity_id").isin(entity_ids))
    return visible(rows, as_of).drop("bucket")


def key_matches(pattern: str, column: str = "feature_name") -> Column:
    """Predicate for a key glob (*, ?, [..]). A bare * or nothing is refused."""
    if not pattern or pattern.strip() == "*":
        raise ValueError("a pattern that matches every key is refused")
    return F.rlike(F.col(column), F.lit(glob_to_regex(pattern)))


def entry_key(prefix: str = "feature") -> Column:
    """Readable key prefix:entity:feature that patterns can be written against."""
    return F.concat_ws(":", F.lit(prefix), F.col("entity_id"), F.col("feature_name"))


def delete_by_pattern(df: DataFrame, pattern: str, column: str = "feature_name") -> tuple[DataFrame, DataFrame]:
    """(entries that stay, one row with the number of distinct keys removed)."""
    hit = key_matches(pattern, column)
    return df.where(~F.coalesce(hit, F.lit(False))), df.where(hit).agg(
        F.countDistinct(column).alias("deleted")
    )


def delete_key(df: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """(entries that stay, one row that says whether the key existed)."""
    hit = F.coalesce(F.col(column) == key, F.lit(False))
    return df.where(~hit), df.agg(F.coalesce(F.bool_or(hit), F.lit(False)).alias("existed"))
