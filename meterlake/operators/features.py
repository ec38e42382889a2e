"""Online, offline and rolling features per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import scalars as S
from meterlake.functions.filters import as_date, entity_in, for_key, trailing_days
from meterlake.functions.keyed import latest_per_key, skew_join
from meterlake.functions.order_stats import running_counts
from meterlake.operators.analytics import offline_features
from meterlake.operators.facts import feature_rows, insert_interactions
from meterlake.schemas import FEATURE_TTL_SECONDS
from meterlake.sources.online import online_rows

ONLINE_NAMES = [
    "total_cost", "total_tokens", "interaction_count", "avg_latency", "last_model", "last_interaction_time",
]
AGGREGATE_NAMES = ["interaction_count", "total_cost", "total_tokens", "avg_latency"]

def _latest() -> Column:
    """Aggregate: the newest call of a group, by time and then by id."""
    return F.max(F.struct("timestamp", "interaction_id", "model"))


def _once(df: DataFrame, count_duplicates: bool) -> DataFrame:
    """A repeated interaction_id is counted once, unless duplicates are wanted.

    Only the columns the features need are ranked.
    """
    if count_duplicates:
        return df
    needed = ["interaction_id", "user_id", "model", "timestamp", "total_tokens", "cost_usd", "latency_ms"]
    return insert_interactions(df.select(*needed))


def online_features_lifetime(df: DataFrame, count_duplicates: bool = True) -> DataFrame:
    """Totals per user over all rows given.

    df is taken to be free of duplicates (the fact table is). Pass
    count_duplicates=False for raw events that may repeat an id.
    """
    return _once(df, count_duplicates).groupBy("user_id").agg(
        F.sum("cost_usd").alias("total_cost"),
        F.sum("total_tokens").alias("total_tokens"),
        F.count(F.lit(1)).alias("interaction_count"),
        F.avg("latency_ms").alias("avg_latency"),
        _latest().alias("_last"),
    ).select(
        "user_id", "total_cost", "total_tokens", "interaction_count", "avg_latency",
        F.col("_last.model").alias("last_model"),
        F.col("_last.timestamp").alias("last_interaction_time"),
    )


def activity_sessions(
    df: DataFrame, gap_seconds: int = FEATURE_TTL_SECONDS, count_duplicates: bool = True
) -> DataFrame:
    """Running totals that start again after gap_seconds without a call of the user.

    Calls in one time slot as long as the gap always belong together, so rows
    are first added up per (user, slot). The ordered step then sees at most one
    row per slot and user, however many calls a user makes.
    """
    gap = gap_seconds * 1_000_000
    at = S.micros("timestamp")
    slots = _once(df, count_duplicates).groupBy("user_id", F.floor(at / gap).alias("slot")).agg(
        F.sum("cost_usd").alias("cost"),
        F.sum("total_tokens").alias("tokens"),
        F.sum("latency_ms").alias("latency"),
        F.count(F.lit(1)).alias("calls"),
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.min("timestamp").alias("first_time"),
        _latest().alias("last"),
    )
    w = Window.partitionBy("user_id").orderBy("slot")
    starts = F.col("first_at") - F.lag("last_at").over(w) >= gap
    numbered = slots.withColumn("starts", F.coalesce(starts, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("session_no", F.sum("starts").over(w))
    sessions = numbered.groupBy("user_id", "session_no").agg(
        F.sum("cost").alias("total_cost"),
        F.sum("tokens").alias("total_tokens"),
        F.sum("calls").alias("interaction_count"),
        (F.sum("latency") / F.sum("calls")).alias("avg_latency"),
        F.min("first_time").alias("session_start"),
        F.max("last").alias("last"),
    )
    return sessions.select(
        "user_id", "session_no", "total_cost", "total_tokens", "interaction_count", "avg_latency",
        F.col("last.model").alias("last_model"),
        "session_start",
        F.col("last.timestamp").alias("last_interaction_time"),
        (F.col("last.timestamp") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("expires_at"),
    )


def online_features_ttl(
    df: DataFrame, as_of=None, gap_seconds: int = FEATURE_TTL_SECONDS, count_duplicates: bool = True
) -> DataFrame:
    """The state a reader sees: the user's current session, where it has not expired.

    Without as_of the last session of every user is returned, expired or not.
    """
    if as_of is not None:
        moment = F.lit(as_of).cast("timestamp_ntz")
        df = df.where(F.col("timestamp") <= moment)
    sessions = activity_sessions(df, gap_seconds, count_duplicates)
    last = latest_per_key(sessions, ["user_id"], ["session_no"])
    return last if as_of is None else last.where(F.col("expires_at") > moment)


def get_online_features(requests: DataFrame, online: DataFrame, names: Sequence[str]) -> DataFrame:
    """One column per name next to each request; null where there is no value.

    requests has entity_id and any other columns (such as the position), all
    kept. The entries are turned to one row per entity before the join.
    """
    names = list(names)
    wide = online.where(F.col("feature_name").isin(names)).groupBy("entity_id").agg(
        *[F.max(F.when(F.col("feature_name") == n, F.col("value"))).alias(n) for n in names]
    )
    return skew_join(requests, wide, ["entity_id"], "left")


def online_with_fallback(
    requests: DataFrame, names: Sequence[str], online: DataFrame, warm: DataFrame
) -> DataFrame:
    """(request columns, feature_name, value, served_from): hot entry, else warm value, else none.

    online and warm are long frames (entity_id, feature_name, value).
    """
    key = ["entity_id", "feature_name"]
    names = list(names)
    wanted = F.col("feature_name").isin(names)
    asked = requests.withColumn("feature_name", F.explode(F.array(*[F.lit(n) for n in names])))
    served = (
        F.when(F.col("hot").isNotNull(), "hot").when(F.col("warm").isNotNull(), "warm").otherwise("none")
    )
    found = skew_join(asked, online.where(wanted).select(*key, F.col("value").alias("hot")), key, "left")
    found = skew_join(found, warm.where(wanted).select(*key, F.col("value").alias("warm")), key, "left")
    return found.select(
        *requests.columns, "feature_name", F.coalesce("hot", "warm").alias("value"), served.alias("served_from")
    )


def write_back_rows(served: DataFrame) -> DataFrame:
    """Values read from the warm table that should now be published, once per key."""
    warm = served.where(F.col("served_from") == "warm")
    return warm.groupBy("entity_id", "feature_name").agg(F.max("value").alias("value"))


def feature_history(features: DataFrame, entity_id: str, feature_name: str, as_of, days: int = 30) -> DataFrame:
    rows = for_key(trailing_days(features, as_of, days), entity_id, feature_name)
    return rows.select("timestamp", "value").orderBy("timestamp")


def feature_histories(features: DataFrame, keys: DataFrame, as_of, days: int = 30) -> DataFrame:
    """History of many (entity_id, feature_name) keys in one job; in no order, as it may be of any size."""
    wanted = keys.select("entity_id", "feature_name")
    rows = skew_join(trailing_days(features, as_of, days), wanted, ["entity_id", "feature_name"], "left_semi")
    return rows.select("entity_id", "feature_name", "timestamp", "value")


def latest_feature_values(features: DataFrame) -> DataFrame:
    newest = latest_per_key(features, ["entity_id", "feature_name"], ["timestamp", "version"])
    return newest.select("entity_id", "feature_name", "value", "feature_type", "timestamp", "version")


def to_long(wide: DataFrame, names: Sequence[str], timestamp, entity: str = "entity_id") -> DataFrame:
    """Feature rows (text values) from one wide row per entity."""
    kinds = {"total_cost": "cost", "last_model": "categorical"}
    entries = F.array(*[
        F.struct(
            F.lit(n).alias("feature_name"),
            F.col(n).cast("string").alias("value"),
            F.lit(kinds.get(n, "numeric")).alias("feature_type"),
        )
        for n in names
    ])
    moment = timestamp if isinstance(timestamp, Column) else F.lit(timestamp)
    rows = wide.select(
        F.col(entity).alias("entity_id"), F.inline(entries), moment.cast("timestamp_ntz").alias("timestamp")
    )
    return feature_rows(rows.where(F.col("value").isNotNull()))


def materialize_features(df: DataFrame, computed_at, start=None, end=None) -> tuple[DataFrame, DataFrame]:
    """(long feature rows, online entries) of the aggregates per user, as of computed_at."""
    wide = offline_features(df, None, start, end)
    features = to_long(wide, AGGREGATE_NAMES, computed_at)
    entries = online_rows(wide, AGGREGATE_NAMES, computed_at, entity="entity_id")
    return features, entries


def rolling_features(df: DataFrame, days: int = 7, **options) -> DataFrame:
    """Per user and call time: figures over [t - days, t], both ends included.

    Every call enters the sum at t and leaves it just after t + days, so the
    window is one running sum of exact numbers, computed in blocks that are cut
    by quantiles. No frame is rescanned and no user has to fit one task. Calls
    without a user are a group of their own.
    """
    span = days * 86_400_000_000
    # Cost as whole millionths and the rest in millionths of those: exact sums of
    # whole numbers, which are much cheaper than wide decimals.
    millionths = F.floor(F.col("cost_usd") * 1e6)
    rest = F.round((F.col("cost_usd") * 1e6 - millionths) * 1e6).cast("long")
    calls = df.groupBy("user_id", S.micros("timestamp").alias("at")).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum(F.length("prompt").cast("long")).alias("chars"),
        F.sum(F.col("total_tokens").cast("long")).alias("tokens"),
        F.sum(millionths).alias("cost"),
        F.sum(rest).alias("cost_rest"),
    )
    sums = ["calls", "chars", "tokens", "cost", "cost_rest"]
    steps = F.array(
        F.struct(F.col("at").alias("moment"), F.lit(1).alias("sign")),
        F.struct((F.col("at") + span + 1).alias("moment"), F.lit(-1).alias("sign")),
    )
    moves = calls.select("user_id", *sums, F.inline(steps))
    per_moment = moves.groupBy("user_id", "moment").agg(
        *[F.sum(F.col(c) * F.col("sign")).alias(c) for c in sums],
        F.sum(F.when(F.col("sign") == 1, 1).otherwise(0)).alias("entering"),
    )
    totals = running_counts(per_moment, ["user_id"], "moment", [*sums, "entering"], **options)
    n = F.col("cum_calls")
    return totals.where(F.col("entering") > 0).select(
        "user_id",
        S.from_micros("moment").alias("timestamp"),
        n.alias(f"interaction_count_{days}d"),
        (F.col("cum_chars") / n).alias(f"avg_prompt_length_{days}d"),
        (F.col("cum_tokens") / n).alias(f"avg_tokens_per_request_{days}d"),
        (F.col("cum_cost") / 1e6 + F.col("cum_cost_rest") / 1e12).alias(f"total_cost_{days}d"),
    )


def offline_feature_view(
    df: DataFrame, entity_ids=None, start=None, end=None, days: int = 7, name: str | None = None
) -> DataFrame:
    """Training rows: totals from start to end with the rolling figures at the newest call up to end.

    Nothing after end is looked at. Dates and entities are filtered before the
    rolling figures, so that they reach the scan: of the days before start only
    those that a window from start on can reach back to are needed, and an
    entity without a call since start has no totals either.
    """
    totals = offline_features(df, entity_ids, start, end)
    known = df if entity_ids is None else entity_in(df, entity_ids)
    if end is not None:
        known = known.where(F.col("date") <= as_date(end))
    if start is not None:
        known = known.where(F.col("date") >= F.date_sub(as_date(start), days))
    rolling = latest_per_key(rolling_features(known, days), ["user_id"], ["timestamp"])
    rolling = rolling.withColumnRenamed("user_id", "entity_id").drop("timestamp")
    view = totals.join(rolling, "entity_id", "left")
    if name:
        view.createOrReplaceTempView(name)
    return view


def point_in_time(
    labels: DataFrame, features: DataFrame, key: str = "entity_id", label_time: str = "label_time",
    feature_time: str = "timestamp", **options,
) -> DataFrame:
    """Training rows: each label with the newest feature row of its entity at or before the label's time.

    Nothing from after a label's time is looked at. The moments of both sides
    are counted in one running count of feature rows, in blocks cut by
    quantiles, so that the number carried to a label names its feature row and
    an equi join fetches it: no entity has to fit one task, and no label meets
    more than one row. Of feature rows with one entity and time the last by
    its hash is taken. Labels before the first feature row, and those
    without an entity or time, have null features; label columns come first,
    and the features' time is feature_time.
    """
    names = [c for c in features.columns if c not in (key, feature_time)]
    clash = set(names) & set(labels.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    at = lambda column: S.micros(column).alias("_at")
    usable = features.where(F.col(key).isNotNull() & F.col(feature_time).isNotNull())
    given = usable.select(F.col(key).alias("_who"), at(feature_time), F.struct(F.col(feature_time).alias("feature_time"), *names).alias("_row"))
    given = latest_per_key(given.withColumn("_hash", F.xxhash64("_row")), ["_who", "_at"], ["_hash"]).drop("_hash")
    asked = labels.withColumn("_who", F.col(key)).withColumn("_at", at(label_time))
    timed = asked.where("_who IS NOT NULL AND _at IS NOT NULL")
    moments = given.select("_who", "_at", F.lit(1).alias("_given")).unionByName(timed.select("_who", "_at", F.lit(0).alias("_given")))
    moments = moments.groupBy("_who", "_at").agg(F.max("_given").cast("long").alias("_given"))
    numbers = running_counts(moments, ["_who"], "_at", ["_given"], **options)
    numbers = numbers.select("_who", "_at", "_given", F.col("cum__given").alias("_number"))
    named = skew_join(given, numbers.where("_given = 1").select("_who", "_at", "_number"), ["_who", "_at"], "inner")
    placed = skew_join(timed, numbers.select("_who", "_at", "_number"), ["_who", "_at"], "inner")
    found = skew_join(placed, named.select("_who", "_number", "_row"), ["_who", "_number"], "left")
    rest = asked.where("_who IS NULL OR _at IS NULL")
    found = found.unionByName(rest, allowMissingColumns=True)
    return found.select(*labels.columns, "_row.*")
