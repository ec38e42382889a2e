"""Operators with one key that holds most of the rows, without broadcast joins."""

from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterlake.functions.keyed import skew_join, without_known
from meterlake.functions.order_stats import MAX_CUTS, cut_pieces, running_counts
from meterlake.operators import drift as D
from meterlake.operators import embeddings as E
from meterlake.operators import features as O

NOW = datetime(2024, 1, 1)
TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextmanager
def settings(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def run(df):
    """Rows and final plan; the frame is executed as it is."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


@pytest.fixture
def hot(spark):
    # Several input partitions: a skewed partition is cut between map outputs.
    return spark.range(0, 40_000, 1, 16).select(
        F.col("id").alias("position"),
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("entity_id"))


def test_skewed_partition_is_split(spark, hot):
    with settings(spark, TIGHT):
        right = hot.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
        rows, plan = run(skew_join(hot, right, ["entity_id"], "left"))
        assert "skew=true" in plan
        _, plain = run(hot.join(right, "entity_id", "left"))
        assert "skew=true" not in plain
    assert len(rows) == 40_000 and {r.n for r in rows if r.entity_id == "hot"} == {26_666}


def test_online_lookup(spark, hot):
    online = hot.select("entity_id").distinct().select("entity_id", F.lit("f").alias("feature_name"), F.col("entity_id").alias("value"))
    with settings(spark, TIGHT):
        rows, plan = run(O.get_online_features(hot, online, ["f"]))
    assert "skew=true" in plan and len(rows) == 40_000 and all(r.f == r.entity_id for r in rows)


def test_cache_lookup(spark, hot):
    requests = hot.select(F.col("position").cast("string").alias("request_id"), F.col("entity_id").alias("text"), F.lit("m").alias("model"))
    cache = E.with_cache_key(requests.select("text", "model").distinct()).where("text NOT LIKE 'u1%'").select(
        "cache_key", "model", F.array(F.lit(1.0).cast("float")).alias("embedding"),
        F.lit(NOW).cast("timestamp_ntz").alias("written_at"), F.lit(datetime(2025, 1, 1)).cast("timestamp_ntz").alias("expires_at"))
    with settings(spark, TIGHT):
        rows, plan = run(E.cache_lookup(requests, cache, NOW))
    assert "skew=true" in plan and len(rows) == 40_000
    assert all(r.cache_hit == (not r.text.startswith("u1")) for r in rows)


def test_drift_of_a_hot_feature(spark):
    values = spark.range(0, 30_000, 1, 16).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 50)).alias("feature_name"),
        F.lit("all").alias("entity_id"),
        F.when(F.col("id") % 7 < 5, D.HISTORICAL).otherwise(D.CURRENT).alias("side"),
        (F.xxhash64("id") % 100_000 / 7.0).alias("value"))
    plain = {r.feature_name: r for r in D.drift_statistics(values).collect()}
    with settings(spark, TIGHT):
        rows, plan = run(D.drift_statistics(values, rows_per_cut=1000))
    assert "skew=true" in plan
    for r in rows:
        want = plain[r.feature_name]
        assert r.psi == pytest.approx(want.psi, abs=1e-9) and r.ks_statistic == pytest.approx(want.ks_statistic)
    assert len(rows) == len(plain)


def test_blocks_stay_small(spark):
    """No (group, cut) block holds more than a small share of the values, however they are spread."""
    collapsed = spark.range(50_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("k"),
        F.exp(F.col("id") / 3000).alias("value"), F.lit(1).cast("long").alias("n"))
    blocks = cut_pieces(collapsed, "value", ["n"], rows_per_cut=100).groupBy("k", "_cut").count()
    assert blocks.agg(F.max("count")).first()[0] <= 50_000 / MAX_CUTS * 2
    assert cut_pieces(collapsed, "value", ["n"]).agg(F.max("_cut")).first()[0] == 0
    ranked = running_counts(collapsed, ["k"], "value", ["n"], rows_per_cut=100).where("k = 'hot'")
    rows = ranked.select("value", "cum_n", "all_n").orderBy("value").collect()
    assert [r.cum_n for r in rows] == list(range(1, 45_001)) and {r.all_n for r in rows} == {45_000}


def test_without_known_filters_in_place(spark):
    rows, known = spark.range(1000), spark.range(990, 2000)
    kept = without_known(rows, known, ["id"])
    assert sorted(r.id for r in kept.collect()) == list(range(990))
    assert "BroadcastHashJoin" in kept._jdf.queryExecution().executedPlan().toString()
