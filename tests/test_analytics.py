from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import alerts as R
from meterlake.operators import analytics as A
from meterlake.operators import features as O
from meterlake.plans.passthrough import register, sql_passthrough

AS_OF = "2024-01-31"


@pytest.fixture
def sample():
    """Ten calls, three users, two models, one per hour."""
    return [dict(user_id=f"u{i % 3}", model="gpt-4" if i % 2 == 0 else "gpt-3.5-turbo", input_tokens=10 + i,
                 output_tokens=20 + i, latency_ms=1000.0 + 100 * i, cost_usd=0.001 * (i + 1),
                 timestamp=datetime(2024, 1, 30, 12) - timedelta(hours=3 * i)) for i in range(10)]


def total(sample, key):
    sums = defaultdict(float)
    for r in sample:
        sums[key(r)] += r["cost_usd"]
    return {k: pytest.approx(v) for k, v in sums.items()}


def test_cost_by_day(make_calls, sample):
    rows = A.cost_by_day(make_calls(sample), AS_OF, 30).collect()
    assert {r.date: r.total_cost for r in rows} == total(sample, lambda r: str(r["timestamp"].date()))
    assert [r.date for r in rows] == sorted(r.date for r in rows)
    one = A.cost_by_day(make_calls(sample), AS_OF, 30, "u1").collect()
    assert sum(r.total_cost for r in one) == pytest.approx(sum(r["cost_usd"] for r in sample if r["user_id"] == "u1"))


def test_cost_by_model_is_descending(make_calls, sample):
    rows = A.cost_by_model(make_calls(sample), AS_OF).collect()
    assert {r.model: r.total_cost for r in rows} == total(sample, lambda r: r["model"])
    assert rows[0].total_cost >= rows[1].total_cost


def test_token_stats(make_calls, sample):
    row = A.token_stats(make_calls(sample), AS_OF).first()
    assert row.interaction_count == 10 and row.total_input_tokens == 145 and row.total_output_tokens == 245
    assert row.total_tokens == 390 and row.avg_tokens_per_request == 39.0


def test_top_users(make_calls, sample):
    rows = A.top_users_by_cost(make_calls(sample), AS_OF, 30, 2).collect()
    assert len(rows) == 2 and rows[0].user_id == "u0" and rows[0].interaction_count == 4
    tied = make_calls([{"user_id": u, "timestamp": datetime(2024, 1, 30)} for u in "cab"])
    assert [r.user_id for r in A.top_users_by_cost(tied, AS_OF).collect()] == ["a", "b", "c"]


def test_nothing_in_the_window(make_calls, sample):
    rows = make_calls(sample).where("false")
    assert A.cost_by_day(rows, AS_OF).collect() == [] and A.cost_by_model(rows, AS_OF).collect() == []
    stats = A.token_stats(rows, AS_OF).first()
    assert tuple(stats) == (0, 0.0, 0, 0, 0)
    record = A.cost_summary_record(rows).first()
    assert record.total_cost_usd == 0.0 and record.avg_cost_per_interaction == 0.0
    hits = A.cache_hit_rate(rows.select(F.lit(True).alias("cache_hit"))).first()
    assert hits.cache_hit_rate == 0.0 and hits.cache_hits == 0
    overall = {r.metric: r.value for r in A.cost_summary(rows, AS_OF).collect()}
    assert overall["total_cost"] == 0.0 and overall["interaction_count"] == 0.0


@pytest.mark.parametrize("report", [A.cost_by_day, A.cost_by_model, A.token_stats, A.top_users_by_cost, A.cost_summary])
def test_days_are_checked_everywhere(make_calls, report):
    with pytest.raises(ValueError):
        report(make_calls([{}]), AS_OF, 0)


def test_summary_agrees_with_its_parts(make_calls, sample):
    rows = make_calls(sample)
    got = {(r.section, r.key, r.metric): r.value for r in A.cost_summary(rows, AS_OF).collect()}
    assert got["total_cost", "all", "total_cost"] == pytest.approx(sum(r["cost_usd"] for r in sample))
    for r in A.cost_by_model(rows, AS_OF).collect():
        assert got["cost_by_model", r.model, "total_cost"] == pytest.approx(r.total_cost)
    for r in A.top_users_by_cost(rows, AS_OF).collect():
        assert got["top_users", r.user_id, "avg_latency_ms"] == pytest.approx(r.avg_latency_ms)


def test_offline_features(make_calls):
    rows = make_calls([dict(user_id=f"u{i % 3}", cost_usd=0.01 * (i // 3 + 1)) for i in range(15)])
    got = {r.entity_id: r for r in A.offline_features(rows, ["u0", "u1"]).collect()}
    assert set(got) == {"u0", "u1"}
    assert got["u0"].interaction_count == 5 and got["u0"].total_cost == pytest.approx(0.15)


@pytest.mark.parametrize("rows_per_cut", [10, 10**6])
def test_percentiles_are_sorted_index(spark, rows_per_cut):
    rng = np.random.default_rng(5)
    data = {"hot": np.round(rng.normal(100, 20, 900), 1), "flat": np.full(50, 7.0), "one": np.array([3.0]),
            "few": rng.random(10)}
    rows = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs], "operation string, duration_ms double")
    got = {r.operation: r for r in A.latency_percentiles(rows, rows_per_cut=rows_per_cut).collect()}
    for name, values in data.items():
        ordered = sorted(values)
        for q, p in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
            assert got[name][p] == ordered[int(len(ordered) * q)]
        assert got[name].avg == pytest.approx(values.mean()) and got[name]["count"] == len(values)


def test_sketch_is_close_to_exact(spark):
    rows = spark.range(5000).select(F.lit("op").alias("operation"), F.col("id").cast("double").alias("duration_ms"))
    sketch, exact = A.latency_percentiles_approx(rows).first(), A.latency_percentiles(rows).first()
    for name in ("p50", "p95", "p99"):
        assert abs(sketch[name] - exact[name]) <= 2
    assert sketch["count"] == 5000 and sketch.avg == exact.avg


def test_consistency_finds_differences(make_calls):
    rows = make_calls([{"user_id": "a"}, {"user_id": "b"}, {"user_id": "b"}])
    online = O.online_features_lifetime(rows.where("interaction_id <> 'i2'"))
    got = {r.user_id: r.consistent for r in A.tier_consistency(online, rows).collect()}
    assert got == {"a": True, "b": False}
    online = O.online_features_lifetime(rows)
    assert A.tier_consistency(online, rows).where("NOT consistent").count() == 0
    missing = {r.user_id: r.consistent for r in A.tier_consistency(online.where("user_id = 'a'"), rows).collect()}
    assert missing == {"a": True, "b": False}


def test_passthrough_binds_and_raises(make_calls):
    rows = make_calls([{"user_id": "it's"}, {"user_id": "b"}])
    register({"interactions": rows})
    spark = rows.sparkSession
    query = "SELECT count(*) AS n FROM interactions WHERE user_id = ?"
    assert sql_passthrough(spark, query, ["it's"]).first().n == 1
    assert sql_passthrough(spark, query, ["x' OR '1'='1"]).first().n == 0
    named = "SELECT count(*) AS n FROM interactions WHERE user_id = :who"
    assert sql_passthrough(spark, named, {"who": "b"}).first().n == 1
    with pytest.raises(Exception, match="nowhere"):
        sql_passthrough(spark, "SELECT * FROM nowhere").collect()


def day(d, cost):
    return {"timestamp": datetime(2024, 1, d, 5), "cost_usd": cost}


def test_cost_spike_looks_at_the_day_before(make_calls):
    rows = make_calls([day(1, 10.0), day(2, 12.0), day(3, 12.1), day(5, 30.0), day(6, 37.0)])
    got = [(r.at, round(r.value, 4)) for r in R.cost_spike(rows).collect()]
    # Exactly 20 % is no spike, and day 5 has no day before it.
    assert got == [("2024-01-06", round(37 / 30 - 1, 4))]


def test_budget_levels(make_calls):
    rows = make_calls([day(1, 30.0), day(2, 10.0), day(3, 5.0), day(4, 5.0), day(5, 1.0),
                       {"timestamp": datetime(2024, 2, 1), "cost_usd": 39.0}])
    got = sorted((r.subject, r.threshold, r.at) for r in R.budget(rows).collect())
    assert got == [("2024-01", 40.0, "2024-01-02"), ("2024-01", 50.0, "2024-01-04")]
    assert R.month_to_date(rows, "2024-01-03").first().total_cost == pytest.approx(45.0)


def test_daily_cost_limit_is_exclusive(make_calls):
    rows = make_calls([day(1, 10.0), day(2, 10.5)])
    assert [r.at for r in R.daily_cost(rows).collect()] == ["2024-01-02"]


def test_percentiles_keep_the_null_group(spark):
    rows = spark.createDataFrame([(None if i % 5 == 0 else f"op{i % 2}", float(i)) for i in range(1000)], "operation string, duration_ms double")
    for options in ({}, {"rows_per_cut": 50}):
        got = {r.operation: r for r in A.latency_percentiles(rows, **options).collect()}
        assert sum(r["count"] for r in got.values()) == 1000 and set(got) == {None, "op0", "op1"}
        assert got[None].p50 == 500.0 and got[None]["max"] == 995.0
