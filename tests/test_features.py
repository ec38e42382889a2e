from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import features as O
from meterlake.operators.facts import feature_rows
from meterlake.sources.online import online_rows

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(microseconds=round(seconds * 1e6))


def sessions_by_hand(rows, gap):
    """Running totals per user that restart when a call comes gap or more after the last."""
    out = []
    users = defaultdict(list)
    for i, r in enumerate(rows):
        users[r["user_id"]].append((r["timestamp"], r.get("interaction_id", f"i{i}"), r))
    for user, calls in users.items():
        state, last = None, None
        for moment, _, r in sorted(calls, key=lambda c: c[:2]):
            if last is None or moment - last >= timedelta(seconds=gap):
                state = {"user": user, "cost": 0.0, "n": 0}
                out.append(state)
            state["cost"] += r["cost_usd"]
            state["n"] += 1
            state["model"], state["last"] = r["model"], moment
            last = moment
    return sorted((s["user"], s["last"], s["n"], round(s["cost"], 9), s["model"]) for s in out)


def got_sessions(df):
    return sorted((r.user_id, r.last_interaction_time, r.interaction_count, round(r.total_cost, 9), r.last_model)
                  for r in df.collect())


def test_gap_boundary(make_calls):
    rows = make_calls([{"timestamp": at(s)} for s in (10, 309.999999, 609.999999, 1000)])
    counts = sorted(r.interaction_count for r in O.activity_sessions(rows).collect())
    # 299.999999 s continues, exactly 300 s starts again.
    assert counts == [1, 1, 2]


def test_sessions_with_a_hot_user(make_calls):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(900):
        user = "hot" if i % 2 else f"u{rng.integers(5)}"
        rows.append({"user_id": user, "timestamp": at(float(np.round(rng.random() * 100_000, 3))),
                     "cost_usd": float(i) / 1000, "model": f"m{i % 7}"})
    rows += [dict(rows[1], interaction_id="same-time", model="zz")]
    assert got_sessions(O.activity_sessions(make_calls(rows))) == sessions_by_hand(rows, 300)
    assert got_sessions(O.activity_sessions(make_calls(rows), 3600)) == sessions_by_hand(rows, 3600)


def test_state_as_of(make_calls):
    rows = make_calls([{"user_id": "a", "timestamp": at(0)}, {"user_id": "a", "timestamp": at(100)},
                       {"user_id": "b", "timestamp": at(50)}, {"user_id": "a", "timestamp": at(1000)}])
    live = lambda s: {r.user_id: r.interaction_count for r in O.online_features_ttl(rows, at(s)).collect()}
    assert live(100) == {"a": 2, "b": 1}
    assert live(349) == {"a": 2, "b": 1}
    assert live(350) == {"a": 2}
    assert live(400) == {}
    assert live(1000) == {"a": 1}


def test_duplicates_are_counted_once_unless_wanted(make_calls):
    rows = make_calls([{"interaction_id": "x"}, {"interaction_id": "x"}, {"interaction_id": "y"}])
    assert O.online_features_lifetime(rows, count_duplicates=False).first().interaction_count == 2
    assert O.online_features_lifetime(rows).first().interaction_count == 3
    assert O.activity_sessions(rows, count_duplicates=False).first().interaction_count == 2


def test_last_model_by_time_then_id(make_calls):
    rows = make_calls([{"interaction_id": "b", "model": "late", "timestamp": at(9)},
                       {"interaction_id": "a", "model": "tied", "timestamp": at(9)},
                       {"interaction_id": "z", "model": "early", "timestamp": at(1)}])
    assert O.online_features_lifetime(rows).first().last_model == "late"


def test_online_lookup_keeps_order_and_misses(make_calls, spark):
    entries = online_rows(O.online_features_lifetime(make_calls([{"user_id": "a"}, {"user_id": "a"}])),
                          ["interaction_count", "last_model"], START)
    asked = spark.createDataFrame([(0, "b"), (1, "a"), (2, "a")], "position int, entity_id string")
    rows = O.get_online_features(asked, entries, ["last_model", "nothing", "interaction_count"]).orderBy("position").collect()
    assert [(r.entity_id, r.last_model, r.nothing, r.interaction_count) for r in rows] == [
        ("b", None, None, None), ("a", "gpt-4", None, "2"), ("a", "gpt-4", None, "2")]


def test_fallback_and_write_back(spark):
    long = "entity_id string, feature_name string, value string"
    hot = spark.createDataFrame([("a", "f", "1")], long)
    warm = spark.createDataFrame([("a", "f", "0"), ("b", "f", "2"), ("b", "g", "3")], long)
    asked = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "entity_id string")
    served = O.online_with_fallback(asked, ["f"], hot, warm)
    assert sorted((r.entity_id, r.value, r.served_from) for r in served.where("value IS NOT NULL").collect()) == [
        ("a", "1", "hot"), ("b", "2", "warm"), ("b", "2", "warm")]
    assert served.where("served_from = 'none'").count() == 1
    assert [tuple(r) for r in O.write_back_rows(served).collect()] == [("b", "f", "2")]


def test_history(spark):
    rows = feature_rows(spark.createDataFrame(
        [("avg_tokens", "user_123", 100.0 + 10 * i, START - timedelta(days=i)) for i in range(10)],
        "feature_name string, entity_id string, value double, timestamp timestamp_ntz"))
    got = O.feature_history(rows, "user_123", "avg_tokens", START.date(), 5).collect()
    assert [r.value for r in got] == ["150.0", "140.0", "130.0", "120.0", "110.0", "100.0"]
    assert O.feature_history(rows, "nobody", "avg_tokens", START.date(), 5).collect() == []
    latest = O.latest_feature_values(rows).first()
    assert latest.value == "100.0" and latest.version == 1


@pytest.mark.parametrize("rows_per_cut", [20, 10**6])
def test_rolling_against_brute_force(make_calls, rows_per_cut):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        seconds = float(rng.integers(0, 20 * 86400))
        rows.append({"user_id": "hot" if i % 3 else f"u{i % 4}", "timestamp": at(seconds),
                     "prompt": "x" * int(rng.integers(1, 30)), "cost_usd": float(rng.integers(0, 1000)) / 1e6})
    # Exactly seven days later is inside, one microsecond more is not.
    rows += [{"user_id": "edge", "timestamp": at(s), "prompt": "ab"} for s in (5, 5 + 7 * 86400, 5.000001 + 7 * 86400)]
    rows += [{"user_id": "tie", "timestamp": at(7)}] * 2
    got = {(r.user_id, r.timestamp): r for r in O.rolling_features(make_calls(rows), rows_per_cut=rows_per_cut).collect()}
    assert len(got) == len({(r["user_id"], r["timestamp"]) for r in rows})
    for (user, moment), r in got.items():
        near = [x for x in rows if x["user_id"] == user and moment - timedelta(days=7) <= x["timestamp"] <= moment]
        assert r.interaction_count_7d == len(near)
        assert r.avg_prompt_length_7d == pytest.approx(np.mean([len(x.get("prompt", "p")) for x in near]))
        assert r.total_cost_7d == pytest.approx(sum(x.get("cost_usd", 0.01) for x in near), abs=1e-9)


def test_materialized_rows(make_calls):
    features, online = O.materialize_features(make_calls([{"user_id": "a", "cost_usd": 0.5}]), START)
    kinds = {r.feature_name: (r.value, r.feature_type) for r in features.collect()}
    assert kinds["total_cost"] == ("0.5", "cost") and kinds["interaction_count"] == ("1", "numeric")
    assert {(r.expires_at - r.written_at).total_seconds() for r in online.collect()} == {300.0}


def test_view_has_every_entity(make_calls):
    rows = make_calls([{"user_id": "a"}, {"user_id": "b"}])
    view = O.offline_feature_view(rows, ["a", "b"], "2024-01-01", name="train")
    assert view.count() == 2
    assert rows.sparkSession.table("train").where(F.col("interaction_count_7d") == 1).count() == 2


def test_view_does_not_see_past_its_end(make_calls):
    day = timedelta(days=1)
    rows = [{"user_id": u, "timestamp": START + i * day, "date": (START + i * day).date(), "cost_usd": float(2**i)}
            for u in ("a", "b") for i in range(12)]
    calls = make_calls(rows)
    end, start = (START + 6 * day).date(), (START + 2 * day).date()
    got = O.offline_feature_view(calls, ["a"], str(start), str(end)).collect()
    want = O.offline_feature_view(calls.where(F.col("date") <= F.lit(end)), ["a"], str(start)).collect()
    assert got == want and len(got) == 1 and got[0].interaction_count == 5
    assert got[0].total_cost_7d == sum(2.0**i for i in range(7))


def test_a_query_views_the_features_of_all_users(spark, folder):
    from meterlake.plans.catalog import load_all

    catalog = load_all()
    users = {r.entity_id for r in catalog["O10_offline_feature_view_of_all"].run(spark, folder).collect()}
    calls = spark.read.parquet(f"{folder}/events.parquet")
    listed = {r.entity_id for r in catalog["O10_offline_feature_view"].run(spark, folder).collect()}
    assert listed < users and len(users) > 0.5 * calls.select("user_id").distinct().count()


def _brute_point_in_time(labels, features):
    out = {}
    for label in labels:
        past = [f for f in features if f[0] is not None and f[0] == label[1] and label[2] is not None and f[1] <= label[2]]
        out[label[0]] = max(past, key=lambda f: f[1])[2] if past else None
    return out


@pytest.mark.parametrize("rows_per_cut", [1, 10**9])
def test_point_in_time_never_looks_ahead(spark, rows_per_cut):
    rng = np.random.default_rng(4)
    base = datetime(2024, 1, 1)
    # One user holds half of all rows; some labels fall exactly on a feature's time.
    who = lambda: "hot" if rng.random() < 0.5 else [None, "a", "b", "never"][rng.integers(4)]
    labels = [(i, who(), base + timedelta(seconds=int(rng.integers(0, 500))) if i % 17 else None) for i in range(600)]
    moments = {(who(), base + timedelta(seconds=int(rng.integers(100, 400)))) for _ in range(300)}
    features = [(u, t, float(i)) for i, (u, t) in enumerate(sorted(moments, key=str)) if u != "never"]
    left = spark.createDataFrame(labels, "id long, entity_id string, label_time timestamp_ntz")
    right = spark.createDataFrame(features, "entity_id string, timestamp timestamp_ntz, x double")
    rows = O.point_in_time(left, right, rows_per_cut=rows_per_cut).collect()
    assert {r.id: r.x for r in rows} == _brute_point_in_time(labels, features) and len(rows) == len(labels)
    assert all(r.feature_time is None or r.feature_time <= r.label_time for r in rows)
    again = O.point_in_time(left, right.unionByName(right), rows_per_cut=rows_per_cut)
    assert sorted(r.x or -1 for r in again.collect()) == sorted(r.x or -1 for r in rows)
    assert O.point_in_time(left.limit(0), right).count() == 0
    assert {r.x for r in O.point_in_time(left, right.limit(0)).collect()} == {None}
    with pytest.raises(ValueError):
        O.point_in_time(left, right.withColumnRenamed("x", "id"))
