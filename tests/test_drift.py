import itertools
import math
from datetime import datetime
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import drift as D

RNG = np.random.default_rng(7)
CASES = {
    "same": (RNG.normal(100, 10, 500), RNG.normal(100, 10, 400)),
    "shifted": (RNG.normal(100, 10, 500), RNG.normal(110, 12, 300)),
    "far": (RNG.normal(100, 10, 300), RNG.normal(150, 20, 300)),
    "constant": (np.full(50, 5.0), np.full(30, 5.0)),
    "constant_moved": (np.full(50, 5.0), np.full(30, 6.0)),
    "ties": (RNG.integers(0, 4, 300).astype(float), RNG.integers(0, 5, 200).astype(float)),
    "disjoint": (RNG.random(40), RNG.random(60) + 10),
    "one_value": (np.array([3.0]), np.array([4.0])),
    "one_current": (RNG.random(100), np.array([0.5])),
    "negative": (RNG.normal(-5, 1, 333), RNG.normal(-5, 2, 77)),
}
SCHEMA = "feature_name string, entity_id string, side string, value double"


def frame(spark, cases):
    rows = [(name, "all", side, float(v)) for name, pair in cases.items()
            for side, values in zip((D.HISTORICAL, D.CURRENT), pair) for v in values]
    return spark.createDataFrame(rows, SCHEMA)


def numpy_psi(expected, actual):
    edges = np.percentile(expected, np.linspace(0, 100, 11))
    inner = edges[1:-1]
    score = 0.0
    e = np.bincount(np.searchsorted(inner, expected, side="right"), minlength=10) / len(expected)
    a = np.bincount(np.searchsorted(inner, actual, side="right"), minlength=10) / len(actual)
    for x, y in zip(np.where(e == 0, 1e-4, e), np.where(a == 0, 1e-4, a)):
        score += (y - x) * math.log(y / x)
    return score


def numpy_ks(a, b):
    grid = np.sort(np.concatenate([a, b]))
    cdf = lambda s: np.searchsorted(np.sort(s), grid, side="right") / len(s)
    return np.abs(cdf(a) - cdf(b)).max()


@pytest.mark.parametrize("rows_per_cut", [15, 10**6])
def test_statistics_against_numpy(spark, rows_per_cut):
    got = {r.feature_name: r for r in D.drift_statistics(frame(spark, CASES), rows_per_cut=rows_per_cut).collect()}
    assert set(got) == set(CASES)
    for name, (hist, cur) in CASES.items():
        row = got[name]
        assert row.psi == pytest.approx(numpy_psi(hist, cur), abs=1e-9), name
        assert row.ks_statistic == pytest.approx(numpy_ks(hist, cur), abs=1e-12), name
        assert row.mean_hist == pytest.approx(hist.mean()) and row.mean_cur == pytest.approx(cur.mean())
        assert row.std_hist == pytest.approx(hist.std(), abs=1e-9) and row.std_cur == pytest.approx(cur.std(), abs=1e-9)


def test_exact_pvalue_against_all_orders():
    for n1, n2 in [(1, 1), (2, 3), (3, 3), (4, 2), (5, 4)]:
        distances = []
        for chosen in itertools.combinations(range(n1 + n2), n1):
            a = np.array(chosen, dtype=float)
            b = np.array([i for i in range(n1 + n2) if i not in chosen], dtype=float)
            distances.append(numpy_ks(a, b))
        for d in sorted(set(np.round(distances, 12))):
            want = np.mean([x >= d - 1e-9 for x in distances])
            assert D.exact_ks_pvalue(d, n1, n2) == pytest.approx(want, abs=1e-12)
    assert D.exact_ks_pvalue(0.0, 5, 7) == 1.0
    assert 0 < D.exact_ks_pvalue(1.0, 300, 300) < 1e-100


def test_asymptotic_table_values(spark):
    # Published limits: the tail is 0.05 at 1.3581, 0.10 at 1.2238, 0.01 at 1.6276.
    n = 10**6
    rows = spark.createDataFrame([(x / math.sqrt(n / 2), n, n, p) for x, p in
                                  ((1.3581, 0.05), (1.2238, 0.10), (1.6276, 0.01), (0.0, 1.0), (0.1, 1.0), (20.0, 0.0))],
                                 "ks_statistic double, n_hist long, n_cur long, want double")
    for r in D.with_pvalue(rows).collect():
        assert r.ks_method == "asymptotic" and r.ks_pvalue == pytest.approx(r.want, abs=5e-5)


def test_large_counts_do_not_overflow(spark):
    rows = spark.createDataFrame([(1e-6, 10**11, 10**11)], "ks_statistic double, n_hist long, n_cur long")
    assert 0 <= D.with_pvalue(rows, exact=False).first().ks_pvalue <= 1


def test_methods_agree_for_middle_sizes(spark):
    rows = spark.createDataFrame([(0.05, 2000, 3000)], "ks_statistic double, n_hist long, n_cur long")
    exact, limit = D.with_pvalue(rows, exact=True).first(), D.with_pvalue(rows).first()
    assert exact.ks_method == "exact" and exact.ks_pvalue == pytest.approx(limit.ks_pvalue, abs=0.002)


@pytest.mark.parametrize("score,want", [
    (0.0, "no_drift"), (0.1, "no_drift"), (0.1000001, "warning"), (0.2, "warning"), (0.2000001, "critical")])
def test_status_is_strict(spark, score, want):
    assert spark.range(1).select(D.drift_status(F.lit(score))).first()[0] == want


def test_check_rows(spark):
    lonely = {"no_current": (np.array([1.0, 2.0]), np.array([])), "no_history": (np.array([]), np.array([1.0]))}
    result = D.check_drift(frame(spark, {**CASES, **lonely}), "2024-01-31")
    got = {r.feature_name: r for r in result.collect()}
    assert got["far"].drift_status == "critical" and got["far"].drift_detected
    assert got["far"].mean_change_percent == pytest.approx(
        (CASES["far"][1].mean() - CASES["far"][0].mean()) / CASES["far"][0].mean() * 100)
    assert got["far"].details["method"] == "PSI + KS Test" and float(got["far"].details["ks_pvalue"]) < 1e-6
    assert got["far"].window_start == datetime(2024, 1, 24)
    for name in lonely:
        assert got[name].drift_status == "no_drift" and got[name].drift_score == 0.0
        assert got[name].details == {"method": "insufficient data"}
    alerts = {r.feature_name for r in D.drift_alerts(result).collect()}
    assert "far" in alerts and "same" not in alerts


def test_nulls_and_nan_are_left_out(spark):
    rows = frame(spark, {"x": (np.array([1.0, 2.0, 3.0]), np.array([2.0, 3.0]))})
    dirty = rows.union(spark.createDataFrame(
        [("x", "all", D.HISTORICAL, None), ("x", "all", D.CURRENT, float("nan"))], SCHEMA))
    assert D.drift_statistics(dirty).first() == D.drift_statistics(rows).first()


def test_history_split_and_unparsed(spark):
    rows = spark.createDataFrame(
        [("f", "e", v, datetime(2024, 1, d).date()) for v, d in (("1", 24), ("2", 23), ("bad", 25), ("NaN", 25), (None, 25))],
        "feature_name string, entity_id string, value string, date date")
    got = {(r.side, r.value) for r in D.samples_from_features(rows, "2024-01-31").collect()}
    # Exactly seven days before is current.
    assert got == {(D.CURRENT, 1.0), (D.HISTORICAL, 2.0)}
    assert D.unparsed_values(rows).first().unparsed == 2


def test_control_limits(spark):
    rows = frame(spark, {"x": (np.array([0.0, 2.0] * 10), np.array([3.9, 4.1, -2.1, 0.0]))})
    limits = D.spc_limits(rows).first()
    assert (limits.center, limits.sigma, limits.lower_limit, limits.upper_limit) == (1.0, 1.0, -2.0, 4.0)
    assert sorted(r.value for r in D.spc_violations(rows).collect()) == [-2.1, 4.1]


def test_null_entities_are_a_key(spark):
    rows = [("f", None if i % 2 else "e", D.HISTORICAL if i < 300 else D.CURRENT, float(i % 97)) for i in range(600)]
    samples = spark.createDataFrame(rows, "feature_name string, entity_id string, side string, value double")
    got = {r.entity_id: r for r in D.check_drift(samples, "2024-01-31").collect()}
    assert set(got) == {None, "e"} and all(r.details["method"] == "PSI + KS Test" for r in got.values())
    assert all(r.details["ks_method"] == "asymptotic" for r in got.values())


def test_a_sweep_from_counts_reads_the_new_day_only(spark, make_calls, tmp_path):
    rng = np.random.default_rng(6)
    rows = [{"timestamp": datetime(2024, 1, 1 + i % 20, 3), "latency_ms": float(rng.choice([1.5, 2.0, 7.25, float(i % 13)])),
             "input_tokens": int(rng.integers(0, 9)), "model": f"m{i % 3}"} for i in range(400)]
    calls, root, facts = make_calls(rows), str(tmp_path / "counts"), str(tmp_path / "facts")
    names = ["latency_ms", "input_tokens"]
    calls.where("date < DATE '2024-01-20'").write.partitionBy("date").parquet(facts)
    read = lambda: spark.read.schema(calls.schema).parquet(facts)
    D.refresh_daily_counts(read(), root, names, "model")
    calls.where("date = DATE '2024-01-20'").write.mode("append").partitionBy("date").parquet(facts)
    new = read().where("date = DATE '2024-01-20'")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    before = {p: p.stat().st_mtime for p in (tmp_path / "counts").glob("date=*/*.parquet")}
    D.refresh_daily_counts(new, root, names, "model")
    assert all(p.exists() and p.stat().st_mtime == t for p, t in before.items())
    flat = lambda df: sorted(tuple(str(round(x, 9) if isinstance(x, float) else x) for x in r) for r in df.drop("details").collect())
    swept = D.drift_from_counts(spark, root, "2024-01-21")
    assert flat(swept) == flat(D.drift_sweep(calls, names, "2024-01-21", entity="model")) and swept.count() == 6
    scans = [line for line in swept._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert scans and all("latency_ms" not in line and "feature_name" in line for line in scans)


@pytest.mark.parametrize("share", [1.0, 3e6])
def test_means_do_not_depend_on_the_order_of_their_sum(spark, share):
    # Doubles lose the small values beside the large ones in every order but those that add the large ones first.
    small = np.random.default_rng(7).integers(1, 9999, 200) / 10 / share
    values = [*small.tolist(), 2.0**58, -(2.0**58)]
    odd = [1e-30, 1 / 3, 1e25, -1e25]  # out of the range of the exact sum
    rows = [("k", "all", side, v) for side in (D.HISTORICAL, D.CURRENT) for v in values]
    rows += [("odd", "all", side, v) for side in (D.HISTORICAL, D.CURRENT) for v in odd]
    got = D.drift_statistics(spark.createDataFrame(rows, SCHEMA), rows_per_cut=15).collect()
    means = {r.feature_name: (r.mean_hist, r.mean_cur) for r in got}
    assert abs(means["odd"][0]) < 1e10
    exact = float(sum(map(Fraction, values)) / len(values))
    assert means["k"] == (pytest.approx(exact, rel=3e-16), pytest.approx(exact, rel=3e-16))
