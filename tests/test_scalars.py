import hashlib
import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterlake.functions import filters, scalars as S
from meterlake.functions.keyed import checked_broadcast
from meterlake.operators.pricing import estimate_cost
from meterlake.schemas import price_table

TEXTS = ["", " ", "one", " two  words ", "a\tb\nc\r\nd", "tab\x0bvt\x0cff", "no break em　ideo\x1cfs\x85nel",
         "café naïve 日本", "emoji \U0001f600 end\U0001f680", 'quote " back \\ slash /', "​zero width"]


def column(spark, texts, expr):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", expr.alias("v")).orderBy("i").collect()]


def test_token_count_is_python_split(spark):
    assert column(spark, TEXTS, S.whitespace_token_count("t")) == [len(t.split()) for t in TEXTS]


def test_blank_is_python_strip(spark):
    assert column(spark, TEXTS, S.is_blank("t")) == [t.strip() == "" for t in TEXTS]


def test_cache_key_is_hash_of_json(spark):
    want = [
        "embedding:" + hashlib.sha256(json.dumps([t, "mü"]).encode()).hexdigest()[:16] for t in TEXTS
        if not set(t) & set("\x0b\x1c\x85")
    ]
    texts = [t for t in TEXTS if not set(t) & set("\x0b\x1c\x85")]
    assert column(spark, texts, S.cache_key("embedding", "t", F.lit("mü"))) == want


def test_keys_separate_parts(spark):
    rows = spark.createDataFrame([("a", "b"), ("ab", ""), ("a, b", ""), (None, "b")], "a string, b string")
    keys = {r.k for r in rows.select(S.cache_key("p", "a", "b").alias("k")).collect()}
    assert len(keys) == 4


@pytest.mark.parametrize("cost,tokens,want", [(0.0024, 20, 0.00012), (1.0, 0, 0.0), (0.0, 10, 0.0)])
def test_cost_per_token(spark, cost, tokens, want):
    row = spark.createDataFrame([(cost, tokens)], "cost_usd double, total_tokens int")
    assert row.select(S.cost_per_token()).first()[0] == pytest.approx(want)


@pytest.mark.parametrize("hist,cur,want", [
    (100.0, 120.0, 20.0), (100.0, 80.0, -20.0), (0.0, 5.0, None), (5.0, 0.0, None), (None, 5.0, None), (5.0, None, None)])
def test_mean_change_percent(spark, hist, cur, want):
    row = spark.createDataFrame([(hist, cur)], "historical_mean double, current_mean double")
    got = row.select(S.mean_change_percent()).first()[0]
    assert got == (None if want is None else pytest.approx(want))


def test_prices(spark):
    rows = spark.createDataFrame(
        [("gpt-4", 100, 50), ("gpt-3.5-turbo", 100, 50), ("unknown", 100, 50), (None, 1, 1)],
        "model string, input_tokens int, output_tokens int")
    got = {r.model: r.cost_usd for r in estimate_cost(rows).collect()}
    assert got["gpt-4"] == pytest.approx(0.006)
    assert got["gpt-3.5-turbo"] == pytest.approx(0.00025)
    assert got["unknown"] == 0.0 and got[None] == 0.0
    own = estimate_cost(rows, price_table(spark, [("unknown", 1.0, 2.0)]))
    assert {r.model: r.cost_usd for r in own.collect()}["unknown"] == pytest.approx(0.2)


def test_micros_round_trip(spark):
    times = [datetime(2024, 2, 29, 23, 59, 59, 999999), datetime(1969, 12, 31, 23, 59, 59, 1), datetime(1970, 1, 1)]
    rows = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = rows.select("t", S.micros("t").alias("m"), S.from_micros(S.micros("t")).alias("back")).collect()
    epoch = datetime(1970, 1, 1)
    for r in got:
        delta = r.t - epoch
        assert r.m == (delta.days * 86400 + delta.seconds) * 10**6 + delta.microseconds
        assert r.back == r.t


def test_parse_numeric(spark):
    values = ["1.5", "-2", "NaN", "Infinity", "-Infinity", "abc", "", None, "1e3"]
    assert column(spark, values, S.parse_numeric("t")) == [1.5, -2.0, None, None, None, None, None, None, 1000.0]


@pytest.mark.parametrize("pattern,key,hit", [
    ("test:user:*", "test:user:1:feature", True), ("test:user:?", "test:user:12", False),
    ("h[ae]llo", "hello", True), ("h[^e]llo", "hello", False), ("h[a-c]llo", "hbllo", True),
    ("a.c*", "abc", False), ("a\\*b", "a*b", True), ("a\\*b", "axb", False), ("x*y", "x\ny", True), ("abc", "abcd", False)])
def test_glob(pattern, key, hit):
    regex = S.glob_to_regex(pattern).replace("\\z", "\\Z")
    assert bool(re.match(regex, key)) is hit


@pytest.mark.parametrize("days", [0, -5])
def test_lookback_must_be_positive(days):
    with pytest.raises(ValueError):
        filters.check_lookback(days)


def test_long_lookback_warns():
    with pytest.warns(UserWarning):
        assert filters.check_lookback(366) == 366


def test_trailing_days_boundary(make_calls):
    rows = make_calls([{"timestamp": datetime(2024, 1, d)} for d in (1, 2, 3)] + [{"timestamp": datetime(2024, 3, 1)}])
    kept = filters.trailing_days(rows, "2024-01-09", 7).select("date").collect()
    # Exactly seven days before counts, and the future has no bound.
    assert sorted(str(r.date) for r in kept) == ["2024-01-02", "2024-01-03", "2024-03-01"]


def test_entity_lists(make_calls, spark):
    rows = make_calls([{"user_id": f"u{i}"} for i in range(500)])
    assert filters.entity_in(rows, []).count() == 500
    assert filters.entity_in(rows, None).count() == 500
    assert filters.entity_in(rows, ["u3", "nobody"]).count() == 1
    assert filters.entity_in(rows, [f"u{i}" for i in range(300)]).count() == 300
    listed = spark.createDataFrame([("u1",), ("u1",), ("u2",)], "id string")
    assert filters.entity_in(rows, listed).count() == 2


def test_broadcast_only_below_the_bound(spark):
    small, big = spark.range(10), spark.range(11)
    hinted = lambda df: "broadcast" in checked_broadcast(df, 10)._jdf.queryExecution().logical().toString()
    assert hinted(small) and not hinted(big)
