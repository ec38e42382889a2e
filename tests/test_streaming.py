"""Streams over files, run to their end, against the batch operators."""

import contextlib
import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from meterlake.operators import features as O
from meterlake.sources.interactions import as_messages, stream_interactions
from meterlake.sources.online import read_online, stored_entries
from meterlake.streaming import jobs as J
from meterlake.streaming import windows as T
from meterlake.streaming.sessions import OpenSessions, open_sessions, publish_sessions

START = datetime(2024, 1, 1)
RAW = ["interaction_id", "user_id", "session_id", "model", "provider", "prompt", "response", "input_tokens",
       "output_tokens", "latency_ms", "cost_usd", "timestamp", "metadata"]


@pytest.fixture
def calls(make_calls):
    rng = np.random.default_rng(9)
    return make_calls([
        {"user_id": "hot" if i % 2 else f"u{i % 5}", "model": f"m{i % 3}", "cost_usd": (i % 10) / 1000,
         "timestamp": START + timedelta(seconds=float(np.round(rng.random() * 20_000, 3)))} for i in range(400)])


def send(calls, folder):
    as_messages(calls, RAW).select("value").coalesce(2).write.mode("append").text(str(folder))


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


@pytest.fixture
def ingest(spark, tmp_path):
    """Take in what is in the folder `in`; gives the facts."""

    def run(checkpoint="cp", seen=None, known=None, **options):
        facts, work = str(tmp_path / "facts"), str(tmp_path / checkpoint)
        if known is not None:
            J.seed_known_ids(known, work, facts)
        messages = stream_interactions(spark, source="files", path=str(tmp_path / "in"), **options)
        J.ingest(messages, facts, work, None if seen is None else lambda rows, batch: seen.append(rows.count()))
        return J.read_facts(spark, facts)

    return run


def test_ingest_is_idempotent(spark, calls, ingest, tmp_path):
    seen = []
    send(calls, tmp_path / "in")
    (tmp_path / "in" / "bad.txt").write_text("{broken\n")
    rows = ingest(seen=seen, maxFilesPerTrigger=1)
    assert rows.count() == 400 and sum(seen) == 400
    dead = J.dead_letters(spark, str(tmp_path / "cp")).collect()
    assert [(r.value, r.reject_reasons) for r in dead] == [("{broken", ["malformed_json"])]
    # The same ids again, in the same run.
    send(calls.where("user_id = 'hot'"), tmp_path / "in")
    ingest(seen=seen)
    assert sum(seen) == 400
    rows = ingest()
    assert rows.count() == 400 and rows.select("interaction_id").distinct().count() == 400
    assert rows.exceptAll(calls.select(*rows.columns)).count() == 0


def test_a_batch_that_is_run_again_changes_nothing(spark, calls, ingest, tmp_path):
    send(calls, tmp_path / "in")
    before = sorted(r.interaction_id for r in ingest().collect())
    for step in ("decode", "facts"):
        commits = tmp_path / "cp" / step / "commits"
        last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
        os.remove(commits / last)
        with contextlib.suppress(FileNotFoundError):
            os.remove(commits / f".{last}.crc")
    assert sorted(r.interaction_id for r in ingest().collect()) == before


def test_a_new_checkpoint_starts_from_the_ids_of_the_facts(spark, calls, ingest, tmp_path):
    old, new = calls.where("model = 'm0'"), calls.where("model = 'm1'")
    send(old, tmp_path / "in")
    facts = ingest("first")
    # Everything is sent again to another run, which knows the facts' ids once and for all.
    send(new, tmp_path / "in")
    rows = ingest("second", known=facts)
    assert rows.count() == old.count() + new.count() == rows.select("interaction_id").distinct().count()
    send(calls, tmp_path / "in")
    assert ingest("second").count() == 400


def test_a_batch_costs_what_it_holds(spark, make_calls, tmp_path):
    work, facts = str(tmp_path / "work"), str(tmp_path / "facts")
    took = []
    for batch in range(10):
        # Half new rows, half repeats of all times; days go backwards, so that rows are late.
        rows = [{"interaction_id": f"i{batch * 50 + i if i % 2 else (i * 7) % (batch * 50 + 1)}",
                 "timestamp": START - timedelta(days=batch, seconds=i)} for i in range(100)]
        send(make_calls(rows), tmp_path / "in")
        J.landed(J.start_decoding(stream_interactions(spark, source="files", path=str(tmp_path / "in")), work))
        query = J.start_facts(spark, work, facts)
        J.landed(query)
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        # Only the batch is read: neither the facts nor earlier batches.
        assert sum(p["numInputRows"] for p in progress) == 100
        took.append(progress[-1]["stateOperators"][0]["numRowsTotal"])
    stored = J.read_facts(spark, facts)
    n = stored.count()
    assert n == stored.select("interaction_id").distinct().count() == took[-1] and took == sorted(took)
    assert stored.select("date").distinct().count() >= 10


def read_stream(spark, calls, folder):
    calls.coalesce(1).write.parquet(str(folder))
    return spark.readStream.schema(calls.schema).parquet(str(folder))


@pytest.mark.parametrize("metric", [
    T.interactions_per_second_by_model, T.cost_1h_by_model, T.cost_24h, T.tokens_per_second_by_model])
def test_windows_agree_with_batch(spark, calls, tmp_path, metric):
    stream = T.with_event_time(read_stream(spark, calls, tmp_path / "in"), "10 minutes")
    finish(J.start_metric(metric(stream), str(tmp_path / "out"), str(tmp_path / "cp")))
    got = spark.read.schema(metric(calls).schema).parquet(str(tmp_path / "out"))
    end = calls.agg(F.max("timestamp")).first()[0] - timedelta(minutes=10)
    # Windows that end at or before the watermark are final.
    want = metric(calls).where(F.col("window_end") <= F.lit(end).cast("timestamp_ntz"))
    names = [c for c in want.columns if c not in ("total_cost", "per_second")]
    cost = [F.round(c, 9) for c in want.columns if c not in names]
    assert got.count() == want.count() and (want.count() > 0 or metric is T.cost_24h)
    assert got.select(*names, *cost).exceptAll(want.select(*names, *cost)).count() == 0


def test_stream_sessions_split_at_the_gap(spark, make_calls, tmp_path):
    calls = make_calls([{"timestamp": START + timedelta(microseconds=us)} for us in
                        (0, 299_999_999, 599_999_999, 10**10, 10**11)])
    stream = T.with_event_time(read_stream(spark, calls, tmp_path / "in"), "1 minute")
    finish(J.start_metric(T.sessionized_online_features(stream), str(tmp_path / "out"), str(tmp_path / "cp")))
    got = sorted((r.last_interaction_time, r.interaction_count) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted((r.last_interaction_time, r.interaction_count) for r in O.activity_sessions(calls).collect())
    assert got == want[:-1] and [n for _, n in got] == [2, 1, 1]


def test_online_stream_equals_batch(spark, calls, tmp_path):
    online = str(tmp_path / "online")
    # Repeats within the watermark delay are counted once.
    twice = calls.unionByName(calls.where("model = 'm0'"))
    stream = read_stream(spark, twice, tmp_path / "in")
    finish(J.start_online_features(stream, online, str(tmp_path / "cp")))
    entries = stored_entries(spark, online).where("feature_name IN ('interaction_count', 'last_model')")
    got = {(r.entity_id, r.feature_name): r.value for r in entries.collect()}
    for r in O.online_features_lifetime(calls).collect():
        assert got[r.user_id, "interaction_count"] == str(r.interaction_count)
        assert got[r.user_id, "last_model"] == r.last_model


def test_drift_bands(spark):
    rows = spark.createDataFrame([(0.05,), (0.07,)], "drift_score double")
    assert T.drift_score_total(rows).first().band == "yellow"
    assert T.drift_score_total(rows.where("false")).first().drift_score_total == 0.0


def test_open_sessions_are_what_a_batch_sees_at_any_time(spark, make_calls, tmp_path):
    rng = np.random.default_rng(12)
    events = [{"interaction_id": f"i{i:04}", "user_id": "hot" if i % 2 else f"u{i % 7}", "model": f"m{i % 3}", "cost_usd": (i % 10) / 1000,
               "timestamp": START + timedelta(seconds=i * 20 + int(rng.integers(-90, 90)))} for i in range(240)]
    # Exactly the gap, a microsecond less, and a late call that puts two sessions together.
    gaps = [0, 300_000_000, 599_999_999, 1_199_999_998, 1_700_000_000]
    events += [{"interaction_id": f"g{k}", "user_id": "gap", "timestamp": START + timedelta(microseconds=us)} for k, us in enumerate(gaps)]
    late = {"interaction_id": "late", "user_id": "gap", "timestamp": START + timedelta(microseconds=1_450_000_000)}
    events.sort(key=lambda e: e["timestamp"])
    parts = [events[i : i + 60] for i in range(0, len(events), 60)]
    parts[-1].append(late)
    seen, online = [], str(tmp_path / "online")
    for part in parts:
        seen += part
        make_calls(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(make_calls(part).schema).parquet(str(tmp_path / "in"))
        changes = open_sessions(T.with_event_time(stream, "1 hour"))
        finish(publish_sessions(changes, online, str(tmp_path / "cp")))
        newest = max(e["timestamp"] for e in seen)
        for moment in (newest, newest + timedelta(seconds=150), newest + timedelta(seconds=299.999999), newest + timedelta(seconds=300)):
            want = O.online_features_ttl(make_calls(seen), moment).collect()
            got = {(r.entity_id, r.feature_name): r.value for r in read_online(spark, online, moment).collect()}
            assert {k[0] for k in got} == {r.user_id for r in want} and len(got) == 6 * len(want)
            for r in want:
                assert got[r.user_id, "interaction_count"] == str(r.interaction_count)
                assert got[r.user_id, "total_tokens"] == str(r.total_tokens)
                assert got[r.user_id, "last_model"] == r.last_model
                assert float(got[r.user_id, "total_cost"]) == pytest.approx(r.total_cost)
                assert float(got[r.user_id, "avg_latency"]) == pytest.approx(r.avg_latency)


def test_timers_end_the_state_of_expired_sessions(spark, make_calls, tmp_path):
    rows = [{"interaction_id": "a", "user_id": "a", "timestamp": START}]
    later = [{"interaction_id": "b", "user_id": "b", "timestamp": START + timedelta(hours=2)}]
    changes = []
    for part in (rows, later, [{**later[0], "interaction_id": "c", "timestamp": START + timedelta(hours=2, seconds=1)}]):
        make_calls(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(make_calls(part).schema).parquet(str(tmp_path / "in"))
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", J.ROCKS_DB)
        writer = open_sessions(T.with_event_time(stream, "1 minute")).writeStream.outputMode("update")
        writer = writer.foreachBatch(lambda batch, n: changes.extend((r.user_id, r.expired, r.interaction_count) for r in batch.collect()))
        finish(writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    assert changes == [("a", False, 1), ("b", False, 1), ("a", True, 1), ("b", False, 2)] or changes == [
        ("a", False, 1), ("a", True, 1), ("b", False, 1), ("b", False, 2)]


class StateCalls:
    """A processor's handle that counts its calls, each a way to the task's JVM and back."""

    def __init__(self):
        self.rows, self.timers, self.n = [], [], 0

    def getListState(self, name, schema):
        return self

    def exists(self):
        self.n += 1
        return bool(self.rows)

    def get(self):
        self.n += 1
        return iter(list(self.rows))

    def put(self, rows):
        self.n, self.rows = self.n + 1, rows

    def listTimers(self):
        self.n += 1
        return iter(list(self.timers))

    def registerTimer(self, at):
        self.n, self.timers = self.n + 1, [*self.timers, at]

    def deleteTimer(self, at):
        self.n, self.timers = self.n + 1, [t for t in self.timers if t != at]

    def getCurrentWatermarkInMs(self):
        return 0


def test_a_user_of_a_batch_costs_few_calls_to_the_state():
    handle, sessions = StateCalls(), OpenSessions(300)
    sessions.init(handle)

    def give(*seconds):
        handle.n = 0
        rows = iter([Row(call={"at": s * 10**6, "cost": 1.0, "tokens": 2, "latency": None, "id": f"i{s}", "model": "m"}) for s in seconds])
        return [(r.calls, r.tokens, r.cost) for r in sessions.handleInputRows(("u",), rows, handle)], handle.n

    assert give(1000, 1100) == ([(2, 4, 2.0)], 3) and handle.timers == [1_400_000]
    assert give(1050) == ([(3, 6, 3.0)], 2) and handle.timers == [1_400_000]
    assert give(1500) == ([(1, 2, 1.0)], 4) and handle.timers == [1_800_000]


def test_sketch_panes_keep_their_rank_error(spark, make_calls):
    base = make_calls([{"interaction_id": "i", "timestamp": START}])
    many = spark.range(300_000).select(
        F.col("id"), F.pmod(F.xxhash64("id"), F.lit(10**6)).cast("double").alias("latency_ms"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.pmod("id", F.lit(600)).cast("decimal(18, 6)"))).alias("timestamp"))
    rows = base.limit(1).drop("latency_ms", "timestamp").crossJoin(F.broadcast(many)).withColumn("operation", F.lit("chat"))
    sketched = {r.window_start: r for r in T.latency_p95_p99_panes(rows).collect()}
    values = many.select(F.col("latency_ms").alias("v"), F.col("timestamp").alias("t")).toPandas()
    assert len(sketched) == 14
    for start, r in sketched.items():
        inside = np.sort(values.v[(values.t >= start) & (values.t < start + timedelta(minutes=5))].to_numpy())
        assert r.calls == len(inside)
        for q, got in ((0.95, r.p95), (0.99, r.p99)):
            low, high = np.searchsorted(inside, got, "left") / len(inside), np.searchsorted(inside, got, "right") / len(inside)
            assert low - 1.5 * T.KLL_ERROR <= q <= high + 1.5 * T.KLL_ERROR
    # Few values are exact.
    few = rows.where("id < 400")
    exact = T.latency_p95_p99(few).select(*T.latency_p95_p99_panes(few).columns)
    assert exact.exceptAll(T.latency_p95_p99_panes(few)).count() == 0 < exact.count()
