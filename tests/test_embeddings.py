from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import embeddings as E

NOW = datetime(2024, 1, 1)
SCHEMA = "request_id string, text string, model string, cache_ttl int, timestamp timestamp_ntz"


def requests(spark, texts, model="m", ttl=None, prefix="r"):
    return spark.createDataFrame([(f"{prefix}{i}", t, model, ttl, NOW) for i, t in enumerate(texts)], SCHEMA)


def counting(folder):
    """An embedder that leaves one file per text it is asked for."""
    def factory(model):
        def embed(texts):
            import uuid
            for t in texts:
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                    out.write(t)
            return np.array([[float(len(t)), float(len(model))] for t in texts])
        return embed
    return factory


def test_repeats_are_embedded_once_and_then_hit(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    cache = E.cache_table(spark, str(tmp_path / "cache"))
    texts = ["hot"] * 60 + [f"t{i}" for i in range(20)]
    first, _ = E.embed_requests(requests(spark, texts), cache, NOW, counting(seen))
    assert first.count() == 80 and first.where("cache_hit").count() == 0
    assert first.where("embedding IS NULL").count() == 0
    first.collect()
    assert len(list(seen.iterdir())) == 21
    later = NOW + timedelta(hours=1)
    second, _ = E.embed_requests(requests(spark, ["hot", "new"]), cache, later, counting(seen))
    assert {r.request_id: r.cache_hit for r in second.collect()} == {"r0": True, "r1": False}
    assert len(list(seen.iterdir())) == 22
    # A day after it was written the entry is gone.
    third, _ = E.embed_requests(requests(spark, ["hot"]), cache, NOW + timedelta(days=1), counting(seen))
    assert third.first().cache_hit is False and len(list(seen.iterdir())) == 23


def test_without_cache_nothing_hits(spark, tmp_path):
    cache = E.cache_table(spark, str(tmp_path / "cache"))
    E.embed_requests(requests(spark, ["a"]), cache, NOW)
    again, _ = E.embed_requests(requests(spark, ["a"]), cache, NOW, use_cache=False)
    assert again.first().cache_hit is False


def test_models_never_share(spark, tmp_path):
    cache = E.cache_table(spark, str(tmp_path / "cache"))
    both = requests(spark, ["same"], "one").union(requests(spark, ["same"], "two", prefix="s"))
    rows = E.embed_requests(both, cache, NOW)[0].collect()
    assert len(rows) == 2 and rows[0].embedding != rows[1].embedding


def test_request_ttl_wins(spark, tmp_path):
    cache = E.cache_table(spark, str(tmp_path / "cache"))
    E.embed_requests(requests(spark, ["a"], ttl=10), cache, NOW)
    lookup = lambda s: E.cache_lookup(requests(spark, ["a"]), cache.read(), NOW + timedelta(seconds=s)).first().cache_hit
    assert lookup(9) is True and lookup(10) is False


def test_refused_requests(spark, tmp_path):
    cache = E.cache_table(spark, str(tmp_path / "cache"))
    done, bad = E.embed_requests(requests(spark, ["ok", ""]), cache, NOW)
    assert [r.request_id for r in done.collect()] == ["r0"] and [r.request_id for r in bad.collect()] == ["r1"]
    nothing, _ = E.embed_requests(requests(spark, [""]), E.cache_table(spark, str(tmp_path / "other")), NOW)
    assert nothing.count() == 0


def test_default_embedder(spark):
    one, two = E.hash_embedder("m"), E.hash_embedder("n")
    vectors = one(["a b c", "c b a", "", "a b d"])
    assert vectors.shape == (4, 384) and np.allclose(np.linalg.norm(vectors, axis=1), 1)
    assert np.array_equal(vectors[0], vectors[1]) and not np.array_equal(vectors[0], vectors[3])
    assert not np.array_equal(vectors[0], two(["a b c"])[0])
    # A text whose words cancel still has a direction.
    assert np.isfinite(one(["x " * k for k in range(5)])).all()


def test_get_many_is_aligned(spark, tmp_path):
    cache = E.cache_table(spark, str(tmp_path / "cache"))
    E.embed_requests(requests(spark, ["t0", "t2", "t4"]), cache, NOW)
    asked = E.with_cache_key(spark.createDataFrame([(i, f"t{i}", "m") for i in range(5)], "position int, text string, model string"))
    rows = E.get_many(asked, cache.read(), NOW).orderBy("position").collect()
    assert [r.embedding is not None for r in rows] == [True, False, True, False, True]
    assert E.get_many(asked.where("false"), cache.read(), NOW).count() == 0


def test_metrics_count_repeats(spark):
    rows = spark.createDataFrame([(True,), (True,), (False,), (True,)], "cache_hit boolean")
    m = E.embedding_batch_metrics(rows, "m").first()
    assert (m.total_requests, m.cache_hits, m.cache_misses, m.cache_hit_rate) == (4, 3, 1, 0.75)
    assert m.cost_saved_usd == pytest.approx(0.0003)
    assert E.embedding_batch_metrics(rows.where("false")).first().cache_hit_rate == 0.0


def test_search_against_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 16)).astype(np.float32)
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    queries = rng.normal(size=(4, 16)).tolist()
    rows = E.vector_search(corpus.repartition(5), queries, 7).collect()
    for q, query in enumerate(queries):
        want = np.argsort(-(vectors.astype(float) @ np.array(query)), kind="stable")[:7]
        assert [r.vec_id for r in sorted((r for r in rows if r["query"] == q), key=lambda r: r["rank"])] == want.tolist()
    with pytest.raises(ValueError):
        E.vector_search(corpus, [], 3)


def test_top_k_of_a_hot_block(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "hot" if i % 4 else "cold", rng.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>")
    got = E.vector_top_k(vectors, E.centroids(vectors, "label"), 3, "label").collect()
    for label in ("hot", "cold"):
        mine = [(i, np.array(v, dtype=float)) for i, l, v in rows if l == label]
        center = np.mean([v for _, v in mine], axis=0)
        want = [i for i, v in sorted(mine, key=lambda m: -(m[1] @ center))[:3]]
        assert [r.vec_id for r in sorted((r for r in got if r.label == label), key=lambda r: r["rank"])] == want


def test_stats(spark):
    cache = spark.createDataFrame(
        [("k", "m", [1.0, 2.0], NOW, NOW + timedelta(days=1)), ("k", "m", [1.0, 2.0, 3.0], NOW + timedelta(1), NOW + timedelta(2)),
         ("old", "m", [1.0], NOW, NOW)],
        "cache_key string, model string, embedding array<float>, written_at timestamp_ntz, expires_at timestamp_ntz")
    stats = E.cache_stats(spark.createDataFrame([(True,)], "cache_hit boolean"), cache, NOW).first()
    assert (stats.entries, stats.bytes, stats.cache_hits) == (1, 12, 1)


def test_nearest_of_all_against_numpy(spark):
    rng = np.random.default_rng(4)
    corpus = [(i, rng.normal(size=6).round(2).tolist()) for i in range(300)] + [(300, None)]
    corpus.append((301, corpus[0][1]))
    probes = [(i, rng.normal(size=6).round(2).tolist()) for i in range(40)] + [(40, None)]
    got = E.nearest_of_all(
        spark.createDataFrame(corpus, "vec_id long, embedding array<double>"),
        spark.createDataFrame(probes, "probe_id long, probe array<double>"), 4, parts=3, blocks=5).collect()
    want = []
    for p, x in probes[:-1]:
        scored = sorted((-round(float(np.dot(x, v)), 7), i) for i, v in corpus if v is not None)[:4]
        want += [(p, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert sorted((r.probe_id, r["rank"], r.vec_id) for r in got) == sorted(w[:3] for w in want)


def test_nearest_of_all_deals_by_row_counts(spark, monkeypatch):
    monkeypatch.setattr(E, "PART_ROWS", 10)
    monkeypatch.setattr(E, "PROBE_ROWS", 3)
    vectors = np.random.default_rng(3).normal(size=(205, 4))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    probes = corpus.where("vec_id % 20 = 0").selectExpr("vec_id AS probe_id", "embedding AS probe")
    found = E.nearest_of_all(corpus, probes, 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ", 21)" in plan and ", 4)" in plan  # 205 rows by 10 and 11 probes by 3
    got = {}
    for r in found.orderBy("probe_id", "rank").collect():
        got.setdefault(r.probe_id, []).append(r.vec_id)
    assert got == {p: np.lexsort((np.arange(205), -np.round(vectors @ vectors[p], 7)))[:3].tolist() for p in range(0, 205, 20)}
    assert E.nearest_of_all(corpus.limit(0), probes, 3).count() == 0


def _above_scan(plan):
    """Operators from the bucketed scan up to the first join above it."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth, out = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            depth = own
            out.append(line.strip(" :+-"))
            if "Join" in line:
                return out
    raise AssertionError(plan)


def test_a_lookup_does_not_exchange_the_cache(spark, tmp_path):
    cache = E.cache_table(spark, str(tmp_path / "cache"), 8)
    for part in (["a", "b", "c"], ["c", "d"]):
        E.embed_requests(requests(spark, part), cache, NOW)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = E.cache_lookup(requests(spark, ["a", "d", "a", "x"]), cache.read(), NOW)
        assert [r.cache_hit for r in found.orderBy("request_id").collect()] == [True, True, True, False]
        plan = found._jdf.queryExecution().executedPlan().toString()
        path = _above_scan(plan)
        assert path and not any("Exchange" in line for line in path), plan
        wanted = E.get_many(E.with_cache_key(requests(spark, ["a"])).withColumn("position", F.lit(0)), cache.read(), NOW)
        assert not any("Exchange" in line for line in _above_scan(wanted._jdf.queryExecution().executedPlan().toString()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_compacting_the_cache(spark, tmp_path):
    cache = E.cache_table(spark, str(tmp_path / "cache"), 4)
    E.embed_requests(requests(spark, ["a", "b"], ttl=3600), cache, NOW)
    E.embed_requests(requests(spark, ["a"]), cache, NOW + timedelta(minutes=1), use_cache=False)
    assert cache.read().count() == 3
    E.compact_cache(cache, NOW + timedelta(hours=2))
    assert cache.read().count() == 1
    # Another session finds the table by its folder.
    spark.sql(f"DROP TABLE {cache.name}")
    again = E.cache_table(spark, str(tmp_path / "cache"), 4)
    assert E.cache_lookup(requests(spark, ["a", "b"]), again.read(), NOW + timedelta(hours=2)).where("cache_hit").count() == 1
