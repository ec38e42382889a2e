"""The vector index against a full scan."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterlake.operators import vector_index as X

SCHEMA = "vec_id long, embedding array<double>, cell string, part string, vector string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], None, "p", "v") for i, v in rows], SCHEMA)


def probes_of(df, every=1):
    return df.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("probe_id"), F.col("embedding").alias("probe"))


def full_scan(rows, probes, k):
    out = {}
    for name, q in probes:
        scores = sorted((-round(float(np.dot(q, v)), 7), i) for i, v in rows)
        out[name] = [(i, -s) for s, i in scores[:k]]
    return out


def found(frame, name="probe_id"):
    out = {}
    for r in frame.orderBy(name, "rank").collect():
        out.setdefault(r[name], []).append((r.id, r.score))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for name, rows in want.items():
        assert [i for i, _ in got[name]] == [i for i, _ in rows] and np.allclose([s for _, s in got[name]], [s for _, s in rows], atol=1e-7)


def clustered(rng, n, d=8, clusters=12):
    centres = rng.normal(size=(clusters, d)) * 5
    return [(i, centres[rng.integers(clusters)] + rng.normal(size=d) * 0.2) for i in range(n)]


def test_visits_are_given_in_frames_of_bounded_size():
    rng = np.random.default_rng(4)
    # Radii so large that every probe looks into every cell.
    shared = rng.normal(size=(900, 8)), np.full(900, 100.0), np.ones(900, dtype=np.int64)
    probes = pd.DataFrame({"asked": np.arange(700), "wanted": list(rng.normal(size=(700, 8))), "floor": 0.0})
    frames = list(X.chosen_cells(iter([probes]), shared, 2, False))
    assert max(map(len, frames)) <= X.VISITS_AT_ONCE
    early = pd.concat(X.chosen_cells(iter([probes]), shared, 2, True))
    visits = pd.concat([*frames, early])
    assert len(early) == 2 * 700 and len(visits) == 900 * 700 == len(visits[["asked", "cell"]].drop_duplicates())
    assert all(np.array_equal(row.wanted, probes["wanted"][row.asked]) for row in early.itertuples())


@pytest.mark.parametrize("k", [1, 5, 700])
def test_equals_a_full_scan_and_skips_cells(spark, tmp_path, monkeypatch, k):
    monkeypatch.setattr(X, "PART_ROWS", 20)
    monkeypatch.setattr(X, "PROBE_ROWS", 7)
    rows = clustered(np.random.default_rng(k), 600)
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # copies: ties go to the smaller id
    df = table(spark, rows)
    index = X.build_index(df, str(tmp_path / "cells"), cells=20)
    out, seen = X.search(index, probes_of(df, 20), k, str(tmp_path / "first"))
    same(found(out), full_scan(rows, [(i, v) for i, v in rows if i % 20 == 0], k))
    shares = [r.share for r in seen.collect()]
    assert len(shares) == 33 and all(0 < s <= 1 for s in shares)
    assert k > 5 or np.mean(shares) < 0.4
    assert index.n == len(rows) == index.sizes.sum() and index.parts.max() > 1


def test_a_search_does_not_depend_on_the_centres(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=5)) for i in range(200)]
    df = table(spark, rows)
    monkeypatch.setattr(X, "SAMPLE_ROWS", 3)
    for cells in (1, 3, 50):
        out, _ = X.search(X.build_index(df, str(tmp_path / f"c{cells}"), cells=cells), probes_of(df, 10), 4, str(tmp_path / f"f{cells}"))
        same(found(out), full_scan(rows, rows[::10], 4))


def test_vectors_that_take_no_part(spark, tmp_path):
    good = [(i, [i, 1.0, -i]) for i in range(12)]
    bad = [(None, [1, 2, 3]), (20, None), (21, [1, None, 3]), (22, [1, float("nan"), 3]), (23, [1, float("inf"), 3]), (24, []), (25, [1, 2]), (26, [1, 2, 3, 4])]
    df = table(spark, good + bad)
    out, seen = X.search(X.build_index(df, str(tmp_path / "c")), probes_of(df), 3, str(tmp_path / "f"))
    same(found(out), full_scan(good, good, 3))
    assert seen.count() == len(good)
    nothing = X.build_index(df.where("vec_id = 20"), str(tmp_path / "n"))
    assert nothing is None and [f.count() for f in X.search(nothing, probes_of(df), 3, str(tmp_path / "g"))] == [0, 0]
    out, _ = X.search(X.build_index(df, str(tmp_path / "d")), probes_of(df).limit(0), 3, str(tmp_path / "h"))
    assert out.count() == 0
