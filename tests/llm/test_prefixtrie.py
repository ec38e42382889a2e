"""The prefix trie against one that is built from whole texts."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, a0 string, stretch string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 3, "x", None) for r in rows], SCHEMA)


def brute(df, every=5, most=9):
    turns = defaultdict(list)
    for r in prefixtrie._turns(df, 0).collect():
        turns[r.conv_id].append((r.turn is not None, r.turn or 0, r.k1, r.k2, r.role, r.text))
    turns = {c: [t[4:] for t in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        base = c - int(np.fmod(c, every))
        h = zlib.crc32(str(c).encode()) % most
        rebuilt = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
        ends[tuple(rebuilt)].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        value = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += value
    return sorted(
        (who[0], len(node), members[node[:-1]][0] if node else -1, len(who), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, who in members.items())


def found(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in prefixtrie.trie(df).collect())


def conversations(rng, n=120):
    texts = ["", "a", "é", "hello", "long " * 50]
    rows = []
    for c in rng.choice(400, n, replace=False).tolist() + [-7, -5, 2**40 + 3]:
        for turn in range(int(rng.integers(1, 14))):
            rows.append((c, [turn, turn, None][rng.integers(3)], [None, "", "user"][rng.integers(3)], texts[rng.integers(rng.integers(1, 6))]))
    rows += rows[:40]  # repeated rows
    return rows + [(None, 1, "user", "no conversation"), (None, None, None, None)]


@pytest.mark.parametrize("seed", [0, 1])
def test_against_whole_texts(spark, seed):
    df = table(spark, conversations(np.random.default_rng(seed)))
    assert found(df) == brute(df)


def test_long_conversation_and_a_chain_of_branches(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK_BITS", 3)
    monkeypatch.setattr(prefixtrie, "COPIES_A_ROW", 7)
    monkeypatch.setattr(prefixtrie, "IDS_A_ROW", 4)
    rows = [(10, t, "user", f"t{t}") for t in range(300)] + [(10, 5, "user", "again")] * 50
    # Conversation 5k leaves the path of the one before it after 10 + k turns: a deep tree of paths.
    rows += [(1000 + 5 * k, t, "user", f"c{t}" if t < 10 + k else f"own{k}") for k in range(30) for t in range(12 + k)]
    rows += [(5000 + 5 * k, t, "user", "same") for k in range(30) for t in range(3)]
    df = table(spark, rows)
    assert found(df) == brute(df)


def test_collisions_are_found_and_other_bases_taken(spark, monkeypatch):
    real = prefixtrie.bases
    monkeypatch.setattr(prefixtrie, "bases", lambda attempt: [1, 1, 1] if attempt == 0 else real(attempt))
    order = table(spark, [(c, t, "user", x) for c, xs in ((0, "abc"), (10, "bac"), (20, "cab")) for t, x in enumerate(xs * 4)])
    placed = prefixtrie.places(prefixtrie._turns(order, 0), [1, 1, 1])
    each = prefixtrie.heads(placed, 5, 9)
    nodes = prefixtrie.nodes_of(prefixtrie.steps(placed, each, [1, 1, 1], 9), each)
    assert nodes.where("mixed").count() > 0
    assert found(order) == brute(order)


def test_turns_with_equal_hashes_are_seen(spark):
    rows = [(1, 2, 3, 4, 5, "user", "a"), (1, 3, 3, 4, 5, "user", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, k1 long, k2 long, n_bytes long, role string, text string")
    assert not prefixtrie.references_hold(turns) and prefixtrie.references_hold(turns.limit(1))


def test_powers_and_empty_tables(spark):
    exponents = [0, 1, 2, 31, 4095, 4096, 2**31 + 12345]
    df = spark.createDataFrame([(e,) for e in exponents], "e long").select("e", prefixtrie.power(987654321, F.col("e")).alias("p"))
    assert {r.e: r.p for r in df.collect()} == {e: pow(987654321, e, prefixtrie.PRIME) for e in exponents}
    assert prefixtrie.trie(table(spark, []).limit(0)).count() == 0
    assert prefixtrie.trie(table(spark, [(None, 1, "user", "x")])).count() == 0
