"""Shards, perspectives, top-k and personal data."""

import hashlib
import re
import zlib

import numpy as np
from helpers import documents
from pyspark.sql import functions as F

from meterlake.llm import perspectives, pii, sharding, topk


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2147483648.0 / ((key >> 33) + 1)))
    return b


def test_jump_hash_against_the_loop_and_when_growing():
    keys = np.random.default_rng(0).integers(0, 2**64, 3000, dtype=np.uint64)
    for n in (1, 2, 40, 41, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]
    a, b = sharding.jump_hash(keys, 40), sharding.jump_hash(keys, 41)
    assert ((a == b) | (b == 40)).all() and (a != b).mean() < 0.05


def test_shards_of_odd_rows(spark):
    texts = [None, "", "é", "x" * 1000, "x", "x", "x", *["t"] * 50]
    ids = [None, None, 1, 2, 3, 3, 4, *range(100, 150)]
    rows = sharding.shard(documents(spark, texts, ids), 5).collect()
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True))
    assert sorted((str(r.id), r.size, r.text_crc32) for r in rows) == want
    for s in range(5):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 5) for r in rows)
    assert len({r.shard for r in rows if r.id == 3}) == 1
    assert sharding.shard(documents(spark, []), 5).count() == 0


def render(turns, me):
    out = ""
    for _, who, text in turns:
        head = "assistant" if who == me else "system" if who == "system" else f"user name={who}"
        out += f"<|im_start|>{head}\n{text}<|im_end|>\n"
    return out


def test_every_perspective_renders_the_dialogue(spark):
    rng = np.random.default_rng(0)
    talk = {c: [(t, ["ann", "bob", "système", "system"][int(rng.integers(4))], "é😀 " * int(rng.integers(5)) + str(t)) for t in range(n)]
            for c, n in [(1, 1), (2, 40), (3, 700)]}
    rows = [(c, *turn, "z") for c, turns in talk.items() for turn in turns]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, segment string").repartition(5)
    found = {}
    for r in perspectives.rotate(frame).collect():
        found.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(found) == {(c, who) for c, turns in talk.items() for _, who, _ in turns if who != "system"}
    for (conv, me), parts in found.items():
        parts.sort(key=lambda r: r.start)
        whole = "".join(r.segment for r in parts)
        assert whole == render(talk[conv], me)
        for r in parts:
            assert whole[r.start : r.end] == r.segment
            own = r.speaker == me
            said = talk[conv][r.turn][2]
            assert whole[r.loss_start : r.loss_end] == (said + "<|im_end|>" if own else "")


def test_perspectives_of_odd_turns(spark):
    rows = [(None, 1, "a", "x"), (None, None, None, None), (1, 0, "a", "hi <|im_end|>"), (1, 0, "a", "hi <|im_end|>"), (2, 0, "system", "s")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    found = perspectives.rotate(frame).collect()
    assert {(r.conv_id, r.perspective) for r in found} == {(None, "a"), (None, "unknown"), (1, "a")}
    assert all(r.segment.count("<|im_end|>") == 1 for r in found)
    assert len([r for r in found if r.conv_id == 1]) == 2
    assert perspectives.rotate(frame.limit(0)).count() == 0


def test_top_k_against_all_scores(spark):
    rng = np.random.default_rng(1)
    vectors = [rng.normal(size=8).round(1).tolist() for _ in range(200)]
    vectors += [vectors[0], vectors[0], None, [], [None] * 8, [float("nan")] * 8, [float("inf")] * 8, [1.0, 2.0, 3.0], [2.0, 1.0, 1.0], [3e30] * 8]
    frame = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)] + [(None, vectors[1], "x")], "vec_id long, embedding array<float>, vector string")
    whole = frame.select("vec_id", topk.whole_numbers(frame.embedding).alias("vector")).where("vec_id < 209 OR vec_id IS NULL")
    kept = {r.vec_id: np.array(r.vector, dtype=object) for r in whole.collect() if r.vector is not None and r.vec_id is not None}
    assert set(kept) == {*range(202), 207, 208}
    for shards, blocks, k in [(1, 1, 5), (4, 3, 5), (3, 1, 300)]:
        rows = topk.top_k(whole.where("vec_id % 3 = 0"), whole, k, shards, blocks).collect()
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows)
        want = []
        for q, x in kept.items():
            if q % 3 == 0:
                scored = sorted((-int((x * y).sum()), v) for v, y in kept.items() if v != q and len(y) == len(x))[:k]
                want += [(q, n, v, -s) for n, (s, v) in enumerate(scored, 1)]
        assert got == sorted(want)
    assert topk.top_k(whole.limit(0), whole, 5, 2, 2).count() == 0


def test_whole_numbers_floor(spark):
    row = spark.createDataFrame([([0.5, -0.001, -1.0],)], "e array<float>").select(topk.whole_numbers(F.col("e")).alias("v")).first()
    assert row.v == [128, -1, -256]


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if valid(k, m.group()))


HARD = [
    "a@b.com_x@y.com z", "1.2.3.4.5.6.7.8 999.1.1.1.2 1.2.3.04", "+1 (988) 555-2485 x +12 345 ++49 30 1234567", None, "", "é😀 a@b.c@d.e.f 10.0.0.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111, 4111 1111 1111 1112", "12345678901234567890123", "a" * 100_000, "1" * 50_000 + ".1.1.1",
    "x@y.z," * 300, "a@" * 500, "1.1.1.1 " * 300, "+" * 1000 + "1" * 12, "x@y.z", "x@y.z",
]


def test_base_spans_of_odd_texts(spark):
    rows = pii.sanitise(documents(spark, HARD)).collect()
    assert len(rows) == len(HARD)
    for r in rows:
        assert [(s.start, s.kind, s.end, s.name) for s in r.spans if s.kind < pii.BASE] == base_spans(r.row.text)
    clean = {r.row.doc_id: r.clean for r in rows}
    assert clean[0] == "[EMAIL][EMAIL] z" and clean[3] is None and clean[6] == "[CARD]" and clean[11] == "[EMAIL]," * 300
    listed = documents(spark, HARD)
    shas = pii.sanitise(listed, with_text=False).select("row.doc_id", F.sha2(pii.listing("spans", True), 256).alias("h")).collect()
    for r in shas:
        text = ",".join(f"{k}:{a}:{e}" for a, _, e, k in base_spans(HARD[r.doc_id]))
        assert r.h == hashlib.sha256(text.encode()).hexdigest()


def test_terms_that_reveal_an_entity_go(spark):
    told = ["Agent Kowalski wrote kow@mail.com today in rain", "Ask Kowalski via kow@mail.com please now", "The reply of Kowalski (kow@mail.com) came late"]
    plain = ["Rain today in the sun please ask now via wrote agent the reply came late of"] * 60
    copies = ["Once Lindqvist had lin@mail.com here"] * 5
    rows = pii.sanitise(documents(spark, [*told, *plain, *copies])).collect()
    clean = {r.row.doc_id: r.clean for r in rows}
    assert clean[0] == "Agent  wrote [EMAIL] today in rain"
    assert clean[2] == "The reply of  ([EMAIL]) came late"
    assert all(clean[i] == plain[0] for i in range(3, 63))
    # Copies of one context are one context.
    assert all(clean[i] == "Once Lindqvist had [EMAIL] here" for i in range(63, 68))
    plan = pii.sanitise(documents(spark, told))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert pii.sanitise(documents(spark, [])).count() == 0


def test_terms_that_reveal_an_entity_go_everywhere(spark):
    far = " and then" * 60
    told = [
        "Agent Kowalski wrote kow@mail.com today in rain",
        f"Ask Kowalski via kow@mail.com please now{far}, KOWALSKI, said so.{far} Kowalskis x Kowalski",
        f"é😀 Kowalski{far} kow@mail.com again",
        *[f"{w} Kowalski wrote kow@mail.com" for w in ("Here", "There", "Where", "Soon")],
    ]
    plain = ["Rain today in the sun please ask now via wrote agent said and then again"] * 300
    texts = [*told[:2], told[1], *told[2:], *plain, "Mrs Kowalski has no address here", None, ""]
    ids = [0, 1, 1, *range(3, len(texts))]
    for row in pii.sanitise(documents(spark, texts, ids)).collect():
        if row.row.text is None:
            assert row.clean is None and row.spans == []
            continue
        places = [m.span() for m in re.finditer(r"(?<![^\W\d_])kowalski(?![^\W\d_])", row.row.text, re.I)]
        assert [(s.start, s.end) for s in row.spans if s.kind >= pii.BASE] == places
        assert not re.search(r"\bkowalski\b", row.clean, re.I)
        assert row.clean == re.sub(r"(?i)\bkowalski\b", "[TERM]", row.row.text).replace("kow@mail.com", "[EMAIL]")
