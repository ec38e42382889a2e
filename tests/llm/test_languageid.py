"""The language network: gradients, labels of every byte, held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import languageid

SCHEMA = "doc_id long, text string, lang string, label string, score string"


def plain(network, text):
    """Probabilities of one window, a byte at a time in double precision."""
    w, k = {n: v.astype(np.float64) for n, v in network.w.items()}, network.hidden
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def read(data, d):
        h, out = np.zeros(k), []
        for x in data:
            i, g = w[f"a{d}"][:, x], w[f"u{d}"] @ h
            r, z = sigmoid(i[:k] + g[:k]), sigmoid(i[k : 2 * k] + g[k : 2 * k])
            h = h + z * (np.tanh(i[2 * k :] + r * g[2 * k :]) - h)
            out.append(h)
        return out

    both = [np.concatenate(s) for s in zip(read(text, "f"), read(text[::-1], "b")[::-1], strict=True)]
    p = np.exp(np.array(both) @ w["out"].T + w["bias"][:, 0])
    return p / p.sum(axis=1, keepdims=True)


def test_labels_of_every_byte(monkeypatch):
    monkeypatch.setattr(languageid, "LANES", 7)
    rng = np.random.default_rng(1)
    network = languageid.Network(["a", "b", "c"], hidden=5, seed=3)
    texts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 1, 3, 16, 17, 500, 0, 33)]
    sums, labels = languageid.label_texts(network, texts, width=16)
    for text, total, count in zip(texts, sums, labels, strict=True):
        each = [plain(network, text[i : i + 16]) for i in range(0, len(text), 16)]
        each = np.concatenate(each) if each else np.zeros((0, 3))
        assert np.allclose(total, each.sum(axis=0), atol=1e-3 + 1e-5 * len(text))
        assert np.abs(count - np.bincount(each.argmax(axis=1), minlength=3)).sum() <= 2 and count.sum() == len(text)


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    network = languageid.Network(["a", "b"], hidden=3, seed=1)
    network.w = {n: v.astype(np.float64) for n, v in network.w.items()}
    x, y = rng.integers(0, 256, (6, 4)), np.array([0, 1, 1, 0])
    _, found = network.gradients(x, y)
    for name, w in network.w.items():
        places = [(int(r), int(x[rng.integers(6), rng.integers(4)])) for r in range(w.shape[0])] if name[0] == "a" else list(np.ndindex(w.shape))
        for at in places:
            old = w[at]
            w[at] = old + 1e-4
            up = network.gradients(x, y)[0]
            w[at] = old - 1e-4
            down = network.gradients(x, y)[0]
            w[at] = old
            assert found[name][at] == pytest.approx((up - down) / 2e-4, abs=2e-4)


def test_accuracy_on_documents_that_were_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = languageid.identify(docs).join(docs.select(F.col("doc_id").alias("id"), "lang", "text"), "id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert np.mean([r.lang_pred == r.lang for r in held if len(r.text) > 200]) > 0.995
    assert all(sum(r.labels.values()) == len(r.text.encode()) for r in rows if r.lang_pred != "und")


def test_odd_rows_and_who_is_learnt_from(spark, monkeypatch):
    monkeypatch.setattr(languageid, "STEPS", 20)
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1)
    free = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(held, "held out text", "secret"), (free[0], None, "xx"), (free[1], "", "xx"), (free[2], "12 34 ..", "xx")]
    rows += [(free[3], "no label", None), (None, "Ünder null id", "yy"), (free[4], "ab " * 9000, "zz"), (free[4], "ab " * 9000, "zz"), (free[5], "é", "yy")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    drawn = languageid.sample(docs).collect()
    assert {r.lang for r in drawn} == {"yy", "zz"} and max(len(r.window) for r in drawn) == languageid.TRAIN_BYTES
    assert len([r for r in drawn if r.lang == "zz"]) == languageid.DRAWS  # copies count once
    found = languageid.predict(docs, languageid.Network(["yy", "zz"]).fit(np.full((4, 8), 97), np.array([0, 1, 0, 1]), steps=2)).collect()
    by_text = {(r.id, r.lang_pred == "und", r.held_out) for r in found}
    assert {(held, False, True), (free[0], True, False), (free[1], True, False), (free[2], True, False), (None, False, False)} <= by_text
    assert all(r.score == 0 and not r.labels for r in found if r.lang_pred == "und") and len(found) == len(rows)
    copies = [r for r in found if r.id == free[4]]
    assert copies[0] == copies[1]


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(0, "text", None, "x", "y")], SCHEMA)
    assert [(r.lang_pred, r.score) for r in languageid.identify(docs).collect()] == [("und", 0.0)]
    assert languageid.identify(docs.limit(0)).count() == 0
