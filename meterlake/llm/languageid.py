r"""Language identification by a bidirectional gated recurrent network over bytes.

Each byte of a text is an input; one recurrent layer reads the text forwards,
one backwards, and a softmax over both states labels every byte with a language.
A document's probabilities are the mean over its bytes. With byte x, state h and
per-direction tables A (a row per byte value, biases included) and U:

    r, z = sigmoid(A_rz[x] + U_rz h)
    n    = tanh(A_n[x] + r (U_n h))
    h'   = h + z (n - h)

Training is backpropagation through time with Adam in numpy, on a bounded
sample: DRAWS windows of TRAIN_BYTES bytes are drawn from every labelled
document, and each language keeps the WINDOWS_A_LANGUAGE with the smallest hash.
The sample (4 MB at most) is learnt on the driver; the weights (some 60 KB) are
broadcast. Prediction reads every byte of every text, in windows of
WINDOW_BYTES bytes with a state of their own, thousands of them side by side,
so a very long text is as cheap per byte as many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keyed import top_per_key

HIDDEN = 8
LANGUAGES_MOST = 64
WINDOWS_A_LANGUAGE = 1024
DRAWS = 8
SPARE = 8
TRAIN_BYTES = 64
STEPS = 300
BATCH = 256
RATE = 0.01
LOGIT_WEIGHT = 4.0  # output weights stay within this, so that no exponential overflows
WINDOW_BYTES = 128
LANES = 2048
BYTES_AT_ONCE = 8 << 20
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1


def held_out(id_col: str) -> Column:
    """Whether a document's label must not be learnt; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


# --- the network ------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Two recurrent layers and a softmax; all weights by name in `w`."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng, self.languages, self.hidden = np.random.default_rng(seed), languages, hidden
        draw = lambda scale, *shape: (scale * rng.standard_normal(shape)).astype(np.float32)
        self.w = {"out": draw(0.3, len(languages), 2 * hidden), "bias": np.zeros((len(languages), 1), dtype=np.float32)}
        for d in "fb":
            self.w |= {f"a{d}": draw(0.3, 3 * hidden, 256), f"u{d}": draw(hidden**-0.5, 3 * hidden, hidden)}

    # Training: x is (bytes, lanes); all arrays are (units, lanes), so that units are contiguous.

    def _forward(self, x: np.ndarray, d: str) -> list[tuple]:
        k, a, u = self.hidden, self.w[f"a{d}"], self.w[f"u{d}"]
        h, seen = np.zeros((k, x.shape[1]), dtype=np.float32), []
        for t in range(len(x)) if d == "f" else reversed(range(len(x))):
            i, g = a[:, x[t]], u @ h
            gates = _sigmoid(i[: 2 * k] + g[: 2 * k])
            r, z = gates[:k], gates[k:]
            n = np.tanh(i[2 * k :] + r * g[2 * k :])
            seen.append((t, h, r, z, n, g[2 * k :]))
            h = h + z * (n - h)
        return [*seen, (None, h)]

    def _backward(self, x: np.ndarray, d: str, seen: list[tuple], given: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradients of a direction's weights; given[t] is the loss's gradient by the state after byte t."""
        k, u = self.hidden, self.w[f"u{d}"]
        du, back, inputs = np.zeros_like(u), np.zeros_like(seen[-1][1]), np.empty((len(x), 3 * k, x.shape[1]), dtype=np.float32)
        for t, h, r, z, n, g in reversed(seen[:-1]):
            back = back + given[t]
            dn = back * z * (1 - n * n)
            dz = back * (n - h) * z * (1 - z)
            dr = dn * g * r * (1 - r)
            inputs[t] = np.concatenate([dr, dz, dn])
            dg = np.concatenate([dr, dz, dn * r])
            du += dg @ h.T
            back = back * (1 - z) + u.T @ dg
        flat = inputs.transpose(1, 0, 2).reshape(3 * k, -1)
        da = np.stack([np.bincount(x.ravel(), row, minlength=256) for row in flat])
        return {f"a{d}": da, f"u{d}": du}

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all bytes, and its gradients; y is the language of each lane."""
        k, out = self.hidden, self.w["out"]
        seen = {d: self._forward(x, d) for d in "fb"}
        state = {d: {s[0]: after[1] for s, after in zip(seen[d][:-1], seen[d][1:], strict=True)} for d in "fb"}
        lanes, size = np.arange(x.shape[1]), x.size
        loss, dout, dbias, given = 0.0, np.zeros_like(out), np.zeros_like(self.w["bias"]), {"f": [], "b": []}
        for t in range(len(x)):
            both = np.concatenate([state["f"][t], state["b"][t]])
            p = np.exp(out @ both + self.w["bias"])
            p /= p.sum(axis=0)
            loss -= float(np.log(p[y, lanes] + 1e-30).sum()) / size
            p[y, lanes] -= 1
            p /= size
            dout += p @ both.T
            dbias += p.sum(axis=1, keepdims=True)
            back = out.T @ p
            given["f"].append(back[:k])
            given["b"].append(back[k:])
        found = {"out": dout, "bias": dbias}
        for d in "fb":
            found |= self._backward(x, d, seen[d], given[d])
        return loss, found

    def fit(self, windows: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 0) -> Network:
        """Adam over random batches in which every language has the same chance."""
        rng = np.random.default_rng(seed)
        chance = 1 / np.bincount(y, minlength=len(self.languages))[y]
        chance /= chance.sum()
        mean = {name: np.zeros_like(v) for name, v in self.w.items()}
        square = {name: np.zeros_like(v) for name, v in self.w.items()}
        for step in range(1, steps + 1):
            pick = rng.choice(len(y), batch, p=chance)
            _, found = self.gradients(np.ascontiguousarray(windows[pick].T), y[pick])
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for name, g in found.items():
                g = np.clip(g, -1, 1)
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.01 * (g * g - square[name])
                scaled = (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)
                self.w[name] = (self.w[name] - now * scaled).astype(np.float32)
            self.w["out"] = np.clip(self.w["out"], -LOGIT_WEIGHT, LOGIT_WEIGHT)
            self.w["bias"] = np.clip(self.w["bias"], -LOGIT_WEIGHT, LOGIT_WEIGHT)
        return self

    # Prediction: the same network with halved gate weights, as sigmoid(2x) = (1 + tanh x) / 2.

    def _read(self, x: np.ndarray, active: np.ndarray, d: str) -> Iterator[tuple[int, np.ndarray]]:
        """(t, states of the active lanes after byte t); the active lanes are the first ones."""
        k = self.hidden
        half = np.array([[0.5]] * 2 * k + [[1.0]] * k, dtype=np.float32)
        a, u = self.w[f"a{d}"] * half, self.w[f"u{d}"] * np.float32(0.5)
        h = np.zeros((k, x.shape[1]), dtype=np.float32)
        i, g = np.empty((2, 3 * k, x.shape[1]), dtype=np.float32)
        for t in range(len(x)) if d == "f" else reversed(range(len(x))):
            m = active[t]
            if not m:
                continue
            # `out` of take has to be contiguous; a narrower one is made anew.
            i = i if i.shape[1] == m else np.empty((3 * k, m), dtype=np.float32)
            g = g if g.shape[1] == m else np.empty((3 * k, m), dtype=np.float32)
            s = h[:, :m]
            np.take(a, x[t, :m], axis=1, out=i, mode="clip")
            np.matmul(u, s, out=g)
            gates = i[: 2 * k]
            gates += g[: 2 * k]
            np.tanh(gates, out=gates)
            gates += 1
            n = g[2 * k :]
            n *= gates[:k]
            n += i[2 * k :]
            np.tanh(n, out=n)
            n -= s
            n *= gates[k:]
            n *= np.float32(0.5)
            s += n
            yield t, s

    def label(self, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of lanes sorted by falling length: sums of each language's probability over the bytes, and bytes labelled with it."""
        k, size = self.hidden, len(self.languages)
        active = np.searchsorted(-lengths, -np.arange(len(x)), side="left")
        ahead = np.empty((len(x), size, x.shape[1]), dtype=np.float32)
        forward, backward = self.w["out"][:, :k].copy(), self.w["out"][:, k:].copy()
        for t, s in self._read(x, active, "f"):
            np.matmul(forward, s, out=ahead[t, :, : s.shape[1]])
        total, labels = np.zeros((2, size, x.shape[1]), dtype=np.float32)
        for t, s in self._read(x, active, "b"):
            m = s.shape[1]
            p = ahead[t, :, :m]
            p += backward @ s
            p += self.w["bias"]
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            total[:, :m] += p
            labels[:, :m] += p == p.max(axis=0)
        return total, labels


def label_texts(network: Network, texts: list[bytes], width: int = WINDOW_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Per text: summed probabilities and labelled bytes of each language."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.zeros((2, len(texts), len(network.languages)))
    windows = -(-sizes // width)
    if not windows.sum():
        return out[0], out[1]
    of = np.repeat(np.arange(len(texts)), windows)
    number = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = (np.cumsum(sizes) - sizes)[of] + number * width
    lengths = np.minimum(width, sizes[of] - number * width)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    order = np.argsort(-lengths, kind="stable")
    for at in range(0, len(order), LANES):
        lanes = order[at : at + LANES]
        longest = int(lengths[lanes[0]])
        x = data[np.minimum(starts[lanes] + np.arange(longest)[:, None], len(data) - 1)].astype(np.intp)
        for kind, found in enumerate(network.label(x, lengths[lanes])):
            for language, row in enumerate(found):
                out[kind, :, language] += np.bincount(of[lanes], row, minlength=len(texts))
    return out[0], out[1]


# --- the corpus ------------------------------------------------------------------


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, window: the windows to learn from, of documents that are not held out.

    Every document offers DRAWS windows at places that its hash chooses, over
    its whole text; copies offer the same ones, which count once. Languages are
    the LANGUAGES_MOST most frequent ones. Of a frequent language only hashes
    under a bound that leaves about SPARE times as many as are kept leave their task.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & ~held_out(id_col))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    common = rows.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES_MOST)
    content = F.col("text").cast("binary")
    drawn = rows.select("lang", "text", F.explode(F.sequence(F.lit(1), F.lit(DRAWS))).alias("draw"))
    drawn = drawn.withColumn("hash", F.xxhash64("draw", "text"))
    room = F.greatest(F.octet_length("text") - TRAIN_BYTES + 1, F.lit(1))
    place = F.pmod(F.xxhash64("hash"), room).cast("int") + 1
    drawn = drawn.select("lang", "hash", F.substring(content, place, F.lit(TRAIN_BYTES)).alias("window"))
    share = F.lit(float(SPARE * WINDOWS_A_LANGUAGE)) / (F.col("count") * DRAWS)
    drawn = drawn.join(F.broadcast(common), "lang").where(F.col("hash") < share * 2.0**64 - 2.0**63).drop("count").distinct()
    return top_per_key(drawn, ["lang"], [F.col("hash"), F.col("window")], WINDOWS_A_LANGUAGE).select("lang", "window")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> Network | None:
    """The network learnt from the documents' sample; None without any."""
    rows = sorted((r.lang, bytes(r.window)) for r in sample(docs, id_col, text_col, lang_col).collect())
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    # A short window is repeated until it is full.
    windows = np.stack([np.resize(np.frombuffer(w, dtype=np.uint8), TRAIN_BYTES) for _, w in rows]).astype(np.int64)
    y = np.array([languages.index(lang) for lang, _ in rows])
    return Network(languages).fit(windows, y, **options)


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred, score, labels for every row.

    labels has how many bytes of the text were labelled with each language; score is
    the mean probability of lang_pred, to four digits. A text that is null or
    has no letter is `und` with score 0, as is all without a network. Of equal
    languages the first by name is taken; repeated rows get equal results, and
    other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < len(batch):
                end = max(int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + BYTES_AT_ONCE)), start + 1)
                yield _labelled(model, batch.slice(start, end - start), texts.slice(start, end - start))
                start = end

    letters = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), letters.alias("text"))
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double, labels map<string, bigint>")


def _labelled(model: Network | None, batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
    known = model.languages if model else []
    names, scores, labels = [], [], []
    texts = [t or b"" for t in texts.to_pylist()]
    sums, counts = label_texts(model, texts) if model else (np.zeros((len(texts), 0)),) * 2
    for text, total, count in zip(texts, sums, counts, strict=True):
        best = int(np.argmax(total)) if text and known else None
        names.append(UNKNOWN if best is None else known[best])
        scores.append(0.0 if best is None else round(min(float(total[best]) / len(text), 1.0), 4))
        labels.append([] if best is None else list(zip(known, count.astype(np.int64).tolist(), strict=True)))
    columns = [batch.column(0), batch.column(1), pa.array(names), pa.array(scores), pa.array(labels, pa.map_(pa.string(), pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["id", "held_out", "lang_pred", "score", "labels"])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled documents that are not held out, and predict all; see predict()."""
    return predict(docs, train(docs, id_col, text_col, lang_col), id_col, text_col)
