"""Near-duplicates and repeated passages."""

import time

import numpy as np
import pytest
from helpers import documents, words
from pyspark.sql import functions as F

import corpus_pipeline
from meterlake.llm import minhash, queries, repeats, simhash


def brute_repeats(texts, threshold):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - threshold + 1):
            seen[b[i : i + threshold]] = seen.get(b[i : i + threshold], 0) + 1
    out = []
    for b in raw:
        cover = np.zeros(len(b) + 1, dtype=int)
        for i in range(len(b) - threshold + 1):
            if seen[b[i : i + threshold]] > 1:
                cover[i] += 1
                cover[i + threshold if i + threshold < len(b) else len(b)] -= 1
        gone = np.cumsum(cover)[: len(b)] > 0
        spans = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]]))).reshape(-1, 2)
        out.append((len(b), [tuple(s) for s in spans.tolist()], bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def passages(seed):
    rng = np.random.default_rng(seed)
    shared = [words(rng, int(n)) for n in rng.integers(5, 80, 6)]
    texts = []
    for _ in range(40):
        parts = [words(rng, int(rng.integers(0, 60))) for _ in range(3)]
        for k in rng.integers(0, 6, 2):
            s = shared[k]
            a, b = sorted(rng.integers(0, len(s), 2).tolist()) if rng.random() < 0.5 else (0, len(s))
            parts.insert(int(rng.integers(len(parts) + 1)), s[a:b])
        texts.append(" é".join(parts))
    texts += [texts[0], texts[1][:-3] + "xyz", "ab" * 500, "q" * 300, None, "", "short", texts[2] + texts[2], "ü" * 120]
    return texts


@pytest.mark.parametrize(("seed", "threshold"), [(0, 60), (1, 60), (2, 100), (3, 400)])
def test_cut_repeats_against_brute_force(spark, seed, threshold):
    texts = passages(seed)
    docs = documents(spark, texts)
    rows = sorted(repeats.cut_repeats(docs, threshold=threshold).collect(), key=lambda r: r.row.doc_id)
    for row, (size, spans, kept) in zip(rows, brute_repeats(texts, threshold), strict=True):
        assert (row.n_bytes, [(s.start, s.end) for s in row.spans], bytes(row.kept)) == (size, spans, kept)
        assert row.row.rid is None and row.row.fp is None and row.row.row == "x"


def test_a_text_longer_than_a_stretch(spark):
    rng = np.random.default_rng(9)
    long = "".join(map(chr, rng.integers(97, 123, repeats.STARTS + 60_000)))
    at = repeats.STARTS - 5_000
    other = "#" + "".join(map(chr, rng.integers(65, 91, 3000))) + long[at : at + 20_000] + "#"
    rows = repeats.cut_repeats(documents(spark, [long, other])).orderBy("row.doc_id").collect()
    assert [[(s.start, s.end) for s in r.spans] for r in rows] == [[(at, at + 20_000)], [(3001, 23_001)]]


def test_cut_repeats_with_null_ids_and_repeated_rows(spark):
    texts = passages(5)
    texts = [*texts, texts[3], " ".join(t or "" for t in texts)]
    docs = documents(spark, texts, [None, None, *range(len(texts) - 3), 1])
    rows = repeats.cut_repeats(docs, threshold=60).collect()
    want = sorted((size, len(spans), kept) for size, spans, kept in brute_repeats(texts, 60))
    assert sorted((r.n_bytes, len(r.spans), bytes(r.kept)) for r in rows) == want


def test_very_many_copies_of_one_row(spark):
    text = words(np.random.default_rng(8), 2500, 100_000)
    docs = documents(spark, [text, "kept " * 20]).crossJoin(spark.range(10_000).withColumnRenamed("id", "copy")).where("doc_id = 0 OR copy = 0")
    # Copies with a null id and one text, and another text that shares a part with them.
    docs = docs.withColumn("doc_id", F.lit(None).cast("long")).unionByName(documents(spark, [text[:3000] + " own end"]).withColumn("copy", F.lit(0).cast("long")))
    start = time.time()
    rows = repeats.cut_repeats(docs).groupBy("n_bytes", "spans", "kept").count().collect()
    assert time.time() - start < 120
    assert sorted((r["count"], len(r.kept)) for r in rows) == [(1, 8), (1, 100), (10_000, 0)]


def test_thresholds_that_do_not_fit_are_refused(spark):
    for threshold in (39, 1279):
        with pytest.raises(ValueError):
            repeats.cut_repeats(documents(spark, ["a"]), threshold=threshold)


@pytest.mark.parametrize(("seed", "passage", "threshold"), [(0, 60, 100), (6, 60, 400), (7, 200, 400)])
def test_passages_beside_the_cut_against_brute_force(spark, seed, passage, threshold):
    texts = passages(seed)
    rows = repeats.cut_repeats(documents(spark, texts), threshold=threshold, passage=passage).collect()
    rows = sorted(rows, key=lambda r: r.row.doc_id)
    for row, cut, short in zip(rows, brute_repeats(texts, threshold), brute_repeats(texts, passage), strict=True):
        assert (row.n_bytes, [(s.start, s.end) for s in row.spans], bytes(row.kept)) == cut
        assert [(s.start, s.end) for s in row.passages] == short[1]
    with pytest.raises(ValueError):
        repeats.cut_repeats(documents(spark, ["a"]), threshold=threshold, passage=threshold)


def test_passages_of_texts_that_share_long_parts_in_turn(spark):
    rng = np.random.default_rng(13)
    base = words(rng, 260, 9000).split()
    texts = []
    for _ in range(40):
        a = int(rng.integers(0, 180))
        own = base[a : a + int(rng.integers(12, 80))]
        own[int(rng.integers(len(own)))] = f"own{len(texts)}"
        texts.append(f"{words(rng, 3, 9000)} {' '.join(own)} {words(rng, 3, 9000)}")
    rows = repeats.cut_repeats(documents(spark, texts), threshold=120, passage=60).orderBy("row.doc_id").collect()
    for row, cut, short in zip(rows, brute_repeats(texts, 120), brute_repeats(texts, 60), strict=True):
        assert (row.n_bytes, [(s.start, s.end) for s in row.spans], bytes(row.kept)) == cut
        assert [(s.start, s.end) for s in row.passages] == short[1]
    assert any(r.passages != r.spans for r in rows)


def test_what_repeats_over_the_larger_threshold_is_looked_at_in_one_text_for_the_smaller(spark, monkeypatch):
    rng = np.random.default_rng(14)
    shared = words(rng, 500, 9000)
    texts = [f"{words(rng, 20, 9000)} {shared} {words(rng, 20, 9000)}" for _ in range(30)]
    seen = {}

    def counted(docs, threshold, *more):
        found = runs(docs, threshold, *more)
        seen[threshold] = found.count()
        return found

    runs = repeats.runs
    monkeypatch.setattr(repeats, "runs", counted)
    rows = repeats.cut_repeats(documents(spark, texts), threshold=400, passage=200).collect()
    whole = len(repeats.runs_of(np.frombuffer(shared.encode(), dtype=np.uint8), 200)[0])
    assert all(r.passages == r.spans and r.spans[0].end - r.spans[0].start >= len(shared) for r in rows)
    # Once, and some runs beside its ends in every text.
    assert seen[200] < 30 * whole / 2


def test_op4_reports_passages_of_over_fifty_words_that_it_does_not_cut(spark, tmp_path):
    rng = np.random.default_rng(11)
    passage = words(rng, 60)
    texts = [f"{words(rng, 90, 9000)} {passage} {words(rng, 90, 9000)}" for _ in range(3)] + [words(rng, 250, 9000) for _ in range(3)]
    spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op4_suffix_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert 200 < len(passage) < 390
    assert [(r.n_removed, r.n_spans, r.n_passages) for r in rows] == [(0, 0, 1)] * 3 + [(0, 0, 0)] * 3
    assert all(len(passage) <= r.passage_bytes < len(passage) + 12 for r in rows[:3]) and rows[3].passage_bytes == 0


def test_runs_alone_with_their_gram_stay_at_home(spark):
    rng = np.random.default_rng(12)
    texts = [words(rng, 400, 9000) for _ in range(200)]
    docs = documents(spark, [*texts, texts[0]]).withColumns({"rid": F.col("doc_id"), "rhash": F.xxhash64("text")})
    docs = docs.select("rid", "rhash", F.col("text").cast("binary").alias("text"), F.xxhash64("rid", "rhash").alias("key"))
    often = repeats.repeated_grams(docs, 200)
    whole = len(repeats.runs_of(np.frombuffer(texts[0].encode(), dtype=np.uint8), 200)[0])
    assert often.count() <= whole
    found = repeats.runs(docs, 200, repeats.marks_of(often)).groupBy("rid").count().collect()
    found = {r.rid: r["count"] for r in found}
    assert found[0] == found[200] == whole
    # Wrong hits of the bit map, of at least one bit in eight.
    assert sum(found.values()) < 0.4 * 201 * whole


def test_cut_repeats_as_text_keeps_whole_characters(spark):
    docs = documents(spark, ["aé" + "x" * 90, "bé" + "x" * 90])
    # é ends with the same byte in both, and the byte before it is the same too.
    kept = [r.kept for r in repeats.cut_repeats(docs, threshold=60, as_text=True).orderBy("row.doc_id").collect()]
    assert kept == ["a", "b"]
    assert repeats.cut_repeats(documents(spark, [])).count() == 0


def brute_fingerprint(text):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in low.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def test_codes_reach_all_anchors_of_close_words():
    rng = np.random.default_rng(0)
    fps = rng.integers(0, 2**64, 300, dtype=np.uint64)
    for lengths in [(23, 23), (23, 23, 18), (20,)]:
        at, anchor = simhash.anchors(fps, lengths)
        sent = set(zip(at.tolist(), anchor.tolist(), strict=True))
        assert len(sent) == len(at)
        for i in range(300):
            other = int(fps[i])
            for b in rng.choice(64, 3, replace=False):
                other ^= 1 << int(b)
            assert (i, int(simhash.home_anchor(np.array([other], dtype=np.uint64), lengths)[0])) in sent


@pytest.mark.parametrize("lengths", [(23, 23), (23, 23, 18)])
def test_links_against_all_pairs(spark, lengths):
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 2**64, 120, dtype=np.uint64).tolist()
    for _ in range(400):  # chains and dense balls of near fingerprints
        x = fps[int(rng.integers(len(fps)))]
        for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
            x ^= 1 << int(b)
        fps.append(x)
    fps = sorted(set(fps))
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame, lengths)).collect()}
    want = brute_components(fps)
    got = [roots.get(x, x) for x in signed]
    groups = lambda keys: sorted(sorted(i for i, k in enumerate(keys) if k == key) for key in set(keys))
    assert groups(got) == groups(want)
    assert all(roots[n] == min(m for m in roots if roots[m] == roots[n]) for n in roots)


def test_near_duplicates_of_odd_texts(spark):
    rng = np.random.default_rng(4)
    base = words(rng, 400)
    texts = [base, base.upper(), base + " extra", None, "", " \n", "One", "one two", "one two three", "é x y z", base, base.replace(" w1 ", "\t\n w1 ")]
    ids = [7, 5, 6, None, 2, 3, None, 9, 10, 11, 7, 12]
    rows = simhash.near_duplicates(documents(spark, texts, ids)).collect()
    fps = [brute_fingerprint(t) for t in texts]
    roots = brute_components(fps)
    least = {}
    for i, r in zip(ids, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), f, str(least.get(r))) for i, f, r in zip(ids, fps, roots, strict=True))
    assert sorted((str(r.id), r.fp % 2**64, str(r.component)) for r in rows) == want
    kept = simhash.one_of_each(documents(spark, texts, ids))
    assert kept.columns == ["doc_id", "text", "rid", "row", "fp", "n_words"]
    assert kept.count() == len(set(roots))
    assert {r.doc_id for r in kept.collect()} >= {i for i in least.values()}
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.one_of_each(documents(spark, [])).count() == 0


def replaced(rng, words, n):
    """words with n of them replaced, and the Jaccard similarity of the five-word shingles."""
    new = list(words)
    for i in rng.choice(len(words), n, replace=False):
        new[i] = f"x{rng.integers(10**9)}"
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words, new))
    return " ".join(new), len(a & b) / len(a | b)


def test_stage_keeps_one_of_similar_texts(spark):
    rng = np.random.default_rng(5)
    texts, ids, expected, close = [], [], [], 0
    for n in range(120):
        base = [f"w{rng.integers(10**6)}" for _ in range(200 + 8 * (n % 100))]
        new, similarity = replaced(rng, base, 1 + len(base) * (n % 6) // 100)
        texts += [" ".join(base), new]
        ids += [2 * n, 2 * n + 1]
        expected += [2 * n] if similarity >= 0.8 else [2 * n, 2 * n + 1]
        close += 0.8 <= similarity < 0.9
    assert close > 10 and len(expected) > 125
    texts += ["Same  words of a text", "same words OF a text", None, "", "short", "same words of a text"]
    ids += [1000, 1001, 1002, 1003, 1004, None]
    kept = corpus_pipeline.near_duplicates(spark, documents(spark, texts, ids), "")
    assert sorted(r.doc_id for r in kept.collect()) == [*expected, 1000, 1002, 1004]
    assert corpus_pipeline.near_duplicates(spark, documents(spark, []), "").count() == 0


def test_groups_with_one_id_or_none_keep_a_row_each(spark):
    rng = np.random.default_rng(12)
    a, b, c, d = (" ".join(f"w{rng.integers(10**6)}" for _ in range(300)) for _ in range(4))
    docs = documents(spark, [a, b, a + " more", c, c + " more", d, a], [5, 5, 6, None, None, None, 5])
    for kept in (corpus_pipeline.near_duplicates(spark, docs, ""), simhash.one_of_each(docs)):
        rows = kept.collect()
        assert sorted(str(r.doc_id) for r in rows) == ["5", "5", "None", "None"]
        assert {r.text[:20] for r in rows} == {t[:20] for t in (a, b, c, d)}


@pytest.mark.parametrize("n", [150, 1500])
def test_links_among_texts_of_one_template(spark, n):
    """Pairs at a similarity above 0.8 among texts that are all alike at about 0.69; a tenth of the size is no easier."""
    rng = np.random.default_rng(n)
    template, texts, wanted = [f"t{i}" for i in range(400)], [], 0
    for k in range(n):
        own = [f"o{k}x{i}" for i in range(83)]
        first = template + own
        second = list(first)
        for i in rng.choice(len(first), 6, replace=False):
            second[i] = f"c{k}x{i}"
        texts += [" ".join(first), " ".join(second)]
    sets = [set(minhash.shingles(t).tolist()) for t in texts]
    similarity = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    across = [len(sets[0] & b) / len(sets[0] | b) for b in sets[2:40:2]]
    assert min(similarity) > 0.8 and 0.6 < min(across) <= max(across) < 0.8
    rows = minhash.near_duplicates(documents(spark, texts)).collect()
    group = {r.id: r.component for r in rows}
    linked = sum(group[2 * k] == group[2 * k + 1] for k in range(n))
    assert linked >= 0.95 * n and len(set(group.values())) == 2 * n - linked


@pytest.mark.parametrize("most", [minhash.CELL_SETS, 6])
def test_links_of_all_that_meet(spark, monkeypatch, most):
    """Chains in which only neighbours are similar, a few to a bucket: no set stands for its component."""
    monkeypatch.setattr(minhash, "CELL_SETS", most)
    rng = np.random.default_rng(most)
    at = [1000 * (k // 30) + (k % 30) * 4 + 9 * (k % 30 > 22) for k in range(120)]
    sets = [np.arange(x, x + 40, dtype=np.int32) for x in at]
    bands = [[k // 60, 10 + k % 2, 20 + int(rng.integers(3))] for k in range(120)]
    names = rng.permutation(120).tolist()
    rows = spark.createDataFrame([(n, b, s.tolist()) for n, b, s in zip(names, bands, sets, strict=True)], "fp long, bands array<long>, hashes array<int>")
    root = list(range(120))

    def find(k):
        return k if root[k] == k else find(root[k])

    for i, j in minhash.similar_pairs(sets, 0.75).tolist():
        if set(bands[i]) & set(bands[j]):
            root[find(j)] = find(i)
    roots = {r.node: r.root for r in simhash.components(minhash.links(rows, 0.75)).collect()}
    least = {find(k): min(names[m] for m in range(120) if find(m) == find(k)) for k in range(120)}
    assert 4 < len(least) < 12
    assert [roots.get(names[k], names[k]) for k in range(120)] == [least[find(k)] for k in range(120)]


def test_similar_pairs_against_sets():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.int32)) for _ in range(60)] + [np.arange(9000, dtype=np.int32)] * 2
    want = {(i, j) for i in range(62) for j in range(i + 1, 62)
            if len(set(sets[i]) & set(sets[j])) >= 0.5 * len(set(sets[i]) | set(sets[j]))}
    assert {tuple(p) for p in minhash.similar_pairs(sets, 0.5).tolist()} == want
