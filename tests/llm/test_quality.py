import re
from collections import Counter

import numpy as np
from helpers import documents, words

from meterlake.llm import quality


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    repeated = {i + d for i, x in enumerate(windows) if seen[x] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_base_counts_of_odd_texts(spark):
    rng = np.random.default_rng(0)
    texts = [None, "", " \t\n", "a", "a b", "a b c", "a a a a a", "a b c a b c", "é😀 # x\n\né😀 # x\n \n", "x" * 100_000,
             words(rng, 400, 20), words(rng, 3000, 6), "a\nb\na\nb", "a b c\n" * 2000, "\x1c\x1da b", "a b c", "a b c"]
    docs = documents(spark, texts)
    for row in quality.judge(docs, labels(spark, [])).collect():
        q = row.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute(row.row.text)
        assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words)
        assert q.score == 0 and q.kept == (not q.base_failed)


def test_scores_follow_the_formula_and_tell_junk(spark):
    rng = np.random.default_rng(1)
    texts = [words(rng, 120) for _ in range(60)] + [" | ".join(f"z{rng.integers(10**6)}" for _ in range(90)) for _ in range(20)]
    docs = documents(spark, texts)
    marks = labels(spark, [(i, 1, 0) for i in range(40)] + [(i, 0, 0) for i in range(60, 80)] + [(None, 1, 0), (3, 1, None)])
    rows = {r.row.doc_id: r.quality for r in quality.judge(docs, marks).collect()}
    # With as little trusted text as this the corpus prior keeps every score small.
    assert all(rows[i].kept for i in range(60))
    assert max(rows[i].score for i in range(60, 80)) < min(rows[i].score for i in range(60))
    grams = [np.array(r.g) for r in quality._hashed(docs, "text", doc_id=docs.doc_id)
             .select("doc_id", quality._grams(quality.BUCKETS).alias("g")).orderBy("doc_id").collect()]
    every, good = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, g in enumerate(grams):
        np.add.at(every, g, 1)
        if i < 40:
            np.add.at(good, g, 1)
    p = (every + 1) / (every.sum() + quality.BUCKETS)
    ratio = np.log((good + quality.PRIOR * p) / (good.sum() + quality.PRIOR)) - np.log(p)
    assert all(abs(rows[i].score - ratio[g].mean()) < 1e-9 for i, g in enumerate(grams))


def test_trusted_sample_is_bounded_and_fixed(spark):
    marks = labels(spark, [(i, 1, 0) for i in range(30)] * 2)
    once = {r.doc_id for r in quality.trusted_ids(marks, 10).collect()}
    assert len(once) == 10 and once == {r.doc_id for r in quality.trusted_ids(marks.repartition(7), 10).collect()}


def test_empty_table_and_native_plan(spark):
    docs = documents(spark, [])
    judged = quality.judge(docs, labels(spark, [(1, 1, 0)]))
    assert judged.count() == 0
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
