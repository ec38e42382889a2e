"""Collocations against counting every phrase."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import collocations

SCHEMA = "doc_id long, text string, lang string, prefix string, n string, phrase long"


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, None, "x", 7) for i, (text, lang) in enumerate(rows)], SCHEMA)


def brute(rows, longest, least, percent, top):
    upper = {c: c + 32 for c in range(65, 91)}
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(upper)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: v for p, v in f.items() if len(p) > 1 and v >= least}
        most = Counter()
        for p, v in candidates.items():
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        most[p[i:j]] = max(most[p[i:j]], v)
        found = []
        for p, a in candidates.items():
            if 100 * most[p] >= percent * a:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        for rank, (s, a, phrase, left, right, n) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def rows_for(rng, n=120):
    words = ["the", "The", "new", "york", "a\x00b", "é", "Ünter", "x\x1cy", " ", "times", "of"]
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ", ", "\n", "!", "\x0b", "\r\n"]
    out = []
    for _ in range(n):
        picks = rng.integers(0, len(words), rng.integers(0, 60))
        out.append(("".join(words[p] + ends[rng.integers(len(ends))] for p in picks), [None, "en", "de", "und"][rng.integers(4)]))
    fixed = [("new york times of the", "en")] * 40 + [("of of of of of of of", "de")] * 9 + [(None, "en"), ("", None), (" .. ", "fr")]
    return out + fixed


@pytest.mark.parametrize(("least", "percent", "top"), [(5, 100, 2000), (3, 60, 7)])
def test_against_every_phrase(spark, least, percent, top):
    rows = rows_for(np.random.default_rng(least))
    got = collocations.collocations(table(spark, rows), least=least, percent=percent, top=top).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5, least, percent, top)


def test_long_texts_are_read_in_blocks_and_hot_words_counted_once(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 50)
    rng = np.random.default_rng(3)
    rows = [(" ".join(rng.choice(["hot", "hot", "hot", "b", "c.", "longword" * 10], 3000)), "en")] + rows_for(rng, 10)

    def stripes(widths, maps):
        counter = collocations._Counter("en", widths, maps, 3)
        for text, lang in rows:
            if lang == "en":
                counter.add((text or "").encode())
        monkeypatch.setattr(collocations, "WINDOWS_AT_ONCE", 101)
        found = Counter()
        for batch in counter.stripes():
            for row in batch.to_pylist():
                prefixes = [p for p, size in zip(row["prefix"], row["size"], strict=True) for _ in range(size)]
                for prefix, word, n in zip(prefixes, row["next"], row["n"], strict=True):
                    found[prefix, word] += n
        return found

    all_bits = np.full(1 << 14, 2**64 - 1, dtype=np.uint64)
    want, totals = Counter(), Counter()
    for text, lang in rows:
        if lang == "en":
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").lower()):
                words = re.findall(r"[^\x20\x09]+", piece)
                for i in range(len(words) - 1):
                    want[" ".join(words[i : i + 2]), words[i + 2] if i + 2 < len(words) else None] += 1
                totals.update(words)
    assert stripes(range(2, 3), {2: all_bits}) == want
    assert stripes(range(1), {}) == Counter({("", w): n for w, n in totals.items()})


def test_empty_tables_and_products_beyond_64_bits(spark):
    assert collocations.collocations(table(spark, [("a b", "en")]).limit(0)).count() == 0
    assert collocations.collocations(table(spark, [(None, None), ("", "en")]), least=1).count() == 0
    wide = spark.sql("SELECT (cast(4000000000000L AS decimal(18, 0)) * cast(9000000000000L AS decimal(18, 0)) * 1000BD)"
                     " div (cast(4000000000001L AS decimal(18, 0)) * cast(4000000000003L AS decimal(18, 0))) AS x").first().x
    assert wide == 4000000000000 * 9000000000000 * 1000 // (4000000000001 * 4000000000003)


def test_stripes_of_a_hot_prefix_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(collocations, "ENTRIES_AT_ONCE", 50)
    texts = spark.range(2000).select(F.lit("en").alias("lang"), F.concat(F.lit("the w"), F.pmod("id", F.lit(200)), F.lit(". the")).alias("text"))
    every = spark.sparkContext.broadcast(np.full(1 << 14, 2**64 - 1, dtype=np.uint64))
    merged = collocations.merged_stripes(collocations.local_stripes(texts, range(1, 2), {1: every}), 10).where("prefix = 'the'").collect()
    assert len(merged) > 1 and sum(r.total for r in merged) == 4000
    assert {k: v for r in merged for k, v in r.entries.items()} == {f"w{i}": 10 for i in range(200)}
    assert all(r.most == 10 for r in merged if r.entries)
