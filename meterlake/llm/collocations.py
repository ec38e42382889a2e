r"""Collocations by the stripes pattern.

A stripe is an associative counter: a prefix of words keys the words that
follow it and how often. Tasks build stripes of their texts and send them;
stripes of one prefix are merged elementwise. The merged stripes of prefixes
of k words hold all that is asked of phrases of k + 1 words:

- extensions: the entries from the least count on are the longer phrases,
- prefix totals: a stripe's sum is the count of its prefix, because what has
  no longer phrase to offer (the end of a piece, a rare continuation) is
  counted under an entry without a word; the total of the empty prefix is the
  number of words,
- subsumption maxima: the greatest entry tells whether a longer phrase is as
  frequent as its prefix, and by the rest of the phrase as its suffix.

Rare phrases are left at home. Lengths go up one by one: a window of k words is
looked at only if its prefix and its suffix may be frequent (a phrase is never
more frequent than its parts), and it adds to one of a number of counters that
its hash chooses. A counter under the least count shows that all its windows are
rare; the others make a bit map, which the next length and the stripes look up.
A wrong hit costs a row and changes no count, a frequent phrase is never missed.
The number of counters follows the number of windows up to 2^MAP_BITS_MOST (a
bit map of 64 MB); on a larger corpus more rare windows are sent.

Entries are dealt into parts by a hash of prefix and word, so a hot prefix has a
piece of its stripe in every part and does not meet in one task. A task sends
the stripes of a block of text packed, one row per part; the parts are merged
one after the other, and only frequent entries and totals leave.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keyed import checked_broadcast, skew_join, top_per_key
from meterlake.llm.common import stored

LONGEST = 5
LEAST = 100
PERCENT = 100  # a phrase goes if a longer one has this percentage of its count
TOP = 2000
MAP_BITS_LEAST, MAP_BITS_MOST, RANGE_BITS = 20, 29, 20
LOAD = 16  # counters for as many windows as make a frequent phrase
WINDOWS_AT_ONCE = 1 << 20
WORDS_KEPT = 1 << 19
LANGUAGES_KEPT = 16
BLOCK = 8 << 20
FACTOR = np.uint64(0x9E3779B97F4A7C15)

SEPARATORS = b".,;:!?\n\x0b\x0c\r"  # fixed values: what ends a piece
_UPPER = bytes(range(65, 91))
CLEAN = bytes.maketrans(_UPPER + b"\t" + SEPARATORS, _UPPER.lower() + b" " + b"." * len(SEPARATORS))
# The stripes of a block in one part: `size` has the number of entries of each prefix.
PACKED = "lang string, part int, prefix array<string>, size array<int>, next array<string>, n array<bigint>"
STRIPE = "lang string, prefix string, part int, total bigint, most bigint, entries map<string, bigint>"
ENTRIES_AT_ONCE = 1 << 21


class _Codes(dict):
    """Codes of words in the order they are met; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class _Counter:
    """Windows of one language in one task: words become codes, and codes become stripes or counts.

    maps[k] is the bit map of phrases of k words that may be frequent.
    """

    def __init__(self, lang: str, widths: range, maps: dict[int, np.ndarray], parts: int = 1):
        self.lang, self.widths, self.maps, self.dealt = lang, widths, maps, parts
        self.seed = xxhash.xxh64_intdigest(lang.encode())
        self.codes, self.parts, self.size = _Codes({b".": 0}), [], 0
        self.hashes = np.zeros(1, dtype=np.uint64)

    def add(self, text: bytes) -> None:
        start = 0
        while start < len(text):
            end = min(start + BLOCK, len(text))
            if end < len(text):  # a block ends between two words
                cut = max(text.rfind(c, start, end) for c in (b" ", b"\t", b"\n", b"."))
                end = cut + 1 if cut >= start else len(text)
            words = text[start:end].translate(CLEAN).replace(b".", b" . ").split()
            self.parts.append(np.fromiter(map(self.codes.__getitem__, words), dtype=np.int32, count=len(words)))
            self.size += len(words)
            start = end
        self.parts.append(np.zeros(1, dtype=np.int32))
        self.size += 1

    def _taken(self) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """All that was added, as codes with the words they stand for, in parts of bounded size; forgets it."""
        if not self.parts:
            return
        beyond = self.widths[-1] + 2
        codes = np.concatenate([*self.parts, np.zeros(beyond, dtype=np.int32)])
        self.parts, n, self.size = [], self.size, 0
        names = list(self.codes)
        if len(self.hashes) < len(names):
            new = [xxhash.xxh64_intdigest(w, self.seed) for w in names[len(self.hashes) :]]
            self.hashes = np.concatenate([self.hashes, np.array(new, dtype=np.uint64)])
        for start in range(0, n, WINDOWS_AT_ONCE):
            yield codes[start : start + min(WINDOWS_AT_ONCE, n - start) + beyond - 1].astype(np.int64), names
        if len(self.codes) > WORDS_KEPT:
            self.codes, self.hashes = _Codes({b".": 0}), np.zeros(1, dtype=np.uint64)

    def stripes(self) -> Iterator[pa.RecordBatch]:
        for c, names in self._taken():
            words = pa.array(names, pa.binary()).cast(pa.string())
            if 0 in self.widths:
                yield self._packed(words, *self._words(c))
                continue
            for m, at, may, h, _ in self._windows(c):
                yield self._packed(words, *self._pairs(c, m, at, may, h))

    def counts(self) -> Iterator[np.ndarray]:
        """Hashes of the windows whose prefix and suffix may be frequent."""
        for c, _ in self._taken():
            for *_, h in self._windows(c):
                yield h

    def _words(self, c: np.ndarray) -> tuple:
        """The stripe of the empty prefix, as _pairs gives others."""
        n = np.bincount(c[: len(c) - self.widths[-1] - 1], minlength=1)
        n[0] = 0
        found = np.flatnonzero(n)
        return [], found, n[found], np.array([0, len(found)] if len(found) else [0]), self.hashes[found]

    def _windows(self, c: np.ndarray) -> Iterator[tuple]:
        """For each width m: m, the places of prefixes of m words that may be frequent, whether what follows may make a longer phrase, the prefixes' hashes, and those of the longer windows that passed."""
        n = len(c) - self.widths[-1] - 1
        h, whole, words = self.hashes[c], c > 0, self.hashes[c]
        for m in range(1, self.widths[-1] + 1):
            if m in self.widths:
                frequent = whole & marked(self.maps[m], h)
                at = np.flatnonzero(frequent[:n])
                may = frequent[at + 1]
                longer = h[at] * FACTOR + words[at + m]
                if m + 1 in self.maps:
                    may = may & marked(self.maps[m + 1], longer)
                yield m, at, may, h[at], longer[may]
            h = h[:-1] * FACTOR + words[m:]
            whole = whole[:-1] & (c[m:] > 0)

    def _pairs(self, c: np.ndarray, m: int, at: np.ndarray, may: np.ndarray, h: np.ndarray) -> tuple:
        """Codes of each prefix, codes of the next words and their counts, where each prefix begins, and a hash of each entry."""
        size, key = len(self.codes), c[at]
        for j in range(1, m):
            key = np.unique(key * size + c[at + j], return_inverse=True)[1]
        pairs, first, counts = np.unique(key * size + np.where(may, c[at + m], 0), return_index=True, return_counts=True)
        prefix, following = pairs // size, pairs % size
        starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]]) if len(pairs) else np.zeros(0, dtype=np.int64)
        heads = at[first[starts]]
        return [c[heads + j] for j in range(m)], following, counts, np.r_[starts, len(pairs)], h[first] * FACTOR + self.hashes[following]

    def _packed(
        self, words: pa.Array, prefix: list, following: np.ndarray, counts: np.ndarray, bounds: np.ndarray, h: np.ndarray
    ) -> pa.RecordBatch:
        """Stripes as rows of PACKED."""
        stripes = len(bounds) - 1
        names = pc.binary_join_element_wise(*[words.take(pa.array(p)) for p in prefix], " ") if prefix else pa.array([""] * stripes, pa.string())
        of = np.repeat(np.arange(stripes), np.diff(bounds))
        part = ((h >> np.uint64(32)) % np.uint64(self.dealt)).astype(np.int32)
        order = np.lexsort((of, part))
        of, part = of[order], part[order]
        first = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (of[1:] != of[:-1])]) if len(of) else np.zeros(0, dtype=np.int64)
        held, entry = np.unique(part, return_index=True)
        entry = np.r_[entry, len(part)]
        stripe = pa.array(np.searchsorted(first, entry), pa.int32())
        entry = pa.array(entry, pa.int32())
        following = following[order]
        columns = [
            pa.array([self.lang] * len(held), pa.string()), pa.array(held, pa.int32()),
            pa.ListArray.from_arrays(stripe, names.take(pa.array(of[first])).cast(pa.string())),
            pa.ListArray.from_arrays(stripe, pa.array(np.diff(np.r_[first, len(of)]), pa.int32())),
            pa.ListArray.from_arrays(entry, words.take(pa.array(following, mask=following == 0))),
            pa.ListArray.from_arrays(entry, pa.array(counts[order], pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "part", "prefix", "size", "next", "n"])


def marked(marks: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set; marks has 64 bits an element."""
    place = h >> np.uint64(64 - (len(marks).bit_length() + 5))
    return (marks[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _lang(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("und")).alias("lang")


def _counted(batches: Iterator[pa.RecordBatch], out: str, *how) -> Iterator:
    """What the counters' method `out` gives for all texts, language by language."""
    counters: dict[str, _Counter] = {}
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            if lang not in counters:
                counters[lang] = _Counter(lang, *how)
            counters[lang].add(text.as_py())
            if counters[lang].size >= WINDOWS_AT_ONCE:
                yield from getattr(counters[lang], out)()
            if len(counters) > LANGUAGES_KEPT:
                for counter in counters.values():
                    yield from getattr(counter, out)()
                counters.clear()
    for counter in counters.values():
        yield from getattr(counter, out)()


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(_lang(lang_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def local_stripes(texts: DataFrame, widths: range, maps: dict[int, Broadcast]) -> DataFrame:
    """Stripes of prefixes of `widths` words of each block of text, packed by parts."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted(batches, "stripes", widths, {k: m.value for k, m in maps.items()}, parts)

    return texts.mapInArrow(run, PACKED)


def _added(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by(["prefix", "next"]).aggregate([("n", "sum")]).rename_columns(["prefix", "next", "n"])


def _frequent(lang: str, part: int, merged: pa.Table, least: int) -> pa.RecordBatch:
    """Rows of STRIPE of one part, all its entries added up."""
    merged = merged.sort_by("prefix").combine_chunks()
    prefix, following, n = (merged[c].combine_chunks() for c in ("prefix", "next", "n"))
    new = pc.not_equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.r_[True, new.astype(bool)])
    n = n.to_numpy()
    kept = (n >= least) & following.is_valid().to_numpy(zero_copy_only=False)
    bounds = np.r_[0, np.cumsum(np.add.reduceat(kept, starts, dtype=np.int64))]
    most = np.maximum.reduceat(np.where(kept, n, 0), starts)
    entries = pa.MapArray.from_arrays(pa.array(bounds, pa.int32()), following.filter(pa.array(kept)), pa.array(n[kept]))
    columns = [
        pa.array([lang] * len(starts), pa.string()), prefix.take(pa.array(starts)), pa.array([part] * len(starts), pa.int32()),
        pa.array(np.add.reduceat(n, starts)), pa.array(most, mask=most == 0), entries,
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "part", "total", "most", "entries"])


def merged_stripes(packed: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, prefix, part, total, most, entries: stripes of one prefix added up elementwise, part by part.

    entries maps the next words with at least `least` occurrences to their
    number, most is the greatest of them; total has all occurrences, so the
    parts of a prefix add up to its count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tables, held = None, [], 0
        for batch in batches:
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if key != now:
                    if tables:
                        yield _frequent(*now, _added(tables), least)
                    now, tables, held = key, [], 0
                prefix, size, following, n = (batch.column(c)[i].values for c in range(2, 6))
                of = pa.array(np.repeat(np.arange(len(size)), size.to_numpy()))
                tables.append(pa.table({"prefix": prefix.take(of), "next": following, "n": n}))
                held += len(n)
                if held > ENTRIES_AT_ONCE:
                    tables = [_added(tables)]
                    held = 0
        if tables:
            yield _frequent(*now, _added(tables), least)

    parts = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed.repartition(parts, "lang", "part").sortWithinPartitions("lang", "part")
    return dealt.mapInArrow(run, STRIPE)


def window_marks(texts: DataFrame, words: int, shorter: Broadcast, windows: int, least: int) -> tuple[Broadcast, int]:
    """Bit map of the counters of windows of so many words that reach `least`, and the sum of these counters.

    A task sends the counters it has touched as packed arrays, by ranges of
    counters; a range is added up in one array of fixed size.
    """
    bits = map_bits(windows // least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h in _counted(batches, "counts", range(words - 1, words), {words - 1: shorter.value}):
            place, n = np.unique(h >> np.uint64(64 - bits), return_counts=True)
            bounds = np.searchsorted(place, np.arange((1 << (bits - RANGE_BITS)) + 1, dtype=np.uint64) << np.uint64(RANGE_BITS))
            for part, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                if a < b:
                    gaps = np.diff(place[a:b], prepend=np.uint64(part << RANGE_BITS)).astype("<u4")
                    packed = [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in (gaps, n[a:b].astype("<u4"))]
                    yield pa.RecordBatch.from_pydict({"part": [part], "size": [b - a], "gaps": packed[:1], "n": packed[1:]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(1 << RANGE_BITS, dtype=np.int64)

        def row() -> pa.RecordBatch:
            over = total >= least
            return pa.RecordBatch.from_pydict({"part": [now], "bits": [np.packbits(over, bitorder="little").tobytes()], "n": [int(total[over].sum())]})

        for batch in batches:
            for part, size, gaps, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if part != now:
                    if now is not None:
                        yield row()
                        total[:] = 0
                    now = part
                gaps, n = (np.frombuffer(pa.decompress(x, 4 * size, "zstd"), dtype="<u4") for x in (gaps, n))
                total[np.cumsum(gaps, dtype=np.int64)] += n
        if now is not None:
            yield row()

    sent = texts.mapInArrow(count, "part bigint, size bigint, gaps binary, n binary")
    # At most 2^(MAP_BITS_MOST - RANGE_BITS) ranges, dealt by their number.
    sent = sent.repartition(1 << min(bits - RANGE_BITS, 8), "part").sortWithinPartitions("part")
    marks, passed = np.zeros(1 << (bits - 6), dtype="<u8"), 0
    for r in sent.mapInArrow(add, "part bigint, bits binary, n bigint").collect():
        marks[r.part << (RANGE_BITS - 6) : (r.part + 1) << (RANGE_BITS - 6)] = np.frombuffer(r.bits, dtype="<u8")
        passed += r.n
    return texts.sparkSession.sparkContext.broadcast(marks), passed


def map_bits(count: int) -> int:
    return min(max((LOAD * count).bit_length(), MAP_BITS_LEAST), MAP_BITS_MOST)


def phrase_marks(phrases: DataFrame, count: int) -> Broadcast:
    """Broadcast bit map of the hashes of (lang, phrase); its size follows their number up to a bound."""
    bits = map_bits(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seed, h = xxhash.xxh64_intdigest(lang.encode()), 0
                for word in phrase.encode().split(b" "):
                    h = (h * int(FACTOR) + xxhash.xxh64_intdigest(word, seed)) & (2**64 - 1)
                places.append(h >> (64 - bits))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64())], ["place"])

    places = phrases.select("lang", "phrase").mapInArrow(run, "place bigint")
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    found = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    marks = np.zeros(1 << (bits - 6), dtype=np.uint64)
    marks[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(marks)


def phrase_levels(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> list[DataFrame]:
    """The totals (lang, n), then one table per number of words: lang, phrase, f, lefts, rights, most.

    lefts has the counts of the first 1, 2, .. words, rights those of what
    follows them; most is the greatest count of a phrase that is one word longer
    (null: none).
    """
    texts = _texts(docs, text_col, lang_col)
    words = stored(merged_stripes(local_stripes(texts, range(1), {}), least), "stripes-of-words")
    empty = F.array().cast("array<bigint>")
    entries = words.select("lang", "prefix", F.explode("entries").alias("next", "f"))
    levels = [stored(entries.select("lang", F.col("next").alias("phrase"), "f", empty.alias("lefts"), empty.alias("rights")), "phrases-1")]
    count, windows = levels[0].agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    maps = {1: phrase_marks(levels[0], count)}
    for k in range(2, longest + 1):
        maps[k], windows = window_marks(texts, k, maps[k - 1], windows, least)
    merged = stored(merged_stripes(local_stripes(texts, range(1, longest), maps), least), "stripes")
    merged = merged.withColumn("width", F.size(F.split("prefix", " ")))
    stripes = [words]
    for width in range(1, longest):
        stripe = merged.where(F.col("width") == width)
        stripes.append(stripe)
        entries = stripe.select("lang", "prefix", F.explode("entries").alias("next", "f"))
        entries = entries.withColumn("phrase", F.concat_ws(" ", "prefix", "next"))
        entries = entries.withColumn("suffix", F.expr("substring(phrase, instr(phrase, ' ') + 1)"))
        totals = stripe.groupBy("lang", "prefix").agg(F.sum("total").alias("l"))
        before = levels[-1].select("lang", F.col("phrase").alias("prefix"), "lefts")
        heads = skew_join(before, totals, ["lang", "prefix"], "inner")
        heads = heads.select("lang", "prefix", F.concat("lefts", F.array("l")).alias("lefts"))
        tails = levels[-1].select("lang", F.col("phrase").alias("suffix"), F.concat(F.array("f"), "rights").alias("rights"))
        level = skew_join(skew_join(entries, heads, ["lang", "prefix"], "inner"), tails, ["lang", "suffix"], "inner")
        levels.append(stored(level.select("lang", "phrase", "f", "lefts", "rights", "suffix"), f"phrases-{width + 1}"))
    out = []
    for k, level in enumerate(levels):
        if k + 1 < longest:
            longer = stripes[k + 1].select("lang", F.col("prefix").alias("phrase"), "most")
            longer = longer.unionByName(levels[k + 1].select("lang", F.col("suffix").alias("phrase"), F.col("f").alias("most")))
            longer = longer.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
            level = skew_join(level, longer, ["lang", "phrase"], "left")
        else:
            level = level.withColumn("most", F.lit(None).cast("bigint"))
        out.append(level.select("lang", "phrase", "f", "lefts", "rights", "most"))
    totals = stripes[0].groupBy("lang").agg(F.sum("total").alias("n"))
    return [totals, *out]


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    percent: int = PERCENT,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to `longest` words of each language.

    A cut of a phrase with count a into parts with counts l and r scores
    floor(1000 a n / (l r)); the lowest cut counts, the earliest of equal ones.
    A phrase inside a longer one with at least percent / 100 of its count is
    left out. Products are 38-digit decimals. A null text is empty, a null
    language is `und`; empty tables give no rows; repeated rows count as often
    as they occur, and columns other than the two named ones are not read.
    """
    totals, _, *levels = phrase_levels(docs, longest, least, text_col, lang_col)
    wide = "decimal(18, 0)"
    cut = (
        f"transform(lefts, (l, i) -> struct((cast(f AS {wide}) * cast(n AS {wide}) * 1000BD) div"
        f" (cast(l AS {wide}) * cast(rights[i] AS {wide})) AS score, i AS i, l AS l, rights[i] AS r))"
    )
    rows = None
    for level in levels:
        level = level.where(F.col("most").isNull() | (F.col("most") * 100 < F.col("f") * percent))
        rows = level if rows is None else rows.unionByName(level)
    rows = rows.join(checked_broadcast(totals), "lang").withColumn("cut", F.array_min(F.expr(cut)))
    rows = rows.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    ranked = top_per_key(rows, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
