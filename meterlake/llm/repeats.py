"""Removal of repeated passages: a depth-limited radix sort of suffixes.

Every window of `threshold` bytes is the head of a suffix, and suffixes need an
order only through the threshold. They are sorted by most-significant-digit
passes, and after each pass only groups that can still hold two equal windows
go on; groups that are equal after the last pass are exactly the repeated
windows.

The digits are not taken from left to right. The first one is a gram inside
the window, chosen by the window's own bytes (the smallest hash of its grams,
the first of equals), so that equal windows choose the same one at the same
offset. A run of neighbouring windows shares its gram, and one row stands for
the whole run:

pass 1  digit: the gram. A row per run. Runs that are equal as a whole are
        repeated as a whole; runs alone with their gram are done. Most are,
        so grams are counted before, and a bit map of those that occur again
        keeps the others' runs at home (a wrong hit costs a row).
pass 2  digit: the bytes that all windows of a piece have in common. A row per
        piece of `PIECE` windows, for one run of each kind whose gram has
        several. Where all pieces with a digit are equal they are done, and so
        is a piece alone with its digit.
pass 3  digit: what is left of the window, the few bytes beside the common
        ones. A row per window.

Grams and common bytes are compared by 64-bit hashes of their own, runs by two
more, and the bytes of pass 3 by one beside one of all digits before.

A text with two thresholds goes through the passes twice, first with the larger
one: what is repeated over the larger is so over the smaller. Runs that are equal
as a whole need to be looked at only once more, in the text with the smallest key
that has them; in all others their bytes are left out the second time. The bytes
that stay for a run that was left out lie in a text with a smaller key, or are
left out there for a text with a key smaller still, so one always stays. Texts in
which nothing was found are never exchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keyed import first_per_key, skew_join
from meterlake.llm.common import row_ref, stored

THRESHOLD = 400
GRAM = 80  # bytes of a gram, from a fifth to two fifths of the threshold
PIECE = 16
STARTS = 1 << 15  # window starts of a long text that are hashed at once
TOGETHER = 1 << 16  # bytes of several texts that are hashed at once; their places have 16 bits
ROWS = 1 << 18  # rows of a batch
PLACE_BITS = 20
MARK_BITS_LEAST, MARK_BITS_MOST = 10, 28  # a bit map has 128 bytes to 32 MB, and at least eight bits per key below that
LEAST, MOST = 40, 1278  # thresholds: common bytes must be left beside a piece, distances from the gram take 10 bits

# --- rolling hashes ---------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


@cache
def _powers(salt: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte, the powers of an odd base, and those of its inverse modulo 2^64."""
    numbers = _mixed(_mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(salt)))
    base = (0x5851F42D4C957F2D + 4 * salt) % 2**64 | 1
    steps = [np.full(n, b, dtype=np.uint64) for b in (base, pow(base, -1, 2**64))]
    for s in steps:
        s[0] = 1
    return numbers, np.cumprod(steps[0]), np.cumprod(steps[1])


class Hashes:
    """Hashes of any range of a buffer, from running sums."""

    def __init__(self, data: np.ndarray, salt: int):
        n = 1 << int(len(data)).bit_length()
        numbers, powers, self.back = _powers(salt, n)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(numbers[data] * powers[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def rolling(self, length: int) -> np.ndarray:
        return (self.sums[length:] - self.sums[:-length]) * self.back[: len(self.sums) - length]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


# --- bit maps of keys -------------------------------------------------------


def _bits_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)


def _marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit set: all that were marked, and a few others."""
    bit = _bits_of(keys, (64 * len(marks)).bit_length() - 1)
    return (marks[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("key").to_numpy().view(np.uint64)


def marks_of(keys: DataFrame) -> Broadcast:
    """Broadcast bit map of a column of longs; its size follows their number up to a bound."""
    bits = min(max((4 * keys.count()).bit_length() + 1, MARK_BITS_LEAST), MARK_BITS_MOST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = _bits_of(batch.column(0).to_numpy().view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(bit.view(np.int64))], ["bit"])

    one = F.expr("shiftleft(1L, cast(bit & 63 AS int))")
    found = keys.mapInArrow(run, "bit long").groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    marks = np.zeros(1 << (bits - 6), dtype=np.uint64)
    marks[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(marks)


# --- pass 1 -----------------------------------------------------------------


def grams_of(data: np.ndarray, first: Hashes, threshold: int, begins: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The grams of the runs of one stretch of at most TOGETHER bytes: gram hash, gram position, first and last window start.

    begins has the first bytes of the texts in it, if there are several; no window lies in two texts.
    """
    gram = max(threshold // 5, min(GRAM, 2 * threshold // 5))
    grams = first.rolling(gram)
    # 16 bits of hash and 16 of place: the first of equals is as much the window's own choice as the smallest.
    ranked = (grams >> np.uint64(32)).astype(np.uint32)
    ranked &= np.uint32(0xFFFF0000)
    ranked |= np.arange(len(grams), dtype=np.uint32)
    best = _sliding_min(ranked, threshold - gram + 1)[: len(data) - threshold + 1]
    place = (best & np.uint32(0xFFFF)).astype(np.int64)
    if begins is not None and len(begins) > 1:
        size = np.diff(begins, append=len(data))
        inside = np.maximum(size - threshold + 1, 0)
        within = np.repeat(np.tile([True, False], len(size)), np.stack([inside, size - inside], axis=1).ravel())
        place[~within[: len(place)]] = -1
    low = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    high = np.append(low[1:], len(place)) - 1
    place = place[low]
    if begins is not None:
        held = place >= 0
        place, low, high = place[held], low[held], high[held]
    return _mixed(grams[place]), place, low, high


def runs_of(
    data: np.ndarray, threshold: int, marks: np.ndarray | None = None, begins: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """The runs of windows of one stretch of bytes (at least the threshold long) whose gram is marked.

    gram hash, two hashes of the run's bytes, gram position, first and last window start.
    """
    first = Hashes(data, 1)
    grams, place, low, high = grams_of(data, first, threshold, begins)
    if marks is not None:
        held = _marked(marks, grams)
        grams, place, low, high = grams[held], place[held], low[held], high[held]
    second = Hashes(data, 2) if len(place) else first
    shape = ((place - low) << 10 | (place - high)).astype(np.uint64)
    whole = [_mixed(h(low, high + threshold) + shape * np.uint64(0xA0761D6478BD642F)) for h in (first, second)]
    return grams, *whole, place, low, high


def _stretches(size: int, threshold: int) -> Iterator[tuple[int, int]]:
    """Parts of a text that together hold every window once."""
    for start in range(0, size - threshold + 1, STARTS):
        yield start, min(start + STARTS + threshold - 1, size)


def _stretches_among(
    batch: pa.RecordBatch, threshold: int, without: Broadcast | None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The texts of a batch whose key is not marked, in stretches.

    Bytes, first bytes of the texts in them, these texts' places in the batch, and where in their text they start.
    """
    places = np.arange(batch.num_rows)
    if without is not None:
        places = np.flatnonzero(~_marked(without.value, _keys(batch)))
        batch = batch.take(pa.array(places))
    if not batch.num_rows:
        return
    texts = batch.column("text").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    starts = batch.column("start").to_numpy()
    i = 0
    while i < len(texts):
        j = max(int(np.searchsorted(ends, ends[i] + TOGETHER, "right")) - 1, i + 1)
        if j > i + 1 and ends[j] - ends[i] >= threshold:
            yield data[ends[i] : ends[j]], ends[i:j] - ends[i], places[i:j], starts[i:j]
        elif j == i + 1:
            for start, end in _stretches(int(ends[j] - ends[i]), threshold):
                yield data[ends[i] + start : ends[i] + end], np.zeros(1, dtype=np.int64), places[i:j], starts[i:j] + start
        i = j


Parts = list[tuple[DataFrame, Broadcast | None]]  # rows with rid, rhash, text, start and key, and the keys that are left out


def _scanned(parts: Parts, run: Callable[[Iterator[pa.RecordBatch], Broadcast | None], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def over(docs: DataFrame, without: Broadcast | None) -> DataFrame:
        return docs.select("rid", "rhash", "text", "key", "start").mapInArrow(lambda batches: run(batches, without), schema)

    return reduce(DataFrame.unionByName, [over(*part) for part in parts])


def _whole(docs: DataFrame) -> Parts:
    return [(docs.withColumn("start", F.lit(0).cast("long")), None)]


def repeated_grams(docs: DataFrame | Parts, threshold: int) -> DataFrame:
    """The grams that several runs of docs (see runs) have."""

    def run(batches: Iterator[pa.RecordBatch], without: Broadcast | None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, held = [], 0
            for data, begins, _, _ in _stretches_among(batch, threshold, without):
                parts.append(grams_of(data, Hashes(data, 1), threshold, begins)[0])
                held += len(parts[-1])
                if held > ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64))], ["gram"])
                    parts, held = [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64))], ["gram"])

    found = _scanned(docs if isinstance(docs, list) else _whole(docs), run, "gram long")
    return found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")


def runs(docs: DataFrame | Parts, threshold: int, often: Broadcast) -> DataFrame:
    """Rows of pass 1 of docs (rid, rhash, text, key), or of parts of texts: gram, c1, c2, rid, rhash, place.

    place packs the gram's position, its distance from the first window and that from the last.
    often marks the grams that are looked at.
    """

    def run(batches: Iterator[pa.RecordBatch], without: Broadcast | None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, held = [], 0
            for data, begins, texts, starts in _stretches_among(batch, threshold, without):
                gram, c1, c2, at, low, high = runs_of(data, threshold, often.value, begins)
                of = np.searchsorted(begins, at, "right") - 1
                place = (at - begins[of] + starts[of]) << PLACE_BITS | (at - low) << 10 | (at - high)
                parts.append((gram.view(np.int64), c1.view(np.int64), c2.view(np.int64), texts[of], place))
                held += len(at)
                if held > ROWS:
                    yield rows(batch, parts)
                    parts, held = [], 0
            if parts:
                yield rows(batch, parts)

    def rows(batch: pa.RecordBatch, parts: list[tuple]) -> pa.RecordBatch:
        gram, c1, c2, at, place = (pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))
        arrays = [gram, c1, c2, batch.column("rid").take(at), batch.column("rhash").take(at), place]
        return pa.RecordBatch.from_arrays(arrays, ["gram", "c1", "c2", "rid", "rhash", "place"])

    parts = docs if isinstance(docs, list) else _whole(docs)
    return _scanned(parts, run, "gram long, c1 long, c2 long, rid long, rhash long, place long")


# --- pass 2 -----------------------------------------------------------------


def pieces_of_runs(data: np.ndarray, gram: np.ndarray, place: np.ndarray, threshold: int) -> tuple[np.ndarray, ...]:
    """Pieces of the given runs of one text.

    gram, number of the piece, hash of the common bytes, the bytes beside them
    (those of no window are zero), first and last window of the piece, start
    of its window 0 (window i starts i bytes before).
    """
    at, first, last = place >> PLACE_BITS, place & 1023, (place >> 10) & 1023
    count = last // PIECE - first // PIECE + 1
    of = np.repeat(np.arange(len(at)), count)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + (first // PIECE)[of]
    base = at[of] - PIECE * number
    low = np.maximum(first[of] - PIECE * number, 0)
    high = np.minimum(last[of] - PIECE * number, PIECE - 1)
    rest = PIECE - 1
    common = np.empty(len(of), dtype=np.int64)
    # Hashed in stretches: the runs come in order of their place.
    begin = 0
    while begin < len(of):
        end = int(np.searchsorted(at[of], at[of[begin]] + STARTS, "right"))
        start = int(base[begin:end].min())
        h = Hashes(data[start : int(base[begin:end].max()) + threshold], 3)
        found = h(base[begin:end] - start, base[begin:end] - start + threshold - rest)
        common[begin:end] = _mixed(found).view(np.int64)
        begin = end
    left = base[:, None] + np.arange(-rest, 0)
    right = base[:, None] + np.arange(threshold - rest, threshold)
    index = np.concatenate([left, right], axis=1)
    column = np.arange(2 * rest)
    used = (column >= rest - high[:, None]) & (column < 2 * rest - low[:, None])
    beside = np.where(used, data[np.where(used, index, 0)], 0).astype(np.uint8)
    return gram[of], number, common, beside, low, high, base


def pieces(texts: DataFrame, kinds: DataFrame, threshold: int) -> DataFrame:
    """Rows of pass 2: one run of each kind, met with its text (packed) again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, n, held = [], 0, 0
            for i, (size, packed, found) in enumerate(zip(*(batch.column(c) for c in ("size", "packed", "runs")), strict=True)):
                data = np.frombuffer(pa.decompress(packed.as_py(), size.as_py(), "zstd", asbytes=True), dtype=np.uint8)
                flat = found.values
                gram, place = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                order = np.argsort(place, kind="stable")
                for part in np.array_split(order, max(1, len(order) // 4096)):
                    # No window starts 1024 bytes before its gram.
                    start, end = max(int(place[part[0]] >> PLACE_BITS) - 1023, 0), int(place[part[-1]] >> PLACE_BITS) + threshold
                    parts.append((i, start, data[start:end], gram[part], place[part]))
                    n, held = n + len(part), held + end - start
                    if n >= 4096 or held >= ROWS:
                        yield rows(batch, parts)
                        parts, n, held = [], 0, 0
            if parts:
                yield rows(batch, parts)

    def rows(batch: pa.RecordBatch, parts: list[tuple]) -> pa.RecordBatch:
        texts, starts, data, gram, place = zip(*parts, strict=True)
        begins = np.cumsum([0, *map(len, data)])[:-1]
        shift = begins - np.array(starts)
        place = np.concatenate([p + (s << PLACE_BITS) for p, s in zip(place, shift, strict=True)])
        gram, number, common, beside, low, high, base = pieces_of_runs(np.concatenate(data), np.concatenate(gram), place, threshold)
        n, width = beside.shape
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * width)
        part = np.searchsorted(begins, base, "right") - 1
        at = pa.array(np.array(texts)[part])
        arrays = [
            pa.array(gram), pa.array(number.astype(np.int32)), pa.array(common),
            pa.Array.from_buffers(pa.binary(), n, [None, ends.buffers()[1], pa.py_buffer(beside.tobytes())]),
            pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(base - shift[part]),
            batch.column("rid").take(at), batch.column("rhash").take(at),
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    names = ["gram", "number", "common", "beside", "low", "high", "base", "rid", "rhash"]
    schema = "gram long, number int, common long, beside binary, low int, high int, base long, rid long, rhash long"
    lists = kinds.groupBy("rid", "rhash").agg(F.collect_list(F.struct("gram", "place")).alias("runs"))
    # Repeated rows have one text.
    once = first_per_key(texts.select("rid", "rhash", "size", "packed"), ["rid", "rhash"], [F.col("size")])
    joined = once.join(lists, ["rid", "rhash"])
    return joined.select("rid", "rhash", "size", "packed", "runs").mapInArrow(run, schema)


# --- all passes -------------------------------------------------------------


def _packed(docs: DataFrame, among: Broadcast) -> DataFrame:
    """docs whose key is marked, with the text's size and its compressed bytes instead of text and key."""
    others = [f for f in docs.schema.fields if f.name not in ("text", "key")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            held = batch.filter(pa.array(_marked(among.value, _keys(batch))))
            texts = [t.as_py() for t in held.column("text")]
            arrays = [held.column(f.name) for f in others]
            arrays += [pa.array([len(t) for t in texts], pa.int64()), pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [*[f.name for f in others], "size", "packed"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return docs.mapInArrow(run, f"{schema}, size long, packed binary")


def repeated_windows(docs: DataFrame, threshold: int, parts: Parts | None = None) -> DataFrame:
    """(rid, rhash, low, high, home): ranges of window starts that are repeated.

    docs has rid, rhash, text and key, a hash of rid and rhash. home is the
    smallest key of a text with the same run, null for less than a run. With
    parts, only these of the texts are looked at.
    """
    long = docs.where(F.octet_length("text") >= threshold)
    parts = parts or _whole(long)
    often = marks_of(stored(repeated_grams(parts, threshold), "grams"))
    first = stored(runs(parts, threshold, often), "runs")
    kind = ["gram", "c1", "c2"]
    # One text for the kinds of many: that with the smallest key.
    one = [F.min_by(c, "key").alias(c) for c in ("rid", "rhash", "place")]
    kinds = first.withColumn("key", _key()).groupBy(*kind).agg(F.count("*").alias("n"), F.min("key").alias("home"), *one)
    kinds = stored(kinds, "kinds")
    again = kinds.where("n > 1").select(*kind, "home")
    at, low, high = (F.shiftright("place", PLACE_BITS), F.expr("shiftright(place, 10) & 1023L"), F.expr("place & 1023L"))
    equal = skew_join(first, again.hint("shuffle_hash"), kind, "inner").select("rid", "rhash", (at - low).alias("low"), (at - high).alias("high"), "home")

    # A run alone with its kind can share windows with other kinds; where there is none, all are done.
    several = kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("n").alias("n")).where("kinds > 1 AND n = 1").select("gram")
    mixed = stored(skew_join(kinds, several, ["gram"], "inner").select("gram", "rid", "rhash", "place"), "mixed")
    texts = _packed(long.select("rid", "rhash", "text", "key"), marks_of(mixed.select(_key()).distinct()))
    second = stored(pieces(texts, mixed, threshold), "pieces")
    digit = ["gram", "number", "common"]
    look = F.xxhash64("beside", "low", "high")
    by_digit = second.groupBy(*digit).agg(F.count("*").alias("n"), F.min(look).alias("a"), F.max(look).alias("b"))
    by_digit = by_digit.where("n > 1").select(*digit, F.expr("a <> b").alias("several"))
    # Pieces that are equal wherever their digit is are done, and stay as they are beside the windows of the others.
    here = f"xxhash64(gram, number, common, i) AS place, xxhash64(substring(beside, {PIECE} - i, {PIECE - 1})) AS rest"
    rest = f"transform(sequence(low, high), i -> struct({here}, base - i AS low, base - i AS high))"
    done = "array(struct(CAST(null AS long) AS place, CAST(null AS long) AS rest, base - high AS low, base - low AS high))"
    met = skew_join(second, by_digit.hint("shuffle_hash"), digit, "inner")
    windows = stored(met.select("rid", "rhash", F.expr(f"inline(if(several, {rest}, {done}))")), "windows")
    as_range = ["rid", "rhash", "low", "high", F.lit(None).cast("long").alias("home")]
    equal = equal.unionByName(windows.where("rest IS NULL").select(*as_range))
    windows = windows.where("rest IS NOT NULL").select("place", "rest", "rid", "rhash", "low")
    last = ["place", "rest"]
    twice = windows.groupBy(*last).agg(F.count("*").alias("n")).where("n > 1").select(*last)
    found = skew_join(windows, twice.hint("shuffle_hash"), last, "inner").withColumn("high", F.col("low"))
    return equal.unionByName(found.select(*as_range))


def _lists(found: DataFrame, name: str) -> DataFrame:
    """One row per text: its ranges, each as its first start, its length less one (11 bits), and whether another text is its home."""
    away = F.coalesce((_key() > F.col("home")).cast("long"), F.lit(0))
    packed = F.shiftleft("low", 12) + F.shiftleft(F.col("high") - F.col("low"), 1) + away
    return found.groupBy("rid", "rhash").agg(F.collect_set(packed).alias(name))


def _ranges(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = packed >> 12
    return low, low + (packed >> 1 & 2047)


def _parts(docs: DataFrame, lists: DataFrame, name: str, larger: int, threshold: int) -> Parts:
    """What is left of docs without the windows of `threshold` bytes in runs of `larger` bytes that have another home."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, starts, texts = [], [], []
            for i, (packed, size) in enumerate(zip(batch.column("packed"), batch.column("size").to_pylist(), strict=True)):
                data = pa.decompress(packed.as_py(), size, "zstd", asbytes=True)
                edges = [0]
                if batch.column(name)[i].is_valid:
                    away = batch.column(name)[i].values.to_numpy()
                    low, high = _ranges(away[away & 1 == 1])
                    if len(low):
                        edges += [x for span in _union(low, high + larger - threshold + 1) for x in span]
                edges.append(size - threshold + 1)
                for a, b in zip(edges[::2], edges[1::2], strict=True):
                    if a < b:
                        of.append(i)
                        starts.append(a)
                        texts.append(data[a : b + threshold - 1])
            at = pa.array(of, pa.int64())
            arrays = [batch.column("rid").take(at), batch.column("rhash").take(at), pa.array(starts, pa.int64()), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["rid", "rhash", "start", "text"])

    lists = lists.where(F.exists(name, lambda x: x.bitwiseAND(F.lit(1)) == 1))
    among = marks_of(lists.select(_key()))
    long = docs.where(F.octet_length("text") >= threshold).select("rid", "rhash", "text", "key")
    joined = skew_join(_packed(long, among), lists, ["rid", "rhash"], "left")
    left = joined.select("rid", "rhash", "size", "packed", name).mapInArrow(run, "rid long, rhash long, start long, text binary")
    return [(_whole(long)[0][0], among), (stored(left, "parts").withColumn("key", _key()), None)]


def _key() -> Column:
    return F.xxhash64("rid", "rhash").alias("key")


def cut_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    as_text: bool = False,
    passage: int | None = None,
) -> DataFrame:
    """docs as the struct column `row` (its text null), with n_bytes, spans and kept.

    Texts are UTF-8 bytes; a null text is empty. spans are the maximal removed
    runs of bytes (start, end), in order; kept is what remains. A byte goes if
    a window of `threshold` bytes (40 to 1278) over it also starts anywhere else in docs,
    judged on the texts as given. Texts under the threshold stay whole. Copies
    of a longer text, repeated rows among them, all go. Other columns stay in
    `row`, so their names can't clash. With as_text, kept is a string, without
    the parts of characters that a cut has split. With a second, smaller threshold
    `passage`, a column passages has the spans by it, which are not cut.
    """
    if not LEAST <= threshold <= MOST:
        raise ValueError(f"threshold must lie between {LEAST} and {MOST}")
    if passage is not None and not LEAST <= passage < threshold:
        raise ValueError(f"passage must lie between {LEAST} and the threshold")
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = docs.schema[text_col].dataType
    row = F.struct(*[F.lit(None).cast(kind).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
    ref = row_ref(id_col, text_col)
    rows = docs.select(row.alias("row"), text.cast("binary").alias("text"), ref.alias("ref"))
    rows = rows.select("row", "ref.id", "ref.hash", "text").withColumnsRenamed({"id": "rid", "hash": "rhash"})
    rows = rows.withColumn("key", _key())
    lists = stored(_lists(repeated_windows(rows, threshold), "spans"), "spans")
    if passage is not None:
        shorter = repeated_windows(rows, passage, _parts(rows, lists, "spans", threshold, passage))
        lists = stored(lists.join(_lists(shorter, "passages"), ["rid", "rhash"], "full"), "lists")
    among = marks_of(lists.select(_key()))
    sizes = {"spans": threshold} if passage is None else {"spans": threshold, "passages": passage}

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def cut(row: pa.Array, texts: Iterator[bytes], found: dict[str, pa.Array]) -> pa.RecordBatch:
        size, kept, spans = [], [], {name: [] for name in sizes}
        for i, data in enumerate(texts):
            starts, ends = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            for name, least in sizes.items():
                if found[name][i].is_valid:
                    low, high = _ranges(found[name][i].values.to_numpy())
                    # What the larger threshold has found belongs to the smaller one too.
                    starts, ends = np.append(starts, low), np.append(ends, high + least)
                spans[name].append([{"start": a, "end": b} for a, b in _union(starts, ends)])
            edges = [0, *[x for s in spans["spans"][-1] for x in (s["start"], s["end"])], len(data)]
            parts = [data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
            size.append(len(data))
            kept.append("".join(p.decode("utf-8", "ignore") for p in parts) if as_text else b"".join(parts))
        arrays = [row, pa.array(size, pa.int64()), *[pa.array(spans[n], pa.list_(span)) for n in sizes]]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(kept, pa.string() if as_text else pa.binary())], names)

    def cut_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = zip(batch.column("packed"), batch.column("size"), strict=True)
            texts = (pa.decompress(p.as_py(), n.as_py(), "zstd", asbytes=True) for p, n in packed)
            yield cut(batch.column("row"), texts, {name: batch.column(name) for name in sizes})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(pa.array(~_marked(among.value, _keys(batch))))
            texts, n = rest.column("text"), rest.num_rows
            none = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, dtype=np.int32)), pa.array([], span))
            kept = pa.array([t.as_py().decode("utf-8", "ignore") for t in texts], pa.string()) if as_text else texts
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([rest.column("row"), size, *[none] * len(sizes), kept], names)

    names = ["row", "n_bytes", *sizes, "kept"]
    ranges = ", ".join(f"{name} array<struct<start: bigint, end: bigint>>" for name in sizes)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_bytes long, {ranges}, kept {'string' if as_text else 'binary'}"
    joined = skew_join(_packed(rows, among), lists, ["rid", "rhash"], "left")
    done = joined.select("row", "size", "packed", *sizes).mapInArrow(cut_found, schema)
    return done.unionByName(rows.select("row", "text", "key").mapInArrow(whole, schema))


def _union(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return list(zip(start[first].tolist(), end[last].tolist(), strict=True))
