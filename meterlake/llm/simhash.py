"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints of 64 bits that differ in few bits are found with a covering
code: every word has a codeword, its home, within the covering radius R. If x
and y differ in t bits, y is within R + t of x's home. So every fingerprint is
copied to all codewords within R + t, and at every codeword the fingerprints
at home there are compared with all copies.

The code is a product of binary Golay codes (23 bits, R = 3, perfect), one per
block of bits; bits beyond the blocks are free. The t differing bits are
spread over the blocks, so a copy goes to the products of codewords whose
distances exceed R by t in all blocks together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.keyed import first_per_key, skew_join
from meterlake.llm.common import pieces_of, stored

SHINGLE = 3
SEED = 42
THRESHOLD = 3
BLOCKS = (23, 23)
GENERATOR = 0b110001110101  # fixed value: generator polynomial of the binary Golay code
CHECK_BITS = 11
MAP_BITS = 24  # a map of home codewords is made up to 2^24 of them (2 MB)
PAIRS_AT_ONCE = 1 << 21
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# --- fingerprints -----------------------------------------------------------


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles, repeats counted; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(width)], strict=False))
    n = max(len(words) - width + 1, 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), dtype=">u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """id, text_hash, fp (the fingerprint as a signed long) per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["id", "text_hash", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, text_hash long, fp long")


# --- the covering code ------------------------------------------------------


def _remainder(words: np.ndarray, n: int) -> np.ndarray:
    rest = words.copy()
    for bit in range(n - 1, CHECK_BITS - 1, -1):
        rest ^= np.where((rest >> bit) & 1, GENERATOR << (bit - CHECK_BITS), 0)
    return rest


class Code:
    """A Golay code shortened to n bits: homes, and the codewords near a word.

    `leader` has the nearest codeword's difference by syndrome. `near` lists,
    by syndrome, the indices to be added to the home's for all codewords within
    radius + slack, sorted by their excess over the radius; `ends` has the end
    of each excess.
    """

    def __init__(self, n: int, slack: int = THRESHOLD):
        self.n, self.mask = n, (1 << n) - 1
        messages = np.arange(1 << (n - CHECK_BITS), dtype=np.int64) << CHECK_BITS
        codewords = messages | _remainder(messages, n)
        self.leader = np.full(1 << CHECK_BITS, -1, dtype=np.int64)
        weight = 0
        while (self.leader < 0).any():
            words = np.array([sum(1 << i for i in bits) for bits in combinations(range(n), weight)], dtype=np.int64)
            found, first = np.unique(_remainder(words, n), return_index=True)
            new = self.leader[found] < 0
            self.leader[found[new]] = words[first[new]]
            self.radius, weight = weight, weight + 1
        distance = np.bitwise_count(self.leader[:, None] ^ codewords[None, :]).astype(np.int64)
        excess = np.maximum(distance - self.radius, 0)
        order = np.argsort(excess, axis=1, kind="stable")
        sizes = [(excess <= e).sum(axis=1) for e in range(slack + 1)]
        self.start = np.concatenate([[0], np.cumsum(sizes[-1])])[:-1]
        self.ends = np.stack(sizes, axis=1)
        kept = np.arange(order.shape[1])[None, :] < sizes[-1][:, None]
        self.near = order[kept]
        self.excess = np.take_along_axis(excess, order, axis=1)[kept]

    def split(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Syndrome and index of the home of each word."""
        syndrome = _remainder(words, self.n)
        return syndrome, (words ^ self.leader[syndrome]) >> CHECK_BITS


@cache
def code(n: int, slack: int = THRESHOLD) -> Code:
    return Code(n, slack)


def _blocks(fps: np.ndarray, lengths: Sequence[int]) -> list[np.ndarray]:
    words, shift = [], 0
    for n in lengths:
        words.append(((fps >> np.uint64(shift)) & np.uint64((1 << n) - 1)).astype(np.int64))
        shift += n
    return words


def home_anchor(fps: np.ndarray, lengths: Sequence[int] = BLOCKS) -> np.ndarray:
    anchor = np.zeros(len(fps), dtype=np.int64)
    for n, words in zip(lengths, _blocks(fps, lengths), strict=True):
        anchor = (anchor << (n - CHECK_BITS)) | code(n).split(words)[1]
    return anchor


def anchors(fps: np.ndarray, lengths: Sequence[int] = BLOCKS, slack: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """All (position in fps, anchor) within the radius plus slack."""
    at = np.arange(len(fps))
    anchor = np.zeros(len(fps), dtype=np.int64)
    left = np.full(len(fps), slack, dtype=np.int64)
    for n, words in zip(lengths, _blocks(fps, lengths), strict=True):
        c = code(n, slack)
        syndrome, home = c.split(words)
        s = syndrome[at]
        count = c.ends[s, left]
        entry = np.repeat(c.start[s] - np.cumsum(count) + count, count) + np.arange(count.sum())
        at, anchor, left = np.repeat(at, count), np.repeat(anchor, count), np.repeat(left, count)
        anchor = (anchor << (n - CHECK_BITS)) | (home[at] ^ c.near[entry])
        left = left - c.excess[entry]
    return at, anchor


# --- links ------------------------------------------------------------------


class Forest:
    """Union-find over the links a task sees; its edges are as good as all of them."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def add(self, pairs: np.ndarray) -> None:
        for a, b in pairs.tolist():
            a, b = self.root(a), self.root(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)

    def edges(self) -> np.ndarray:
        found = [(x, self.root(x)) for x in list(self.parent)]
        return np.array([p for p in found if p[0] != p[1]], dtype=np.int64).reshape(-1, 2)


def _at_homes(copies: DataFrame, distinct: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """The copies at codewords where a fingerprint is at home.

    The homes are one bit per codeword, a scalar whose size depends on the code
    alone; for larger codes than MAP_BITS all copies stay.
    """
    bits = sum(n - CHECK_BITS for n in lengths)
    if bits > MAP_BITS:
        return copies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = home_anchor(batch.column(0).to_numpy().view(np.uint64), lengths)
            yield pa.RecordBatch.from_arrays([pa.array(home >> 6), pa.array(np.left_shift(1, home & 63))], ["word", "bit"])

    words = distinct.mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = distinct.sparkSession.range(1 << max(bits - 6, 0)).withColumnRenamed("id", "word")
    words = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    homes = words.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("m")).select("m.bits").scalar()
    marked = copies.withColumn("_homes", homes)
    used = "shiftrightunsigned(get(_homes, cast(shiftright(place, 7) AS int)), cast(shiftright(place, 1) & 63L AS int)) & 1L = 1L"
    return marked.where(F.expr(used)).drop("_homes")


def links(distinct: DataFrame, lengths: Sequence[int] = BLOCKS, threshold: int = THRESHOLD) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fp within the threshold.

    distinct has the column fp without repeats. Copies at codewords where
    nobody is at home are not exchanged. Within one codeword the homes (distinct
    fingerprints of one Hamming ball) are held and the copies streamed past
    them; a task sends its links as a forest.
    """

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for start in range(0, len(every), 2048):
                fps = every[start : start + 2048]
                at, anchor = anchors(fps, lengths, threshold)
                away = (anchor != home_anchor(fps, lengths)[at]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(2 * anchor + away), pa.array(fps[at].view(np.int64))], ["place", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, here, held = Forest(), -1, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            place = batch.column(0).to_numpy()
            fps = batch.column(1).to_numpy().view(np.uint64)
            anchor = place >> 1
            if not len(anchor):
                continue
            # Homes in order of their anchors, with those of the anchor that the last batch ended in.
            own = place & 1 == 0
            home_at, home_fp = anchor[own], fps[own]
            if here == anchor[0]:
                home_at, home_fp = np.concatenate([np.full(len(held), here), home_at]), np.concatenate([held, home_fp])
            low, high = np.searchsorted(home_at, anchor, "left"), np.searchsorted(home_at, anchor, "right")
            count = high - low
            begin = 0
            while begin < len(count):
                sums = np.cumsum(count[begin : begin + PAIRS_AT_ONCE])
                step = max(int(np.searchsorted(sums, PAIRS_AT_ONCE, "right")), 1)
                part = slice(begin, begin + step)
                n = count[part]
                x = np.repeat(fps[part], n)
                y = home_fp[np.repeat(low[part] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                near = (np.bitwise_count(x ^ y) <= threshold) & (x != y)
                if near.any():
                    forest.add(np.unique(np.stack([x[near], y[near]], axis=1).view(np.int64), axis=0))
                begin += step
            here = anchor[-1]
            held = home_fp[home_at == here]
        found = forest.edges()
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    n = pieces_of(distinct.sparkSession)
    sent = distinct.repartition(n, "fp").mapInArrow(copies, "place long, fp long")
    met = _at_homes(sent, distinct, lengths).repartition(n, F.shiftright("place", 1)).sortWithinPartitions("place")
    return met.mapInArrow(compare, "a long, b long")


# --- components -------------------------------------------------------------


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until
    nothing changes; every round's edges are written to the shared folder. A
    node with very many edges is no single task's: minima are pre-aggregated
    and the joins back can be split.
    """

    def star(both: DataFrame) -> DataFrame:
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return skew_join(both, least, ["a"], "inner")

    def settle(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        small = star(down)
        out = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame) -> tuple:
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return row.n, row.s

    now = stored(edges, name)
    last = mark(now)
    while last[0]:
        now = stored(settle(now), name)
        seen = mark(now)
        if seen == last:
            break
        last = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def with_components(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows (id, text_hash, fp) with component, the smallest id of the component of fp under the edges, and root, its smallest fp.

    The root tells components apart also where ids repeat or are null.
    """
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(stored(edges, "links"))
    nodes = distinct.join(roots, distinct.fp == roots.node, "left")
    nodes = nodes.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component"))
    nodes = skew_join(nodes.select("fp", "root"), least, ["root"], "inner").select("fp", "component", "root")
    return skew_join(rows, nodes, ["fp"], "inner")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """id, text_hash, fp, component, root per row of docs; component is the smallest id of the component, root its smallest fp.

    Texts without words (null and empty ones too) have fingerprint 0 and link
    like any other. Rows with equal fingerprints, copies and repeated rows
    among them, are one node. A null id counts only where its component has no
    other; then the component is null. Other columns are not read.
    """
    rows = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    return with_components(rows, links(rows.select("fp").distinct()))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """docs with one row of each component: the one with the smallest id, then text hash.

    A repeated row (same id and text) that would stay is kept once. A row without
    id is kept only if no row of its component has one. An id that occurs in
    several components stays in each.
    """
    return keep_one(docs, near_duplicates(docs, id_col, text_col, width), id_col, text_col)


def keep_one(docs: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component in marked (id, text_hash, fp, component, root)."""
    kept = first_per_key(marked, ["root"], [F.col("id").asc_nulls_last(), F.col("text_hash")])
    smallest = F.lit(-(2**63)).cast("long")
    kept = kept.select(F.coalesce("id", smallest).alias("_id"), F.coalesce("text_hash", F.lit(0)).alias("_hash"))
    # One exchange serves the join and the choice among repeated rows.
    named = docs.withColumns({"_id": F.coalesce(id_col, smallest), "_hash": F.xxhash64(text_col)})
    found = named.join(kept, ["_id", "_hash"], "left_semi")
    return first_per_key(found, ["_id", "_hash"], [F.lit(0)]).drop("_id", "_hash")


def hex_of(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
