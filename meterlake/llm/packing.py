"""Best-fit packing of token sequences by a configuration linear program.

Only the histogram of lengths decides how sequences are filled, and it has at
most `capacity` entries however many documents there are. The driver solves
the packing of the histogram: a covering linear program over configurations
(multisets of length classes that fit one sequence) by multiplicative weights,
whose pricing step is a knapsack over the class sizes; the solution is rounded
down, and what is left goes by best fit into the room that remains. The plan
is a short table of runs (length, ranks, sequences), and the tasks look up
every piece's sequence by its rank within its length.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import numbered, stored, tokenizer_file

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
CLASS_WIDTH = 16
SMALL = 128  # lengths kept out of the program; they fill the room that rounding leaves
STEP = 0.05
CACHED_WORDS = 120_000
STOPS = ".,;:!?$%&#*+-=/()[]{}\"@^_~"  # a run of these after a word is a unit of its own
# Letters below U+0180 but U+0130 have one lower case letter each and are in normal form.
LETTERS = "A-Za-z\\u00aa\\u00b5\\u00ba\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u012f\\u0131-\\u017f"
# One word a line: letters and the run after them, or anything else.
WORD = re.compile(f"^(?:([{LETTERS}]+)([{re.escape(STOPS)}]*)|(.*))$", re.MULTILINE)
UNUSUAL = re.compile("[\\u0130\\u0180-\\U0010ffff]|<\\|")  # not to be lowered as a whole
BATCH = 1 << 20

# --- tokens -----------------------------------------------------------------


class Numbers(dict):
    """Numbers keys in the order they are met."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class WordCoder:
    """Token ids of whole texts, word by word, as little-endian 32-bit bytes.

    The tokenizer drops white space and never looks across it, so the ids of a
    text are those of its words. A word is one or two units with known ids; the
    new units of many texts are encoded together. Units of plain letters go to
    the file's model alone, as they need no more than lower case; a unit's last
    token is marked in the vocabulary.
    """

    def __init__(self, path: str):
        # Tasks run side by side already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            bare = json.load(file)
        split = [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        bare |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": split}, "added_tokens": []}
        self.model = Tokenizer.from_str(json.dumps(bare))
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Start again with the empty word, which is twice the empty unit."""
        self.words, self.units = Numbers({"": 0}), Numbers({"": 0})
        self.parts = np.zeros((1, 2), dtype=np.int32)  # units of each word
        self.size, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<u4")

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        if len(self.words) > CACHED_WORDS:
            self.forget()
        texts = [t.lower() if (t.isascii() and "<|" not in t) or not UNUSUAL.search(t) else t for t in texts]
        words = [t.replace("\n", " ").split(" ") for t in texts]
        ends = np.cumsum([len(w) for w in words])
        at = np.fromiter(map(self.words.__getitem__, chain.from_iterable(words)), dtype=np.int32, count=int(ends[-1]))
        self.learn(list(islice(self.words, len(self.parts), None)))
        units = self.parts[at].ravel()
        size = self.size[units]
        after = np.cumsum(size)
        first = (np.cumsum(self.size) - self.size)[units]
        ids = self.ids[np.repeat(first - after + size, size) + np.arange(after[-1])]
        stops = after[2 * ends - 1].tolist()  # a text has a word at least, the empty one
        return [ids[a:b].tobytes() for a, b in zip([0, *stops], stops, strict=False)]

    def learn(self, new: list[str]) -> None:
        found = WORD.findall("\n".join(new)) if new else []
        cores, tails, odd = zip(*found, strict=True) if found else ((), (), ())
        number = lambda units: np.fromiter(map(self.units.__getitem__, units), dtype=np.int32, count=len(found))
        known = len(self.units)
        first = number(cores)
        plain = list(islice(self.units, known, None))
        # A word that is no plain unit with a tail has no core, and the empty unit is 0.
        parts = np.stack([first + number(odd), number(tails)], axis=1)
        other = list(islice(self.units, known + len(plain), None))
        self.parts = np.concatenate([self.parts, parts])
        ids, size = self.encode_plain(plain)
        rest = [x.ids for x in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
        self.ids = np.concatenate([self.ids, ids, np.fromiter(chain.from_iterable(rest), dtype="<u4")])
        self.size = np.concatenate([self.size, size, np.array([len(x) for x in rest], dtype=np.int64)])

    def encode_plain(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, and how many each has."""
        ids = np.array(self.model.encode_batch_fast([" ".join(units).lower()], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(units) or len(ids) != (ends[-1] if len(ends) else 0):
            raise ValueError("the tokenizer does not encode words of letters as units")
        return ids, np.diff(ends, prepend=0)


@cache
def coder(path: str) -> WordCoder:
    """One per Python worker, so that its cache serves many tasks."""
    return WordCoder(path)


def grouped(texts: pa.Array, most: int = BATCH) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts (null: empty) of some megabytes together, with the place of the first."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= most:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ids, as an array, if asked for).

    A document's ids end with id 1; longer ones are cut every `capacity`
    tokens. A null or empty text is the one id 1. Repeated rows are separate
    documents.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()
    size = 4 * capacity
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer or tokenizer_file(VOCABULARY))
        for batch in batches:
            for first, texts in grouped(batch.column(1)):
                rows = []
                for i, coded in enumerate(code(texts), first):
                    coded += end
                    for piece, at in enumerate(range(0, len(coded), size)):
                        part = coded[at : at + size]
                        rows.append((i, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else b""))
                yield pieces(batch.column(0), rows)

    def pieces(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        at, piece, start, length, crc, parts = zip(*rows, strict=True)
        columns = [ids.take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                   pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = ["id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            flat = np.frombuffer(b"".join(parts), dtype="<i4")
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


# --- the packing of a histogram ---------------------------------------------


def _price(values: np.ndarray, units: int) -> tuple[list[int], float]:
    """Unbounded knapsack: the multiset of classes (class k takes k units) of the highest value."""
    best = np.zeros(units + 1)
    pick = np.zeros(units + 1, dtype=np.int64)
    for room in range(1, units + 1):
        gains = values[1 : room + 1] + best[room - 1 :: -1][:room]
        k = int(gains.argmax())
        if gains[k] > best[room - 1]:
            best[room], pick[room] = gains[k], k + 1
        else:
            best[room], pick[room] = best[room - 1], 0
    chosen, room = [], units
    while room > 0:
        if pick[room]:
            chosen.append(int(pick[room]))
            room -= int(pick[room])
        else:
            room -= 1
    return chosen, float(best[units])


def configurations(demand: dict[int, int], units: int, step: float = STEP) -> dict[tuple[int, ...], float]:
    """Fractional covering of the demand per class by configurations.

    Multiplicative weights: a class weighs less the more of it is covered; the
    knapsack finds the configuration of the highest weight, and it is taken as
    often as covers its scarcest class by the share `step`. A class that is
    covered leaves. The result covers every class once, up to a factor of
    1 + step.
    """
    need = np.zeros(units + 1)
    for k, n in demand.items():
        need[k] = n
    covered = np.zeros(units + 1)
    open_ = need > 0
    taken: dict[tuple[int, ...], float] = defaultdict(float)
    while open_.any():
        share = np.divide(covered, need, out=np.ones_like(need), where=need > 0)
        # A class is worth its room, more the less of it is covered.
        values = np.where(open_, np.arange(units + 1) * np.exp(-share / (4 * step)), -1.0)
        # The plain room breaks ties, so that configurations are full.
        values = np.where(open_, values / max(values.max(), 1e-300) + 1e-3 * np.arange(units + 1) / units, -1.0)
        chosen, _ = _price(values, units)
        counts = Counter(chosen)
        times = min(max(step * need[k], 1.0) / n for k, n in counts.items())
        times = min(times, *((need[k] - covered[k]) / n for k, n in counts.items()))
        taken[tuple(sorted(chosen, reverse=True))] += times
        for k, n in counts.items():
            covered[k] += n * times
            if covered[k] >= need[k] * (1 - 1e-9):
                open_[k] = False
    return dict(taken)


@dataclass
class Plan:
    """Runs by (length, rank): pieces of `length` ranked rank, rank + 1, ... lie in sequences first, first + 1, ..."""

    length: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    sequences: int


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, width: int = CLASS_WIDTH, small: int = SMALL) -> Plan:
    """Pack a histogram of lengths (1 to capacity) into few sequences of the capacity."""
    left = {length: n for length, n in histogram.items() if n > 0}
    given: Counter = Counter()
    runs: list[tuple[int, int, int]] = []
    bins = 0
    if full := left.pop(capacity, 0):
        runs.append((capacity, 0, 0))
        bins = full
    units = capacity // width
    classes: dict[int, list[int]] = defaultdict(list)
    for length in sorted(left):
        if length >= small and -(-length // width) <= units:
            classes[-(-length // width)].append(length)
    demand = {k: sum(left[x] for x in lengths) for k, lengths in classes.items()}

    groups: list[tuple[int, int, int]] = []  # room, first sequence, sequences

    def place(length: int, n: int, first: int) -> None:
        runs.append((length, given[length], first))
        given[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]

    for config, share in sorted(configurations(demand, units).items(), reverse=True):
        times = min(int(share + 1e-6), *(sum(left.get(x, 0) for x in classes[k]) // n for k, n in Counter(config).items()))
        if not times:
            continue
        open_runs = [(capacity, bins, times)]
        bins += times
        for k in config:
            # The longest of the class first; a run splits where one length runs out.
            after = []
            for room, first, n in open_runs:
                while n:
                    length = next(x for x in reversed(classes[k]) if x in left)
                    m = min(n, left[length])
                    place(length, m, first)
                    after.append((room - length, first, m))
                    first, n = first + m, n - m
            open_runs = after
        groups += open_runs

    # Best fit of the rest, longest first, a whole run of equal lengths at a time.
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for room, first, n in groups:
        rooms[room].append((first, n))
    order = sorted(rooms)
    for length in sorted(left, reverse=True):
        while n := left.get(length, 0):
            at = bisect.bisect_left(order, length)
            while at < len(order) and not rooms[order[at]]:
                order.pop(at)
            if at < len(order):
                room = order[at]
                first, m = rooms[room].pop()
                each = 1
            else:
                # New sequences, each filled with this length as often as fits.
                each = min(capacity // length, n)
                room, first, m = capacity, bins, max(n // each, 1)
                bins += m
            m_used = min(m, n // each)
            for _ in range(each):
                place(length, m_used, first)
                room -= length
            if m_used < m:
                back = room + each * length
                rooms[back].append((first + m_used, m - m_used))
                if back not in order[max(bisect.bisect_left(order, back), 0) : bisect.bisect_right(order, back)]:
                    bisect.insort(order, back)
            if room:
                rooms[room].append((first, m_used))
                if order[bisect.bisect_left(order, room) : bisect.bisect_right(order, room)] == []:
                    bisect.insort(order, room)
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 3)
    return Plan(table[:, 0], table[:, 1], table[:, 2], bins)


# --- packing of documents ---------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to the rows of token_pieces.

    The histogram (one entry per length) comes to the driver and the plan's
    runs go back to the tasks; both are bounded by the capacity. Pieces of one
    length are numbered in blocks, so that a length may hold any share of all
    rows. An empty table gives an empty result. Repeated rows are packed each.
    """
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(histogram, capacity)
    ranked = numbered(pieces, ["length"], ["id", "piece", "ids_crc32", "start"], "_at")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.searchsorted(plan.length, np.arange(capacity + 2))
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_at").to_numpy()
            at = np.empty(len(rank), dtype=np.int64)
            for value in np.unique(length):
                mine = length == value
                low, high = starts[value], starts[value + 1]
                at[mine] = low + np.searchsorted(plan.rank[low:high], rank[mine], side="right") - 1
            sequence = plan.first[at] + rank - plan.rank[at]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sequence)], [*names, "sequence_id"])

    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long"
    placed = ranked.mapInArrow(find, schema)
    # At most `capacity` pieces share a sequence.
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "id", "piece")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """token_pieces and pack; the pieces, without their ids, are stored between the two."""
    return pack(stored(token_pieces(docs, id_col, text_col, capacity, tokenizer), "pieces"), capacity)
