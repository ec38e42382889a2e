"""SentencePiece encoding and decoding with the n best segmentations.

The pieces that fit a text form a lattice over its characters. A forward
Viterbi pass gives the best score from the start to every place; these scores
are exact heuristics for an A-star search backward from the end, which then
yields the segmentations in order of their scores and expands no path in vain.

No piece crosses certain pairs of characters (a pair that occurs inside no
piece, such as a letter and the space mark after it). The lattice of a text
is a chain of the lattices between such places. Each part's best two are
searched once and kept, and the n best of the text are combined from those of
the parts whose second choice costs least.

Scores: the vocabulary has ranks, not probabilities. A piece of rank r has the
log-probability -ln(r + 1) (Zipf's law), in steps of 2^-20, so that sums are
whole numbers and ties are ties. A byte, used for characters without a piece,
has the rank of the vocabulary's size.
"""

from __future__ import annotations

import bisect
import heapq
import math
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import tokenizer_file

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
UNIT = 1 << 20
CACHED_PARTS = 900_000
BATCH = 8 << 20
# A chain's coarse parts; finer ones are found from the vocabulary.
COARSE = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

# Per path: score, pieces, ids as little-endian 32-bit bytes.
Path = tuple[int, int, bytes]
# The best path, and the loss of the second (None where there is none).
Entry = tuple[int, int, bytes, int | None]


class Lattice:
    """The vocabulary of a model file, and n-best search with it."""

    def __init__(self, path: str, n: int):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size, self.n = model.get_piece_size(), n
        self.surface: list[bytes] = [b""] * size
        # Character to [further characters, (ids, score) of the piece that ends here].
        self.trie: dict[str, list] = {}
        self.bytes: dict[int, int] = {}
        self.longest = 1
        pairs: set[str] = set()
        crossing = False
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i):
                continue
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value], self.surface[i] = i, bytes([value])
                continue
            rank = min(-model.get_score(i), size)
            node: list = [self.trie, None]
            self.longest = max(self.longest, len(piece))
            for ch in piece:
                node = node[0].setdefault(ch, [{}, None])
            node[1] = ((i,), -round(UNIT * math.log(rank + 1)))
            crossing |= "\n" in piece or SPACE in piece.lstrip(SPACE)
            self.surface[i] = piece.replace(SPACE, " ").encode()
            pairs.update(piece[k : k + 2] for k in range(len(piece) - 1))
        self.byte_score = -round(UNIT * math.log(size + 1))
        self.pairs = pairs
        if crossing:
            raise ValueError("the vocabulary has pieces across words or lines")
        self.cache: dict[str, Entry] = {}

    def forward(self, text: str) -> tuple[list[list[tuple[int, int, tuple[int, ...]]]], list[int]]:
        """For every place, the pieces that end there (start, score, ids) and the best score from the start (Viterbi)."""
        size, trie = len(text), self.trie
        ends: list[list[tuple[int, int, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        best: list[int] = [0, *[-(1 << 62)] * size]
        for start in range(size):
            reached, children, end = best[start], trie, start
            for ch in text[start : start + self.longest]:
                node = children.get(ch)
                if node is None:
                    break
                end += 1
                children, found = node
                if found is not None:
                    ids, score = found
                    ends[end].append((start, score, ids))
                    score += reached
                    if score > best[end]:
                        best[end] = score
            # The piece of one character, if there is one, is the first that was added behind it.
            if not ends[start + 1] or ends[start + 1][-1][0] != start:
                raw = text[start].encode("utf-8", "surrogatepass")
                score = len(raw) * self.byte_score
                ends[start + 1].append((start, score, tuple(self.bytes[b] for b in raw)))
                best[start + 1] = max(best[start + 1], reached + score)
        return ends, best

    def best(self, text: str) -> Entry:
        """The best segmentation of one part, and what the second one loses.

        The search's first step: along the best path, the least loss of a piece
        beside it is that of the next path.
        """
        ends, best = self.forward(text)
        place, ids, second = len(text), (), None
        while place:
            follow, reached = None, best[place]
            for start, score, piece in ends[place]:
                less = reached - best[start] - score
                if less == 0 and follow is None:
                    follow, behind = start, piece
                elif second is None or less < second:
                    second = less
            place, ids = follow, behind + ids
        return best[-1], len(ids), array("I", ids).tobytes(), second

    def search(self, text: str, n: int) -> list[Path]:
        """The n best segmentations of one part, best first; equal ones in the order they are met.

        A path is followed from the end along best predecessors, at no loss
        against the heuristic; each other piece on the way is a path of its
        own, with its loss, and waits. The one that loses least is next. Only as many
        wait as can still be among the n best.
        """
        ends, best = self.forward(text)
        waiting: list[tuple[int, int, int, tuple[int, ...]]] = [(0, 0, len(text), ())]
        met, out = 0, []
        while waiting:
            loss, _, place, ids = waiting.pop(0)
            room = n - 1 - len(out)
            while place:
                follow, reached = None, best[place]
                for start, score, piece in ends[place]:
                    less = reached - best[start] - score
                    if less == 0 and follow is None:
                        follow = (start, piece)
                    elif len(waiting) < room or (room and loss + less < waiting[-1][0]):
                        met += 1
                        bisect.insort(waiting, (loss + less, met, start, piece + ids))
                        del waiting[room:]
                place, piece = follow
                ids = piece + ids
            out.append((best[-1] - loss, len(ids), array("I", ids).tobytes()))
            if len(out) == n:
                break
        return out

    def fine(self, part: str) -> list[str]:
        """A coarse part, cut at pairs that occur in no piece."""
        if all(map(self.pairs.__contains__, map(add, part, part[1:]))):
            return [part]
        cuts = [k for k in range(1, len(part)) if part[k - 1 : k + 1] not in self.pairs]
        return [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True)]

    def entry(self, part: str) -> Entry:
        """The best of a part, and what its second choice loses."""
        found = self.cache.get(part)
        if found is None:
            fine = self.fine(part)
            if len(fine) > 1:
                every = [self.cache.get(x) or self.entry(x) for x in fine]
                losses = [e[3] for e in every if e[3] is not None]
                ids = b"".join([e[2] for e in every])
                found = (sum([e[0] for e in every]), sum([e[1] for e in every]), ids, min(losses, default=None))
            else:
                found = self.best(part)
            if len(self.cache) >= CACHED_PARTS:
                self.cache.clear()
            self.cache[part] = found
        return found

    def paths(self, part: str) -> list[Path]:
        fine = self.fine(part)
        return self.chain(fine) if len(fine) > 1 else self.search(part, self.n)

    def chain(self, parts: list[str]) -> list[Path]:
        """The n best of a chain of parts; ties to the earlier part's better choice.

        Only the n - 1 parts whose second choice loses least can take another than their best.
        """
        cached = self.cache
        every = [cached.get(p) or self.entry(p) for p in parts]
        score, count, ids = sum([e[0] for e in every]), sum([e[1] for e in every]), [e[2] for e in every]
        loss = [(e[3], i) for i, e in enumerate(every) if e[3] is not None]
        open_ = sorted(i for _, i in heapq.nsmallest(self.n - 1, loss))
        options = [self.paths(parts[i]) for i in open_]
        out = []
        for lost, pick in self.picks([[o[0][0] - p[0] for p in o] for o in options]):
            more = 0
            for i, o, k in zip(open_, options, pick, strict=True):
                ids[i] = o[k][2]
                more += o[k][1] - o[0][1]
            out.append((score - lost, count + more, b"".join(ids)))
        return out

    def picks(self, losses: list[list[int]]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """The n choices, one of each rising list, that lose least in all, with their loss; ties to the earlier list's better choice.

        A choice is followed by those with one more step in its last changed
        list or a later one, so every choice waits once, behind a smaller one.
        """
        waiting = [(0, (0,) * len(losses), 0)]
        for _ in range(self.n):
            if not waiting:
                return
            lost, pick, last = heapq.heappop(waiting)
            yield lost, pick
            for i in range(last, len(losses)):
                if (k := pick[i] + 1) < len(losses[i]):
                    heapq.heappush(waiting, (lost + losses[i][k] - losses[i][k - 1], (*pick[:i], k, *pick[i + 1 :]), i))

    def encode(self, text: str) -> list[Path]:
        """The n best segmentations of a text; an empty one has the one without pieces."""
        if not text:
            return [(0, 0, b"")]
        return self.chain(COARSE.findall(SPACE + text.replace(" ", SPACE)))

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return raw.decode("utf-8", "replace")[1:]


@cache
def lattice(path: str, n: int) -> Lattice:
    """One per Python worker, so that its cache serves many tasks."""
    return Lattice(path, n)


def encode(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, with_ids: bool = True) -> DataFrame:
    """id, rank (from 1), score, n_pieces, ids_crc32, round_trip, and ids if asked for: the n best of every text.

    round_trip says whether decoding gives the text back; it does but for texts
    with the space mark itself. A null or empty text has one segmentation
    without pieces; short texts may have fewer than n. Repeated rows are
    segmented each.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = lattice(model or tokenizer_file(VOCABULARY), n)
        for batch in batches:
            rows, held = [], 0
            for i, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                for rank, (score, count, ids) in enumerate(lat.encode(text), 1):
                    back = lat.decode(ids) == text
                    rows.append((i, rank, score / UNIT, count, zlib.crc32(ids), back, ids if with_ids else b""))
                    held += len(rows[-1][6])
                if held > BATCH or i + 1 == len(batch):
                    yield table_of(batch.column(0), rows)
                    rows, held = [], 0

    def table_of(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        at, rank, score, count, crc, back, coded = zip(*rows, strict=True)
        arrays = [ids.take(pa.array(at, pa.int64())), pa.array(rank, pa.int32()), pa.array(score, pa.float64()),
                  pa.array(count, pa.int64()), pa.array(crc, pa.int64()), pa.array(back)]
        names = ["id", "rank", "score", "n_pieces", "ids_crc32", "round_trip"]
        if with_ids:
            ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), dtype="<i4"), pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(rows: DataFrame, ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """rows with the column `decoded`: the text of an array of piece ids (null for null ids)."""
    @F.pandas_udf("string")
    def text_of(series):
        lat = lattice(model or tokenizer_file(VOCABULARY), 1)
        return series.map(lambda ids: None if ids is None else lat.decode(np.asarray(ids, dtype="<u4").tobytes()))

    return rows.withColumn("decoded", text_of(F.col(ids_col)))
