"""Token files, pieces and packing."""

import itertools
import zlib

import numpy as np
import pytest
from helpers import documents, words
from tokenizers import Tokenizer

from meterlake.llm import packing, pieces, tokenfiles
from meterlake.llm.common import tokenizer_file

HARD = ["", None, "a b  c\n\n d \n", "<|endoftext|> x<|endoftext|>", "x" * 70_000, "ab c,  d\n\n" * 9000, "é 😀 " * 9000,
        "don't WE'LL 12 3.5", "İstanbul ΣΑΣ ǅ", "\x1c\x1d a\x85b", "é é", "x", "x"]


@pytest.mark.parametrize("block", [5, 64, 1 << 19])
def test_token_files_give_every_count(spark, tmp_path, block):
    plain = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    want = [len(plain.encode(t or "", add_special_tokens=False).ids) for t in HARD]
    path = str(tmp_path / "files")
    docs = documents(spark, HARD).coalesce(1)
    tokenfiles.write_token_files(tokenfiles.encoded(docs), path)
    rows = sorted(tokenfiles.scan(spark, path, block_tokens=block).collect(), key=lambda r: r.ordinal)
    assert [r.n_tokens for r in rows] == want and all(r.ended for r in rows)
    assert [r.start for r in rows] == np.cumsum([0, *[n + 1 for n in want[:-1]]]).tolist()


def test_token_file_without_a_last_end(spark, tmp_path):
    end = tokenfiles.END_OF_DOCUMENT
    (tmp_path / "a.bin").write_bytes(np.array([1, 2, end, end, 7, 8, 9], dtype="<u2").tobytes())
    (tmp_path / "b.bin").write_bytes(np.array([5] * 9, dtype="<u2").tobytes() + b"x")
    (tmp_path / "c.bin").write_bytes(b"")
    rows = tokenfiles.scan(spark, str(tmp_path), block_tokens=2).collect()
    found = sorted((r.file[-5:], r.ordinal, r.start, r.n_tokens, r.ended) for r in rows)
    assert found == [("a.bin", 0, 0, 2, True), ("a.bin", 1, 3, 0, True), ("a.bin", 2, 4, 3, False), ("b.bin", 0, 0, 9, False)]
    assert tokenfiles.end_id(tokenizer_file("byte_bpe_50k.json")) == end


def all_paths(lattice, text):
    text = pieces.SPACE + text.replace(" ", pieces.SPACE)
    ends, _ = lattice.forward(text)
    best = [[] for _ in ends]
    best[0] = [0]
    for place in range(1, len(ends)):
        best[place] = sorted((b + score for start, score, _ in ends[place] for b in best[start]), reverse=True)[:4]
    return best[-1]


def test_n_best_against_dynamic_programming(spark):
    lattice = pieces.Lattice(tokenizer_file(pieces.VOCABULARY), 4)
    for text in ["hello", "a b", "the cat, the", "x\ny ☃", "  ab  cd", "no. One", " ", "internationalisation!", "ééé 😀", "aaaaaa"]:
        found = lattice.encode(text)
        assert [f[0] for f in found] == all_paths(lattice, text)
        assert len({f[2] for f in found}) == len(found) and all(lattice.decode(f[2]) == text for f in found)


def test_piece_frames_round_trip(spark):
    docs = documents(spark, HARD)
    rows = pieces.encode(docs, 3).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.id, []).append(r)
    assert set(by_id) == set(range(len(HARD)))
    for i, found in by_id.items():
        found.sort(key=lambda r: r["rank"])
        assert all(r.round_trip for r in found) and [r["rank"] for r in found] == list(range(1, len(found) + 1))
        assert sorted((r.score for r in found), reverse=True) == [r.score for r in found]
        assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in found)
    back = pieces.decode(pieces.encode(docs, 1)).select("id", "decoded").collect()
    assert {r.id: r.decoded for r in back} == {i: t or "" for i, t in enumerate(HARD)}
    assert pieces.encode(documents(spark, []), 3).count() == 0


def test_many_segmentations_of_one_line():
    few, many = (pieces.Lattice(tokenizer_file(pieces.VOCABULARY), n) for n in (6, 40))
    line = "The unbelievable international misunderstandings of yesterday, notwithstanding the weather"
    found = many.encode(line)
    assert len(found) == 40 == len({p[2] for p in found}) and [p[0] for p in found] == sorted((p[0] for p in found), reverse=True)
    assert [p[0] for p in found[:6]] == [p[0] for p in few.encode(line)]
    losses = [[0, 1, 5], [0, 0, 3], [0, 2], [0]]
    every = sorted((sum(x[k] for x, k in zip(losses, pick, strict=True)), pick) for pick in itertools.product(range(3), range(3), range(2), range(1)))
    assert list(many.picks(losses)) == every


def test_word_coder_equals_the_tokenizer():
    path = tokenizer_file("word_bpe_49k.json")
    plain, code = Tokenizer.from_file(path), packing.WordCoder(path)
    texts = [*HARD, "A.b, C.,! d.-", "<|ENDOFTEXT|> <|endoftext|>", "ª º", "Straße. CAFÉ,", "tab\there\r\nx"]
    texts += ["İstanbul ſ ŉ ΣΑΣ don't it's a$$$ b's. 'tis x<|startoftext|>y ’s’ \xa0z k\x0bm ﬁ Ⅷ a--b {x}~ (x) e\u0301", "$$$ x $$$", "x$$$ ...x"]
    want = [np.array(plain.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert code([t or "" for t in texts]) == want
    assert [code([t or ""])[0] for t in reversed(texts)] == want[::-1]
    code.forget()
    assert code([t or "" for t in reversed(texts)]) == want[::-1] and code([]) == []


@pytest.mark.parametrize("histogram", [{}, {4096: 5}, {1: 3}, {4095: 4, 1: 3}, {2000: 100, 97: 1000, 5: 7, 4096: 2}, {4090: 3, 7: 50}])
def test_plan_places_everything_once(histogram):
    plan = packing.plan_packing(histogram)
    room = np.zeros(plan.sequences, dtype=int)
    for length, n in histogram.items():
        mine = plan.length == length
        ranks, firsts = plan.rank[mine], plan.first[mine]
        assert ranks[0] == 0
        for a, b, first in zip(ranks, [*ranks[1:], n], firsts, strict=True):
            room[first : first + b - a] += length
    assert (room > 0).all() and (room <= 4096).all()
    assert room.sum() == sum(k * n for k, n in histogram.items())


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(0)
    lengths = np.clip(rng.lognormal(6.3, 1, 50_000).astype(int), 1, 4096)
    values, counts = np.unique(lengths, return_counts=True)
    plan = packing.plan_packing(dict(zip(values.tolist(), counts.tolist(), strict=True)))
    assert plan.sequences <= 1.01 * lengths.sum() / 4096 + 1


def test_packed_documents(spark):
    rng = np.random.default_rng(2)
    texts = [*HARD, *[words(rng, int(n)) for n in rng.integers(1, 3000, 40)]]
    ids = [None, *range(len(texts) - 2), 3]
    docs = documents(spark, texts, ids)
    rows = packing.pack_documents(docs).collect()
    plain = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = []
    for i, t in zip(ids, texts, strict=True):
        coded = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(coded), 4096):
            part = np.array(coded[k : k + 4096], dtype="<u4")
            want.append((str(i), k // 4096, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted(want) == sorted((str(r.id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack_documents(documents(spark, [])).count() == 0
