import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from driftwell.llm import packing, queries
from driftwell.llm.tokens import Encoder

WORD_BPE, BYTE_BPE = (queries.tokenizer_path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))

ODD = [
    "", "  a b", "a  b", "a \nb", "a\n b\n\n c  ", "x<|endoftext|>y it's don't 12,3 é'l", "a\n", " \n x",
    "Ünï — “q” İstanbul ΣΑΣ 日本  x\ty", "hello...  world", "one.\nTwo,\nthree", "fín é́", "!!! ?? a!!\nb",
]


@pytest.mark.parametrize(("path", "joins", "lower"), [(WORD_BPE, False, True), (BYTE_BPE, True, False)])
def test_pieces_give_the_librarys_ids(path, joins, lower, rows):
    texts = ODD + [r[1] or "" for r in rows]
    lib = Tokenizer.from_file(path)
    want = [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encode = Encoder(path, joins, lower)
    assert encode(texts) == want
    assert encode(texts[::-1]) == want[::-1]  # from memory


def check_places(packed, capacity):
    held = {}
    for r in packed:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        places.sort()
        at = 0
        for offset, length in places:
            assert offset == at
            at += length
        assert at <= capacity
    return held


def test_packs_every_document(spark, awkward, rows, nothing):
    pieces = packing.tokenized_pieces(awkward, WORD_BPE, False, True, 1)
    packed = packing.pack(pieces).collect()
    lib = Tokenizer.from_file(WORD_BPE)
    want = []
    for r in rows:
        ids = np.array([*lib.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        for p, s in enumerate(range(0, len(ids), 4096)):
            cut = ids[s : s + 4096]
            want.append((r[0], p, s, len(cut), zlib.crc32(cut.tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed]
    assert Counter(got) == Counter(want)
    held = check_places(packed, 4096)
    assert len(held) <= -(-sum(w[3] for w in want) // 4096) + 1
    assert packing.pack(packing.tokenized_pieces(nothing, WORD_BPE, False, True, 1)).collect() == []


def test_ids_on_request(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    (r,) = packing.tokenized_pieces(docs, WORD_BPE, False, True, 1, with_ids=True).collect()
    assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and r["ids"][-1] == 1


@pytest.mark.parametrize("kind", ["mixed", "halves", "thirds", "one", "large", "none"])
def test_plan_covers_the_histogram_with_few_sequences(kind):
    rng = np.random.default_rng(3)
    lengths = {
        "mixed": np.minimum(256, rng.lognormal(3.5, 1.2, 5000).astype(int) + 1),
        "halves": np.array([128] * 501 + [129] * 100 + [127] * 100),
        "thirds": np.array([86] * 300 + [85] * 301),
        "one": np.array([1] * 1000),
        "large": rng.integers(129, 257, 900),
        "none": np.array([], int),
    }[kind]
    counts = np.bincount(lengths, minlength=257)
    plan = packing.solve(counts, 256)
    used = Counter()
    for times, pattern in plan:
        assert times > 0 and sum(n * k for n, k in pattern.items()) <= 256
        for n, k in pattern.items():
            used[n] += times * k
    assert used == Counter({n: int(c) for n, c in enumerate(counts) if c})
    # Best-fit decreasing, piece by piece.
    bins: list[int] = []
    for n in sorted(lengths, reverse=True):
        room = min((b for b in bins if b >= n), default=None)
        if room is None:
            bins.append(256 - n)
        else:
            bins[bins.index(room)] -= n
    sequences = sum(times for times, _ in plan)
    assert sequences <= len(bins) * 1.005 + 1
    assert sequences >= -(-lengths.sum() // 256)
