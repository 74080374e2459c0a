import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from driftwell.llm import periodic, queries


def brute(w):
    """All runs, period by period."""
    n, out = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                out.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, length, q) for (s, length), q in out.items())


def collapsed(w, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_doc(rng):
    kinds, n = rng.choice([1, 2, 3, 8, 200]), rng.choice([0, 1, 23, 24, 25, 60, 150, 400, 900])
    doc = [rng.randrange(1, kinds + 1) for _ in range(n)]
    if n > 30 and rng.random() < 0.7:
        a, p = rng.randrange(n), rng.randrange(1, n // 3 + 1)
        doc = [doc[i] if i < a else doc[a + (i - a) % p] for i in range(n)]
    return doc


def test_difference_cover():
    residues = set(periodic.RESIDUES.tolist())
    assert len(residues) == 9
    assert all(any((a + d) % periodic.COVER in residues for a in residues) for d in range(periodic.COVER))


@pytest.mark.parametrize("kinds,n", [(1, 500), (2, 700), (2, 73), (5, 1), (400, 400)])
def test_common_extensions(kinds, n):
    rng = random.Random(n)
    docs = [[rng.randrange(1, kinds + 1) for _ in range(n)] for _ in range(3)]
    docs[1] = docs[0][: n // 3] * 3
    lengths = np.array([len(d) for d in docs])
    text, of = periodic._laid_out([np.array(d, np.int64) for d in docs], lengths)
    lce = periodic.Lce(text, of)
    pairs = [(i, j) for i in range(len(text)) for j in rng.sample(range(len(text)), min(9, len(text))) if i != j and of[i] == of[j]]
    for (i, j), got in zip(pairs, lce.query(*np.array(pairs).reshape(-1, 2).T), strict=True):
        k = 0
        while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
            k += 1
        assert got == k


@pytest.mark.parametrize("places", [periodic.PLACES, 50])
def test_runs(monkeypatch, places):
    monkeypatch.setattr(periodic, "PLACES", places)
    rng = random.Random(places)
    for _ in range(60):
        docs = [random_doc(rng) for _ in range(rng.choice([1, 2, 10]))]
        found = [[] for _ in docs]
        for d, *run in zip(*periodic.find_runs([np.array(x, np.int64) for x in docs]), strict=True):
            found[d].append(tuple(map(int, run)))
        assert found == [brute(d) for d in docs]


def test_long_text():
    words = [1, 2, 3, 2, 3, 3] * 5000 + list(range(4, 9000)) + [7] * 40
    got = periodic.find_runs([np.array(words, np.int64)])
    assert list(zip(*(x.tolist() for x in got[1:]), strict=True)) == [(0, 30_000, 6), (38_996, 40, 1)]


def text_words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def test_awkward_documents(spark, awkward, rows, nothing):
    want = Counter()
    for r in rows:
        w = text_words(r[1])
        if len(w) < 2000:  # the long one is compared by its words alone
            want[r[0], len(w), tuple(brute(w)), collapsed(w, brute(w))] += 1
    got = Counter()
    for r in periodic.repeated_runs(awkward).collect():
        if r["n_words"] < 2000:
            got[r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]] += 1
    assert got == want and any(k[2] for k in want)
    assert periodic.repeated_runs(nothing).collect() == []


def test_planted_runs(spark, awkward, rows):
    got = Counter((r["doc_id"], r["text"]) for r in queries.with_planted_runs(awkward).collect())
    want = Counter()
    for r in rows:
        w, text = text_words(r[1]), r[1] or ""
        h = zlib.crc32(str(r[0]).encode()) if r[0] is not None else 1
        if h % 10 == 0:
            n, g = len(w), h // 10
            if n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            text = " ".join(w)
        want[r[0], text] += 1
    assert got == want
