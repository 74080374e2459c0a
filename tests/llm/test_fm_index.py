import random
import re
from collections import Counter

import numpy as np
import pytest

from driftwell.llm import fm_index as fm


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(text, items, size=10):
    """Words hit and items found, window by window."""
    ws, hit, found = words(text), set(), set()
    for owner, item in items:
        own = words(item)
        n = min(size, len(own))
        cuts = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1):
            if tuple(ws[i : i + n]) in cuts:
                hit.update(range(i, i + n))
                found.add("" if owner is None else str(owner))
    return len(ws), tuple(sorted(hit)), tuple(sorted(found))


def test_suffixes_ranges_and_places():
    rng = random.Random(1)
    for _ in range(40):
        docs = [
            [rng.randrange(1, rng.choice([3, 6, 50])) for _ in range(rng.choice([0, 1, 5, 40, 200]))]
            for _ in range(rng.choice([1, 3, 12]))
        ]
        docs += [docs[0]] * rng.choice([0, 3])
        flat = [x for k, d in enumerate(docs) for x in [*(w + len(docs) for w in d), k]]
        assert fm.suffix_order(np.array(flat)).tolist() == sorted(range(len(flat)), key=lambda i: flat[i:])
        text = [x for d in docs for x in [*d, 0]]
        index = fm.Index([np.array(d, np.int64) for d in docs], 51)
        phrases = [[rng.randrange(1, 4) for _ in range(rng.choice([1, 2, 3]))] for _ in range(20)]
        rows = np.array([p + [-1] * (3 - len(p)) for p in phrases])
        low, high = index.search(rows, np.array([len(p) for p in phrases]))
        for p, lo, hi in zip(phrases, low, high, strict=True):
            got = sorted(index.locate(np.arange(lo, hi)).tolist())
            assert got == [i for i in range(len(text)) if text[i : i + len(p)] == p]


def test_long_repeats():
    keys = np.array([1] * 5000 + [2, 3] * 3000 + [0])
    got = fm.suffix_order(keys)
    flat = keys.tolist()
    assert got.tolist() == sorted(range(len(flat)), key=lambda i: flat[i:])


ITEMS = "item_id long, text string, owner string, phrase string, words string"


def as_items(spark, items):
    return spark.createDataFrame([(i, t, "o", "p", "w") for i, t in items], ITEMS)


def found(df):
    out = Counter()
    for r in df.collect():
        hit = [i for s in r["spans"] for i in range(s["first"], s["first"] + s["n"])]
        edges = [(s["first"], s["first"] + s["n"]) for s in r["spans"]]
        assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))  # merged
        out[r["doc_id"], r["n_words"], tuple(hit), tuple(r["items"])] += 1
    return out


@pytest.fixture(scope="module")
def cases(rows):
    long = words(rows[15][1])
    passages = [
        (1, " ".join(long[50:90])),
        (2, " ".join(long[70:82]).upper() + "!"),
        (3, "one"),
        (4, "two, WORDS"),
        (5, None),
        (6, "..."),
        (7, "a b c d"),
        (None, " ".join(words(rows[8][1])[3:14])),
        (10, "nowhere to be found in any of these texts at all"),
        (11, " ".join(["same"] * 13)),
        (1, " ".join(long[200:211])),  # a repeated id
        (12, " ".join(long[50:90])),  # a repeated text
    ]
    return passages


@pytest.mark.parametrize("shard_words,block_bytes", [(fm.SHARD_WORDS, fm.BLOCK_BYTES), (50, 1500)])
def test_awkward_documents(spark, awkward, rows, cases, monkeypatch, shard_words, block_bytes):
    monkeypatch.setattr(fm, "BLOCK_BYTES", block_bytes)  # several passes over the documents
    want = Counter()
    for r in rows:
        want[r[0], *brute(r[1], cases)] += 1
    assert found(fm.find_overlaps(awkward, as_items(spark, cases))) == want
    assert sum(bool(k[2]) for k in want) > 5


def test_shards_of_any_size(rows, cases, monkeypatch):
    pairs = sorted({(" ".join(w[k : k + 10]), str(i)) for i, t in cases if (w := words(t)) for k in range(max(1, len(w) - 9))})
    phrases = fm.pack_phrases(pairs)
    monkeypatch.setattr(fm, "LOCATED", 7)
    for step in (1, 4, len(rows)):
        for at in range(0, len(rows), step):
            texts = [r[1] for r in rows[at : at + step]]
            numbers = {}
            docs = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in fm.words_of((t or "").encode())], np.int64) for t in texts]
            cover, starts, owned = fm.hits(docs, numbers, phrases)
            for k, t in enumerate(texts):
                n, hit, _ = brute(t, cases)
                assert np.nonzero(cover[starts[k] : starts[k] + n])[0].tolist() == list(hit)


def test_empty_tables(spark, awkward, nothing, cases):
    none = spark.createDataFrame([], ITEMS)
    assert fm.find_overlaps(nothing, as_items(spark, cases)).collect() == []
    assert all(not r["spans"] and not r["items"] for r in fm.find_overlaps(awkward, none).collect())


def test_cut_overlaps(spark):
    docs = spark.createDataFrame(
        [(1, "Keep é this. One two THREE; four, and this"), (2, None), (3, "nothing"), (4, "one two three four")], "doc_id long, text string"
    )
    items = as_items(spark, [(1, "one two three four")])
    got = {r["doc_id"]: r["text"] for r in fm.cut_overlaps(fm.find_overlaps(docs, items, with_text=True)).collect()}
    assert got == {1: "Keep é this. , and this", 2: None, 3: "nothing", 4: ""}
