import itertools
import random
import re
import tempfile
from collections import Counter

import numpy as np
import pytest

from driftwell.llm import near_dups as N


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent):
    sets, up = [shingle_set(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sets, [least.get(root(i)) if s else rows[i][0] for i, s in enumerate(sets)]


def near_group(n, seed):
    """Copies of one text, each with a few words changed, and strangers."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(n + i, " ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 80)))) for i in range(n)]
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_awkward_rows(awkward, rows, nothing, percent):
    sets, least = brute(rows, percent)
    got = N.near_duplicates(awkward, percent / 100).collect()
    want = Counter((r[0], len(s), c, r[0] == c) for r, s, c in zip(rows, sets, least, strict=True))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want
    if percent == 80:
        assert N.near_duplicates(nothing).collect() == []


def test_large_groups_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    rows = near_group(120, 2)
    _, least = brute(rows, 85)
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 0.85).collect()}
    assert got == {r[0]: c for r, c in zip(rows, least, strict=True)}
    assert len(set(least[:120])) > 1


def test_links_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = np.random.default_rng(6)
    limit, made = N.distance_limit(0.85), []
    base = rng.integers(0, 256, N.POSITIONS)
    for n in (64, 512):  # each differs from the base in two positions
        sigs = np.repeat(base[None, :], n, 0).astype(np.uint8)
        for row in sigs:
            row[rng.choice(N.POSITIONS, 2, replace=False)] ^= 1
        path = f"{tempfile.mkdtemp()}/classes"
        spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sigs)], "node long, sig binary").write.parquet(path)
        links = [tuple(r) for r in N.candidate_links(spark.read.parquet(path), limit).collect()]
        forest = N.Forest(n)
        assert sum(forest.join(a, b) for a, b in links) == n - 1
        made.append(len(links))
    assert made[1] <= 12 * made[0]


def test_a_chain_through_blocks_is_one_component(spark, monkeypatch):
    """Each text is near the next one only, so most links are across blocks."""
    monkeypatch.setattr(N, "BLOCK", 8)
    rng = random.Random(8)
    words, rows = [f"w{rng.randrange(10**6)}" for _ in range(200)], []
    for i in range(60):
        rows.append((i, " ".join(words)))
        for k in range(3):
            words[(37 * i + 61 * k) % 200] = f"x{rng.randrange(10**6)}"
    _, least = brute(rows, 80)
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 0.8).collect()}
    assert got == {r[0]: c for r, c in zip(rows, least, strict=True)}


def test_texts_are_read_twice_however_groups_meet(spark, monkeypatch):
    """Once for signatures and once for links, also where members meet across blocks."""
    monkeypatch.setattr(N, "BLOCK", 4)
    rng = random.Random(8)
    words, rows = [f"w{rng.randrange(10**6)}" for _ in range(200)], []
    for i in range(40):
        rows.append((i, " ".join(words)))
        for k in range(3):
            words[(37 * i + 61 * k) % 200] = f"x{rng.randrange(10**6)}"
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    stored, across = N.stored, []

    def noted(df, label):
        out = stored(df, label)
        if label == "near-apart":
            across.append(out.count())
        return out

    monkeypatch.setattr(N, "stored", noted)
    schema = "doc_id long, text string"
    got = N.near_duplicates(spark.createDataFrame(rows, schema).mapInArrow(counted, schema), 0.8).collect()
    assert len(across) == 2 and across[1] > 0
    assert len({r["component_id"] for r in got}) == len(set(brute(rows, 80)[1]))
    assert read.value == 2 * len(rows)


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_kept_rows_are_dealt_once(spark, capsys, broadcast):
    text = "one two three four five six seven"
    rows = [(None, text)] * 2 + [(2, text), (2, text), (4, text)] + [(None, None)] * 2 + [(1, None), (1, None), (1, "")]
    rows += [(None, "some other words without an id")] * 3
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        kept = N.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        got = Counter(map(tuple, kept.collect()))
        capsys.readouterr()
        kept.explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == Counter([(2, text), (None, None), (1, None), (1, ""), (None, "some other words without an id")])
    above = capsys.readouterr().out.split("== Initial Plan ==")[0].split("Join")[0]
    assert "Window" in above
    if broadcast == "-1":
        assert "Exchange" not in above


def test_one_row_of_each_group_stays(spark, awkward, rows, nothing):
    kept = N.drop_near_duplicates(awkward, 0.8)
    assert kept.columns == awkward.columns
    got = list(map(tuple, kept.collect()))
    assert set(got) <= set(rows)
    sets = [shingle_set(r[1]) for r in got]
    for a, b in itertools.combinations(range(len(got)), 2):
        both = len(sets[a] & sets[b])
        assert not both or 100 * both < 80 * len(sets[a] | sets[b])
    for r in rows:  # every text is there or has a near one
        s = shingle_set(r[1])
        assert not s or any(5 * len(s & t) >= 3 * len(s | t) for t in sets), r
    assert N.drop_near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_every_pair_within_the_distance_shares_a_bucket(threshold):
    limit = N.distance_limit(threshold)
    plan = N.chunk_plan(limit)
    assert sum(err + 1 for *_, err in plan) == limit + 1
    assert [p[0] for p in plan][1:] == [p[1] for p in plan][:-1] and plan[-1][1] == N.POSITIONS
    rng = np.random.default_rng(4)
    a = rng.integers(0, 256, (3000, N.POSITIONS)).astype(np.uint8)
    b = a.copy()
    for row in b:
        spots = rng.choice(N.POSITIONS, limit, replace=False)
        row[spots] ^= rng.integers(1, 256, limit).astype(np.uint8)
    x, y = N.bucket_keys(a, limit), N.bucket_keys(b, limit)
    assert (x == y).any(1).all()
    p = (1 - threshold) * 255 / 256
    far = rng.binomial(N.POSITIONS, p, 200_000) > limit
    assert far.mean() < 5e-4


@pytest.mark.parametrize("local", [N.LOCAL_LINKS, 7])
def test_components_of_chains_and_stars(spark, monkeypatch, local):
    monkeypatch.setattr(N, "LOCAL_LINKS", local)
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges]
    rng.shuffle(edges)
    got = {r["node"]: r["comp"] for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert N.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_links_of_a_task_become_stars():
    import pyarrow as pa

    rng = random.Random(5)
    links = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part)], ["u", "v"]) for part in (links[:100], links[100:])]
    stars = [(r["u"], r["v"]) for b in N._stars(iter(batches)) for r in b.to_pylist()]
    near = {x: {x} for pair in links for x in pair}
    for a, b in links:
        both = near[a] | near[b]
        for x in both:
            near[x] = both
    assert dict(stars) == {x: min(group) for x, group in near.items() if x != min(group)} and len(dict(stars)) == len(stars)
    assert [b.num_rows for b in N._stars(iter([]))] == [0]
