from collections import Counter, defaultdict

from pyspark.sql import functions as F

from driftwell.llm import mixing, text


def brute_targets(sizes, cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        shares = sum(weight[s] for s in free)
        target = {s: fixed[s] if s in fixed else rest * weight[s] / shares for s in order}
        over = [s for s in free if target[s] > cap * sizes[s]]
        if not over:
            return target
        fixed |= {s: cap * sizes[s] for s in over}


def sized(df):
    return df.select("doc_id", "source", text.count_words(F.col("text")).alias("size"))


def test_counts_words(awkward, rows):
    import re

    got = Counter(r["size"] for r in sized(awkward).collect())
    assert got == Counter(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows)


def test_targets_and_takings(spark):
    docs = sized(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    mixed = mixing.mix_sources(docs).cache()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in mixed.collect():
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = brute_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * want[s]
        assert abs(taken[s] - want[s]) <= 0.03 * want[s] + 64
    again = mixing.mix_sources(docs.repartition(5))
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, again.collect()))


def test_small_sources_stop_at_three_times(spark):
    rows = [(1, "a", 1000), (2, "b", 10), (3, None, 5), (4, "c", 0), (5, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = {r["doc_id"]: r for r in mixing.mix_sources(docs, block=4).collect()}
    want = brute_targets({"a": 1000, "b": 10, "c": 0, None: 5})
    assert got[2]["target"] == want["b"] == 30 and got[3]["target"] == want[None] == 15
    assert got[2]["taken"] == 30 and got[3]["taken"] == 15 and got[4]["taken"] == got[5]["taken"] == 0
    assert abs(got[1]["target"] - want["a"]) < 1e-9 and abs(got[1]["taken"] - want["a"]) < 20


def test_awkward_rows(awkward, rows, nothing):
    got = mixing.mix_sources(sized(awkward)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix_sources(sized(nothing)).collect() == []


def test_documents_come_as_often_as_taken(awkward, rows, nothing):
    out = mixing.mixed_documents(awkward)
    assert out.columns == awkward.columns
    got, had = Counter(map(tuple, out.collect())), Counter(rows)
    assert got and all(r in had and n <= 3 * had[r] for r, n in got.items())
    assert mixing.mixed_documents(nothing).collect() == []


def test_sources_of_whole_documents_are_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = {r["source"]: r["n"] for r in sized(docs).groupBy("source").agg(F.sum("size").alias("n")).collect()}
    got = sized(mixing.mixed_documents(docs)).groupBy("source").agg(F.sum("size").alias("n")).collect()
    want = brute_targets(sizes)
    assert {r["source"] for r in got} == set(want)
    assert all(abs(r["n"] - want[r["source"]]) <= 0.05 * want[r["source"]] for r in got)


def test_takings_rebuilt_by_hand(spark, monkeypatch):
    """Every slot again in plain Python, from the same hashes."""
    shard, block, seed, cap = 64, 16, 17, 3
    monkeypatch.setattr(mixing, "SHARD", shard)
    monkeypatch.setattr(mixing.draws, "__defaults__", (shard,))
    docs = spark.createDataFrame(
        [(i, None if i % 11 == 0 else f"s{i % 5}", (i * 37) % 90) for i in range(300)] + [(7, "s1", 4)], "doc_id long, source string, size long"
    )
    hashed = docs.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "source")).collect()
    sizes = Counter()
    for r in hashed:
        sizes[r["source"]] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    number, target = {s: i + 1 for i, s in enumerate(order)}, brute_targets(sizes)
    blocks = {s: -(-sizes[s] // block) for s in order}
    weight = [target[s] * blocks[s] / sizes[s] for s in order]
    total, ends = sum(weight), [sum(weight[: k + 1]) for k in range(len(order))]
    hi = [e / total for e in ends[:-1]] + [2.0]
    lo = [0.0, *(e / total for e in ends[:-1])]
    slots = round(total)
    settled = mixing.settled_slots(slots, min(weight) / total, shard)
    assert 0 < settled < slots
    ask = lambda columns, n: spark.range(n).select(*columns).collect()
    at, place = F.floor(F.col("id") / shard), F.pmod("id", F.lit(shard))
    u = [r[0] for r in ask([mixing._uniform(F.lit(seed), at, place)], slots - settled)]
    counts = Counter()
    for k, x in enumerate(u):
        counts[k // shard, next(i for i in range(len(order)) if lo[i] <= x < hi[i])] += 1
    short = []
    for i in range(len(order)):
        quota = int(min(hi[i], 1.0) * slots) - int(lo[i] * slots)
        short.append(max(0, quota - sum(n for (_, s), n in counts.items() if s == i)))
    owners = [i for i, n in enumerate(short) for _ in range(n)]
    spots = [r[0] for r in ask([mixing.permuted(F.lit(-1), F.lit(0), F.col("id"), F.lit(len(owners)).cast("long"), seed)], len(owners))]
    assert sorted(spots) == list(range(len(owners)))
    for k, spot in enumerate(spots):
        counts[k // shard + (slots - settled) // shard, owners[spot]] += 1
    uses = Counter()
    for i, s in enumerate(order):
        n = sum(v for (_, o), v in counts.items() if o == i)
        turn = F.floor(F.col("id") / blocks[s])
        got = ask([mixing.permuted(F.lit(number[s]), turn, F.pmod("id", F.lit(blocks[s])), F.lit(blocks[s]).cast("long"), seed)], min(n, cap * blocks[s]))
        uses.update((s, r[0]) for r in got)
    want = Counter()
    for s in order:
        start = 0
        buckets = int(len(hashed) ** 0.5)
        mine = [r for r in hashed if r["source"] == s and r["size"]]
        for r in sorted(mine, key=lambda r: (r["order"] % buckets, r["order"], r["doc_id"], r["size"])):
            words = range(start, start + r["size"])
            want[r["doc_id"], r["size"], sum(uses[s, w // block] for w in words)] += 1
            start += r["size"]
    for r in hashed:
        if not r["size"]:
            want[r["doc_id"], 0, 0] += 1
    got = mixing.mix_sources(docs, block=block, cap=cap, seed=seed).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == want


def test_permutation_covers_every_block(spark):
    n = 97
    df = spark.range(3 * n).select(
        F.floor(F.col("id") / n).alias("turn"),
        mixing.permuted(F.lit(4), F.floor(F.col("id") / n), F.pmod("id", F.lit(n)), F.lit(n).cast("long"), 1).alias("b"),
    )
    by = defaultdict(set)
    for r in df.collect():
        by[r["turn"]].add(r["b"])
    assert all(len(b) == n for b in by.values()) and len(by) == 3
    big = 10**12
    row = spark.range(1).select(
        mixing.permuted(F.lit(1), F.lit(0), F.lit(big - 1), F.lit(big), 1).alias("b")
    ).first()
    assert 0 <= row["b"] < big


def test_running_total_over_buckets(spark):
    rows = [("k", i % 7, i, i + 1) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, bucket int, at int, n long")
    got = {r["at"]: r["before"] for r in text.running_total(df, ["k"], "bucket", ["at"], "n", "before").collect()}
    total = 0
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        assert got[r[2]] == total
        total += r[3]


def test_blocks_hold_the_words_that_are_counted(awkward, rows):
    got = mixing.mixed_blocks(awkward).collect()
    places = [(r["shard"], r["slot"]) for r in got]
    assert got and len(set(places)) == len(places)
    assert all(0 <= s < mixing.SHARD and 0 < len(r["words"]) <= mixing.BLOCK for (_, s), r in zip(places, got, strict=True))
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    keyed = awkward.select(key.alias("doc_id"), "source", text.count_words(F.col("text")).alias("size"))
    taken = mixing.mix_sources(keyed).agg(F.sum("taken")).first()[0]
    assert sum(len(r["words"]) for r in got) == taken
    had = {w for r in rows for w in (r[1] or "").split()}
    assert all(w in had for r in got for w in r["words"])
