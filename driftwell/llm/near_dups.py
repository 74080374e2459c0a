"""Near duplicates: MinHash signatures, joined by Hamming distance through several indexes.

A document's set is its distinct five-word shingles. Documents with equal sets are one
class from the start. A class has a signature of POSITIONS MinHash values of eight bits.
Classes whose sets are as alike as the threshold differ in at most ``limit`` positions
(but for a chance of MISS); the join finds every pair within that distance: cut into
chunks, such a pair has, by the pigeonhole principle, a chunk with no more errors than the
chunk is allowed (0 or 1), and leaving each position of a chunk out in turn enumerates
its errors. Pairs within the distance connect candidate groups; inside these, links are
confirmed on the full sets, and connected components follow the confirmed links.

Groups are never gathered whole. Buckets and candidate groups of more than BLOCK members
are dealt into blocks, twice, and a block's members meet. Where that leaves a group in
several parts, members outside the largest meet all of other parts, two blocks in a task.
A task keeps the links that connect something new: at most one fewer than the members, or
the parts, that it sees, not all pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.text import stored

WIDTH = 5
POSITIONS, CHUNKS = 64, 14
MISS = 1e-4
#: Members of a group that meet in one task, per side.
BLOCK = 256
#: Links that a task connects by itself before tasks agree on components.
LOCAL_LINKS = 1 << 17
MASK = (1 << 64) - 1

_rng = np.random.default_rng(20)
_MULTIPLY = _rng.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)


# --- sets and signatures ----------------------------------------------------


class Shingles:
    """Sorted distinct 64-bit shingle hashes of a text; remembers hashes of words."""

    REMEMBERED = 1_000_000

    def __init__(self, width: int = WIDTH):
        self.width = width
        self._seen: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        words = (text or "").encode("utf-8", "replace").lower().split()
        seen = self._seen
        if len(seen) > self.REMEMBERED:
            seen.clear()
        try:
            ids = list(map(seen.__getitem__, words))
        except KeyError:
            for w in words:
                if w not in seen:
                    seen[w] = xxhash.xxh3_64_intdigest(w)
            ids = list(map(seen.__getitem__, words))
        h = np.array(ids, np.uint64)
        if not len(h):
            return h
        n = min(self.width, len(h))
        mixed = np.full(len(h) - n + 1, n, np.uint64)  # sequences of other lengths differ
        for k in range(n):
            mixed = (mixed ^ h[k : len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The last eight bits of the least hash under each of POSITIONS functions."""
    out = np.empty(POSITIONS, np.uint8)
    for lo in range(0, POSITIONS, 16):
        h = shingles[None, :] * _MULTIPLY[lo : lo + 16, None] + _ADD[lo : lo + 16, None]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out[lo : lo + 16] = (h.min(1) >> np.uint64(32)) & np.uint64(255)
    return out


def distance_limit(threshold: float, miss: float = MISS) -> int:
    """Least number of differing positions that a pair at the threshold exceeds with a
    probability of at most ``miss``."""
    p = (1 - threshold) * (1 - 1 / 256)
    tail, d = 1.0, -1
    while tail > miss and d < POSITIONS - 1:
        d += 1
        tail -= math.comb(POSITIONS, d) * p**d * (1 - p) ** (POSITIONS - d)
    return d


def chunk_plan(limit: int) -> list[tuple[int, int, int]]:
    """(first, past last, allowed errors) of each chunk: the allowances, each plus one,
    sum to limit + 1, so that a pair within the limit keeps to one of them."""
    chunks = max(CHUNKS, -(-(limit + 1) // 2))
    errors = [1 if i < limit + 1 - chunks else 0 for i in range(chunks)]
    # A chunk that may err is longer by one, so that its keys are as selective.
    base = (POSITIONS - sum(errors)) // chunks
    sizes = [base + e for e in errors]
    for i in range(POSITIONS - sum(sizes)):
        sizes[-1 - i % chunks] += 1
    ends = np.cumsum(sizes)
    return [(int(e - s), int(e), err) for s, e, err in zip(sizes, ends, errors, strict=True)]


def bucket_keys(signatures: np.ndarray, limit: int) -> np.ndarray:
    """rows x keys: for each chunk its positions, or its positions without each one."""
    keys, wide = [], signatures.astype(np.uint64)
    for c, (a, b, err) in enumerate(chunk_plan(limit)):
        for gone in range(a, b) if err else [None]:
            code = np.full(len(wide), 1 + c * 64 + (0 if gone is None else gone - a + 1), np.uint64)
            for k in range(a, b):
                if k != gone:
                    code = (code ^ wide[:, k]) * np.uint64(0x9E3779B97F4A7C15)
                    code ^= code >> np.uint64(31)
            keys.append(code)
    return np.stack(keys, 1).view(np.int64)


def _described(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (null without words), sig; one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for b in batches:
            n, node, sig = [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t)
                n.append(len(s))
                node.append(_node(s))
                sig.append(signature(s).tobytes() if len(s) else None)
            columns = [b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "node", "sig"])

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, node long, sig binary")


def _node(shingles: np.ndarray) -> int | None:
    """Number of a set: 64 bits of its digest."""
    if not len(shingles):
        return None
    raw = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


# --- groups in blocks -------------------------------------------------------


class Forest:
    """Union-find over row numbers; ``join`` says whether the pair connected something."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _own_blocks(members: DataFrame, sizes: DataFrame, group: str) -> DataFrame:
    """Meetings inside blocks: members (columns group, node and others) of the groups in
    ``sizes`` (group, _n) with columns first, second and block, side by side in one task
    where they agree in the first two. Groups of several blocks are dealt once more by
    another hash, which brings members of different blocks together."""
    blocks = F.ceil(F.col("_n") / F.lit(BLOCK)).cast("int")
    again = blocks + F.pmod(F.xxhash64("node", F.lit(1)), blocks).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    deals = F.when(blocks > 1, F.array(block, again)).otherwise(F.array(block))
    return members.join(sizes, group).select(*members.columns, F.explode(deals).alias("first")).withColumns(
        {"second": F.col("first"), "block": F.col("first")}
    )


def _across_blocks(members: DataFrame, group: str) -> DataFrame:
    """Meetings of members of different parts: those of a group's main part have blocks of
    their own, which don't meet each other; any two other blocks do, and the members of any
    other one. ``members`` have their group's _main (its part), _in and _out (members in it
    and not) beside them."""
    columns = [c for c in members.columns if c not in ("_main", "_in", "_out")]
    inner, outer = (F.ceil(F.col(c) / F.lit(BLOCK)).cast("int") for c in ("_in", "_out"))
    own, number = F.col("part") == F.col("_main"), F.xxhash64("node")
    block = F.when(own, F.pmod(number, inner)).otherwise(inner + F.pmod(number, outer)).cast("int")
    start = F.when(own, inner).otherwise(F.lit(0))
    # A member of block b is in the meetings (least, greatest) of b and each block it meets.
    return members.select(
        *columns, block.alias("block"), F.explode(F.sequence(start, inner + outer - 1)).alias("_other")
    ).select(
        *columns, "block",
        F.least("block", "_other").alias("first"), F.greatest("block", "_other").alias("second"),
    )


def _connected(
    members: DataFrame,
    sizes: DataFrame,
    group: str,
    extra: list[str],
    scan: Callable,
    ready: Callable[[DataFrame], DataFrame] = lambda members: members,
    complete: Callable[[DataFrame], DataFrame] = lambda meetings: meetings,
) -> DataFrame:
    """Links (a, b) that connect all members of each group that pairs of ``scan`` connect.

    ``members`` and ``sizes``, which has the groups of more than one member (columns group,
    _n), have been written down, as both are read more than once. Columns of ``extra`` that
    members don't have are added by ``ready`` before they are dealt, or by ``complete`` to
    their meetings. A group that its own blocks' meetings connect costs work and links in
    proportion to its size; in others, members outside the largest part then meet all
    members of other parts, and only theirs are read once more.
    """
    links = _links(complete(_own_blocks(ready(members), sizes, group)), group, extra, scan)
    large = sizes.where(F.col("_n") > BLOCK)
    if large.isEmpty():
        return links
    parts = stored(components(links), "near-blocks").select("node", F.col("comp").alias("part"))
    known = members.select(group, "node").join(large.select(group), group).join(parts, "node", "left")
    known = known.withColumn("part", F.coalesce("part", "node"))
    main = F.max(F.struct("_c", "part"))
    apart = (
        known.groupBy(group, "part").agg(F.count("*").alias("_c"))
        .groupBy(group).agg(main.alias("_most"), F.sum("_c").alias("_n"))
        .select(group, F.col("_most.part").alias("_main"), F.col("_most._c").alias("_in"), (F.col("_n") - F.col("_most._c")).alias("_out"))
        .where(F.col("_out") > 0)
    )
    apart = stored(apart, "near-apart")
    # First by the groups, a small table, so that only their members are moved.
    meeting = members.join(apart, group).join(known.select(group, "node", "part"), [group, "node"])
    across = _links(complete(_across_blocks(ready(meeting), group)), group, extra, scan, "part")
    return parts.select(F.col("node").alias("a"), F.col("part").alias("b")).unionByName(across)


def _links(meetings: DataFrame, group: str, extra: list[str], scan: Callable, known: str = "node") -> DataFrame:
    """Rows a, b: links that connect members of meetings; ``scan`` gets the columns of some
    whole meetings, sorted, as numpy arrays, and numbers of what is ``known`` to be
    connected, and yields positions i, j."""
    keys = [group, "first", "second"]
    columns = list(dict.fromkeys([*keys, "block", "node", known, *extra]))
    dealt = meetings.select(*columns).repartition(*keys).sortWithinPartitions(*keys, "node")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Cuts the stream after whole meetings."""
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            last = np.ones(b.num_rows, bool)
            for k in keys:
                v = b.column(k).to_numpy()
                last &= v == v[-1]
            cut = int(np.argmax(last))  # the last meeting of the batch may go on
            old = held and all(held[-1].column(k)[-1] == b.column(k)[0] for k in keys)
            if cut:
                yield pa.Table.from_batches([*held, b.slice(0, cut)])
                held = [b.slice(cut)]
            elif held and not old:
                yield pa.Table.from_batches(held)
                held = [b]
            else:
                held.append(b)
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches):
            c = {n: table.column(n).to_numpy() for n in columns if n not in extra}
            c |= {n: table.column(n) for n in extra}
            group_no = np.zeros(table.num_rows, np.int64)
            group_no[1:] = np.cumsum(np.any([c[k][1:] != c[k][:-1] for k in keys], 0))
            # In a meeting of two blocks, only pairs across them are new.
            across = c["first"] != c["second"]
            part = np.unique(c[known], return_inverse=True)[1]
            pairs = list(scan(c, group_no, across, part))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(c["node"][i]) for i, _ in pairs], pa.int64()), pa.array([int(c["node"][j]) for _, j in pairs], pa.int64())],
                ["a", "b"],
            )

    return dealt.mapInArrow(run, "a long, b long")


def _near(
    c: dict, group_no: np.ndarray, across: np.ndarray, part: np.ndarray, limit: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs of a meeting, of different parts, whose signatures are within the limit."""
    sig = np.frombuffer(b"".join(c["sig"].to_pylist()), np.uint8).reshape(-1, POSITIONS)
    rows = np.arange(len(group_no))
    for s in range(1, len(group_no)):
        i = rows[: len(rows) - s]
        i = i[group_no[i + s] == group_no[i]]
        if not len(i):
            return
        i = i[(~across[i] | (c["block"][i] != c["block"][i + s])) & (part[i] != part[i + s])]
        for lo in range(0, len(i), 1 << 16):
            some = i[lo : lo + (1 << 16)]
            close = (sig[some] != sig[some + s]).sum(1) <= limit
            if close.any():
                yield some[close], some[close] + s


def candidate_links(classes: DataFrame, limit: int) -> DataFrame:
    """Links (a, b) that connect all classes within the signature distance: columns
    node, sig of ``classes``, which has been written down."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint8).reshape(-1, POSITIONS)
                keys = bucket_keys(sig, limit)
                node = np.repeat(b.column("node").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], ["key", "node"])

    buckets = classes.select("node", "sig").mapInArrow(explode, "key long, node long")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by key, those whose key another row has. The last row seen
        waits for the next; ``follows`` says that it has the key of the one before."""
        waiting, follows = None, False
        for b in batches:
            if not b.num_rows:
                continue
            table = pa.Table.from_batches([waiting, b] if waiting is not None else [b])
            key = table.column("key").to_numpy()
            same = key[1:] == key[:-1]
            hit = np.concatenate([[follows], same]) | np.concatenate([same, [False]])
            hit[-1] = False
            yield from table.filter(pa.array(hit)).combine_chunks().to_batches()
            follows = bool(same[-1]) if len(same) else follows
            waiting = table.slice(len(key) - 1).combine_chunks().to_batches()[0]
        if waiting is not None and follows:
            yield waiting

    full = buckets.repartition("key").sortWithinPartitions("key").mapInArrow(shared, "key long, node long")
    full = stored(full, "near-buckets")
    sizes = stored(full.groupBy("key").agg(F.count("*").alias("_n")), "near-sizes")
    signed = classes.select("node", "sig")

    def scan(c, group_no, across, part):
        forest = Forest(len(group_no))
        for i, j in _near(c, group_no, across, part, limit):
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                if forest.join(int(part[x]), int(part[y])):
                    yield x, y

    return _connected(full, sizes, "key", ["sig"], scan, complete=lambda meetings: meetings.join(signed, "node"))


def confirmed_links(members: DataFrame, sizes: DataFrame, limit: int, threshold: float) -> DataFrame:
    """Links (a, b) that connect all classes of a candidate group whose full sets are as
    alike as ``threshold``: columns comp, node, sig, text. ``members`` and ``sizes``
    (comp, _n) have been written down."""
    percent = round(threshold * 100)

    def shingled(rows: DataFrame) -> DataFrame:
        """Rows with the column shingles in place of the text."""
        names = [c for c in rows.columns if c != "text"]

        def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingles = Shingles()
            for b in batches:
                sets = [shingles(t).tobytes() for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*map(b.column, names), pa.array(sets, pa.binary())], [*names, "shingles"]
                )

        return rows.mapInArrow(shingle, rows.drop("text").schema.add("shingles", "binary"))

    def scan(c, group_no, across, part):
        forest = Forest(len(group_no))
        raw = c["shingles"].to_pylist()
        for i, j in _near(c, group_no, across, part, limit):
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                p, q = int(part[x]), int(part[y])
                if forest.root(p) == forest.root(q):
                    continue
                a, b = np.frombuffer(raw[x], np.uint64), np.frombuffer(raw[y], np.uint64)
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    forest.join(p, q)
                    yield x, y

    return _connected(members, sizes, "comp", ["sig", "shingles"], scan, shingled)


# --- components -------------------------------------------------------------


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) that say the same as all of a task's: each node with the least node
    that it is connected to."""
    number: dict[int, int] = {}
    up: list[int] = []
    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            ends = []
            for node in (u, v):
                if node not in number:
                    number[node] = len(up)
                    up.append(len(up))
                i = number[node]
                while up[i] != i:
                    up[i] = up[up[i]]
                    i = up[i]
                ends.append(i)
            up[max(ends)] = min(ends)
    nodes = np.array(list(number), np.int64)
    root = np.array(up, np.int64)
    while len(root) and (root[root] != root).any():
        root = root[root]
    least = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(least, root, nodes)
    mine = least[root] if len(root) else nodes
    away = nodes != mine
    yield pa.RecordBatch.from_arrays([pa.array(nodes[away]), pa.array(mine[away])], ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """Rows node, comp: the least node that links lead to, for every node with a link.

    First each task turns about LOCAL_LINKS links into stars, as many buckets connect the
    same nodes over and over. Then two steps alternate until nothing changes: every node's
    larger neighbours are linked to the least of its neighbourhood, then its smaller ones.
    A node with very many links is split between tasks as any skewed join is.
    """
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    edges = stored(edges, "components")
    tasks = max(1, -(-edges.count() // LOCAL_LINKS))
    edges = stored(edges.coalesce(tasks).mapInArrow(_stars, "u long, v long").distinct(), "components")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), "u").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = stored(small.where(F.col("u") != F.col("v")).distinct(), "components")
        now = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows doc_id, text_hash, n_shingles, component_id, kept, node, comp, one per document.

    Words are lower-cased (A to Z). A document of fewer than five words has its whole
    sequence as its one shingle; one without words or text has no set, is linked with
    nothing and is its own component. component_id is the smallest doc_id reachable by
    links of at least ``threshold`` (in hundredths), kept says that it is the document's
    own. Rows with equal ids are documents of their own; a null id is larger than any
    other, and kept where all of its component are null. ``node`` numbers the document's
    set, ``comp`` its component; both are null without a set. An empty table gives an empty table; other columns are not read.
    """
    columns = ["doc_id", "text_hash", "n_shingles", "component_id", "node", "comp"]
    limit = distance_limit(threshold)
    described = stored(_described(docs, doc_id, text), "near-signatures")
    known = described.where(F.col("node").isNotNull())
    classes = stored(
        known.groupBy("node").agg(
            F.min("doc_id").alias("first"),
            F.min("sig").alias("sig"),
            F.max(F.struct("doc_id", "text_hash")).alias("one"),
        ),
        "near-classes",
    )
    groups = stored(components(candidate_links(classes, limit)), "near-groups")
    # The text of one document of each class that has company.
    company = groups.join(classes, "node").select("node", "comp", "sig", "one.*")
    texts = docs.select(
        F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_hash"), F.col(text).alias("text")
    )
    one = (F.col("_hash") == F.col("text_hash")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    members = company.join(texts, one).select("node", "comp", "sig", "text").dropDuplicates(["node"])
    members = stored(members, "near-members")
    sizes = stored(groups.groupBy("comp").agg(F.count("*").alias("_n")), "near-sizes")
    parts = stored(components(confirmed_links(members, sizes, limit, threshold)), "near-parts")
    labels = classes.join(parts, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    ids = labels.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = labels.join(ids, "comp").select("node", "comp", "component_id")
    rows = known.join(named, "node").select(*columns)
    alone = described.where(F.col("node").isNull()).withColumns(
        {"component_id": F.col("doc_id"), "comp": F.lit(None).cast("long")}
    ).select(*columns)
    return rows.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(
    docs: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each component, with its columns as they are: the smallest doc_id's, of
    several with that id the least text hash. Rows without words stay, each by itself,
    but rows that repeat both id and text count once."""
    found = near_duplicates(docs, threshold, doc_id, text).where("kept")
    # One (id, text) of each component; its rows' own keys where there is no component.
    alone = F.when(F.col("comp").isNull(), F.struct("doc_id", "text_hash"))
    keys = (
        found.groupBy("comp", alone.alias("alone"))
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("_key"))
        .select("_key")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # A struct equals another one with the same nulls. Joined and numbered by one column
    # of the same type, nulls allowed, rows are dealt once.
    key = F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"))
    key = key.cast(keys.schema["_key"].dataType)
    again = Window.partitionBy("_key").orderBy("_key")
    return (
        docs.select(row, key.alias("_key")).join(keys, "_key").withColumn("_again", F.row_number().over(again))
        .where(F.col("_again") == 1).select("row.*")
    )
