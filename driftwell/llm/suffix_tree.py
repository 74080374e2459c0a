"""Language-model scores from a probabilistic suffix tree over bytes.

A text is its words in lower case (A to Z), joined by single blanks, and an end mark. The
next byte depends on the longest retained suffix of what came before. A context of up to
DEPTH bytes is a candidate if it occurs LEAST_COUNT times, whatever the corpus's size; it
is retained if its next-byte distribution diverges from that of its own suffix.
Distributions are smoothed towards the suffix's, the more the more kinds of bytes follow.

Retained contexts are sorted arrays of their observed next bytes, so a task holds millions
of them. A gram is DEPTH bytes and the next one, the most recent byte first, so that a
context's suffixes are prefixes of its number. A block of texts is scored by its distinct
grams, each looked up once. Contexts beyond HELD_GRAMS, the rarer ones, stay a table: they
are tested length by length, a bit table tells tasks where one may be met, and what those
places add is joined by gram. No suffix of a context is rarer than the context, so the
table only ever extends what the tasks hold.

Word counts for the base score cover every word: a bounded table of the most frequent
goes to the tasks, all others are joined by word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.text import stored

DEPTH = 5
#: Times that a context has to occur to be tested.
LEAST_COUNT = 10
#: Grams (contexts with a next byte) that go to every task, 16 bytes each; the rest are
#: joined.
HELD_GRAMS = 3_000_000
#: Scored grams that a task remembers from block to block.
REMEMBERED = 1 << 20
#: Bits of a slot of the table by which tasks know contexts that are joined.
SLOT_BITS = 26
#: Nats by which a context's data must prefer its own distribution to its suffix's.
DIVERGENCE = 10.0
#: Words whose counts go to every task; the rest are joined.
FREQUENT = 1 << 17
#: Weight of the suffix's distribution, in counts for each kind of byte that follows.
SMOOTH = 3.0
#: Bytes scored at once.
BLOCK_BYTES = 2 << 20
#: Distinct words or grams a task holds before it passes them on.
HELD = 300_000
END = 10
MET = pa.list_(pa.struct([("code", pa.int64()), ("times", pa.int64())]))


def normal(text: str | None) -> bytes:
    """ASCII white space becomes single blanks, A to Z lower case."""
    return b" ".join((text or "").encode("utf-8", "replace").lower().split())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())], ["word", "n"]
        )

    held: Counter = Counter()
    for b in batches:
        for t in b.column("text").to_pylist():
            held.update(normal(t).split(b" "))
        if len(held) >= HELD:
            held.pop(b"", None)
            yield rows(held)
            held = Counter()
    held.pop(b"", None)
    yield rows(held)


def _laid_out(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``depth`` end marks before each and after the last; places of the ends.

    The first mark after a text is its end; the marks also stand for the empty history.
    """
    gap = bytes([END]) * depth
    laid = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = depth + np.cumsum(lengths) + depth * np.arange(len(texts))
    return laid, ends


def _codes(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte and end of the texts, in their order, and where each text's
    grams start: the bytes before, the most recent one highest, and the byte itself."""
    laid, ends = _laid_out(texts, depth)
    code = np.zeros(len(laid) - depth, np.uint64)
    for k in range(depth - 1, -1, -1):
        code |= laid[k : len(laid) - depth + k].astype(np.uint64) << np.uint64(8 * (k + 1))
    code |= laid[depth:]
    real = laid[depth:] != END
    real[ends - depth] = True
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return code[real], np.cumsum(lengths) - lengths


def _part(code, length, depth: int):
    """Of a gram of ``depth`` bytes before, the one of ``length`` bytes before."""
    return (code >> (8 * (depth - length + 1)) << 8) | (code & 255)


def _grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams with counts."""
    return np.unique(_codes(texts, depth)[0], return_counts=True)


def _merge(a, b):
    code, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    n = np.zeros(len(code), np.int64)
    np.add.at(n, at, np.concatenate([a[1], b[1]]))
    return code, n


def _blocks(texts: list[bytes]) -> Iterator[list[int]]:
    """Positions of consecutive texts, BLOCK_BYTES together."""
    block, size = [], 0
    for i, t in enumerate(texts):
        block.append(i)
        size += len(t)
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = (np.empty(0, np.uint64), np.empty(0, np.int64))
    held, waiting, size = none, [], 0

    def batch(pair):
        return pa.RecordBatch.from_arrays([pa.array(pair[0].astype(np.int64)), pa.array(pair[1])], ["code", "n"])

    for b in batches:
        for t in b.column("text").to_pylist():
            waiting.append(normal(t))
            size += len(waiting[-1])
            if size >= BLOCK_BYTES:
                held, waiting, size = _merge(held, _grams(waiting, DEPTH)), [], 0
                if len(held[0]) >= HELD:
                    yield batch(held)
                    held = none
    if waiting:
        held = _merge(held, _grams(waiting, DEPTH))
    yield batch(held)


class Tree:
    """Retained contexts by length: sorted ``contexts`` with their counts and the weight of
    their suffix, sorted ``grams`` with their counts; ``root``: each byte's probability."""

    def __init__(self, depth: int, root: np.ndarray):
        self.depth, self.root = depth, root
        self.contexts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def after(self, code: np.ndarray, length: int) -> np.ndarray:
        """Probability of the last byte of grams of ``length`` bytes before it."""
        p = self.root[code & 255]
        for d in range(1, length + 1):
            if d not in self.contexts:
                continue
            known, total, pull = self.contexts[d]
            own = _part(code, d, length)
            at = np.minimum(np.searchsorted(known, own >> 8), len(known) - 1)
            hit = np.nonzero(known[at] == own >> 8)[0]
            at, own = at[hit], own[hit]
            gram, count = self.grams[d]
            spot = np.minimum(np.searchsorted(gram, own), len(gram) - 1)
            n = np.where(gram[spot] == own, count[spot], 0)
            p[hit] = (n + pull[at] * p[hit]) / (total[at] + pull[at])
        return p

    def add(self, length: int, grams: np.ndarray, counts: np.ndarray) -> None:
        """Retain those contexts of the sorted grams that diverge from their suffixes."""
        known, row, kinds = np.unique(grams >> 8, return_inverse=True, return_counts=True)
        n = counts.astype(np.float64)
        total = np.bincount(row, n, len(known))
        # The same bytes after the context's suffix.
        below = self.after((grams >> 16 << 8) | (grams & 255), length - 1)
        kept = np.bincount(row, n * np.log(n / total[row] / below), len(known)) >= DIVERGENCE
        if kept.any():
            mine = kept[row]
            self.contexts[length] = known[kept], total[kept], SMOOTH * kinds[kept]
            self.grams[length] = grams[mine], counts[mine]


class Scorer:
    """log10 probabilities of texts; remembers grams it has met."""

    def __init__(self, tree: Tree):
        self.tree, self.met, self.logs = tree, np.empty(0, np.uint64), np.empty(0)

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        for block in _blocks(texts):
            code, starts = _codes([texts[i] for i in block], self.tree.depth)
            grams, at = np.unique(code, return_inverse=True)
            out[block] = np.add.reduceat(self._logs(grams)[at], starts)
        return out

    def _logs(self, grams: np.ndarray) -> np.ndarray:
        spot = np.searchsorted(self.met, grams)
        known = np.zeros(len(grams), bool)
        inside = spot < len(self.met)
        known[inside] = self.met[spot[inside]] == grams[inside]
        out = np.empty(len(grams))
        out[known] = self.logs[spot[known]]
        new = grams[~known]
        out[~known] = fresh = np.log10(self.tree.after(new.astype(np.int64), self.tree.depth))
        if len(self.met) + len(new) <= REMEMBERED:
            order = np.argsort(np.concatenate([self.met, new]), kind="stable")
            self.met = np.concatenate([self.met, new])[order]
            self.logs = np.concatenate([self.logs, fresh])[order]
        return out


def _part_of(code: Column, length: int, depth: int) -> Column:
    """`_part` as an expression."""
    context = F.shiftright(code, 8 * (depth - length + 1))
    return F.shiftleft(context, 8).bitwiseOR(code.bitwiseAND(F.lit(255)))


def _slots(context: np.ndarray, length: int) -> np.ndarray:
    key = context.astype(np.uint64) | np.uint64(length << 56)
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Rest:
    """Retained contexts beyond the tree: ``table`` (len, context, all, next: counts by
    next byte), the lengths there are, and a packed bit for each slot of their hashes."""

    table: DataFrame
    lengths: tuple[int, ...]
    bits: np.ndarray


def _met(texts: list[bytes], depth: int, lengths: tuple[int, ...], bits: np.ndarray) -> pa.Array:
    """For each text the grams that may have such a context, with how often they occur."""
    out, times, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
    for block in _blocks(texts):
        code, starts = _codes([texts[i] for i in block], depth)
        hit = np.zeros(len(code), bool)
        for d in lengths:
            slot = _slots(code >> np.uint64(8 * (depth - d + 1)), d)
            hit |= (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
        at = np.nonzero(hit)[0]
        doc = np.searchsorted(starts, at, side="right") - 1
        order = np.lexsort((code[at], doc))
        doc, mine = doc[order], code[at][order]
        new = np.append(True, (doc[1:] != doc[:-1]) | (mine[1:] != mine[:-1]))[: len(mine)]
        first = np.nonzero(new)[0]
        out.append(mine[first].astype(np.int64))
        times.append(np.diff(np.append(first, len(mine))))
        sizes.append(np.bincount(doc[first], minlength=len(block)))
    offsets = np.concatenate([[0], *sizes]).cumsum()
    grams = pa.StructArray.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (out, times)], ["code", "times"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), grams)


def grow(grams: DataFrame, depth: int = DEPTH, least: int = LEAST_COUNT, most: int | None = None) -> tuple[Tree, Rest | None]:
    """Build the tree from (code, n): counts of grams of ``depth`` bytes before the next.

    The driver gets at most ``most`` grams, those of the most frequent contexts; the others
    come as a table. Without any text the tree is its root, where all bytes are alike.
    """
    most = HELD_GRAMS if most is None else most
    code, n = F.col("code"), F.col("n")
    parts = [F.struct(F.lit(d).alias("len"), _part_of(code, d, depth).alias("code")) for d in range(depth + 1)]
    cut = grams.select("n", F.inline(F.array(*parts)))
    counts = cut.groupBy("len", "code").agg(F.sum(n).alias("n"))
    counts = stored(counts.withColumn("context", F.shiftright("code", 8)), "tree-counts")
    admitted = counts.groupBy("len", "context").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"), (F.count("*") * F.lit(SMOOTH)).alias("pull")).where(
        (F.col("all") >= least) | (F.col("len") == 0)
    )
    level = F.floor(F.log2("all") * 8)
    admitted = stored(admitted.withColumn("level", level), "tree-contexts")
    start, seen, left = math.inf, 0, 0
    for r in admitted.groupBy("level").agg(F.sum("kinds").alias("v")).orderBy(F.desc("level")).collect():
        if seen + r["v"] <= most and not left:
            seen, start = seen + r["v"], r["level"]
        else:
            left += r["v"]
    held = (F.col("len") == 0) | (F.col("level") >= F.lit(start))
    chosen = counts.join(admitted.where(held), ["len", "context"])
    root = np.ones(256)
    for r in chosen.where(F.col("len") == 0).select("code", "n").collect():
        root[r["code"]] += r["n"]
    tree = Tree(depth, root / root.sum())
    for d in range(1, depth + 1):
        part = chosen.where(F.col("len") == d).select("code", "n").toArrow()
        if part.num_rows:
            grams_, times = (part.column(c).to_numpy() for c in ("code", "n"))
            order = np.argsort(grams_)
            tree.add(d, grams_[order], times[order])
    rest = counts.join(admitted.where(~held), ["len", "context"]).select("len", "context", "code", "n", "all", "pull")
    return tree, _extended(rest, tree, depth) if left else None


def _by_tree(grams: DataFrame, tree: Tree) -> DataFrame:
    """Adds ``p``: the tree's probability of a gram's last byte, after the ``len`` bytes
    before it."""
    share = grams.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        tree = share.value
        for b in batches:
            code, length = (b.column(c).to_numpy(zero_copy_only=False) for c in ("code", "len"))
            p = np.zeros(len(code))
            for d in np.unique(length):
                p[length == d] = tree.after(code[length == d], int(d))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], [*b.schema.names, "p"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in grams.schema)
    return grams.mapInArrow(run, f"{kinds}, p double")


def _extended(rest: DataFrame, tree: Tree, depth: int) -> Rest | None:
    """Tests the contexts of a table, shorter ones first: a context's suffix is in the tree
    or among those of the length before."""
    rest = stored(_by_tree(rest, tree), "tree-rest")
    kept, below = [], None
    have = {r["len"] for r in rest.select("len").distinct().collect()}
    of = Window.partitionBy("context")
    for d in range(1, depth + 1):
        if d not in have:
            below = None
            continue
        part = rest.where(F.col("len") == d)
        if below is not None:
            part = part.withColumn("suffix", _part_of(F.col("code"), d - 1, d))
            part = part.join(below, "suffix", "left").withColumn("p", F.coalesce("below", "p"))
        gain = F.sum(F.col("n") * F.ln(F.col("n") / F.col("all") / F.col("p"))).over(of)
        own = (F.col("n") + F.col("pull") * F.col("p")) / (F.col("all") + F.col("pull"))
        part = part.withColumn("keep", gain >= DIVERGENCE).select(
            "len", "context", "code", "n", "all", "keep", F.when(F.col("keep"), own).otherwise(F.col("p")).alias("p")
        )
        part = stored(part, "tree-tested")
        below = part.select(F.col("code").alias("suffix"), F.col("p").alias("below"))
        kept.append(part.where("keep"))
    table = reduce(DataFrame.unionByName, kept)
    entry = F.struct(F.col("code").bitwiseAND(F.lit(255)).alias("b"), "n")
    table = table.groupBy("len", "context").agg(
        F.first("all").alias("all"), F.map_from_entries(F.collect_list(entry)).alias("next")
    )
    table = stored(table, "tree-retained")

    def marks(batches):
        for b in batches:
            context, length = (b.column(c).to_numpy() for c in ("context", "len"))
            slot = np.concatenate([np.empty(0, np.int64), *[_slots(context[length == d], int(d)) for d in np.unique(length)]])
            word, at = np.unique(slot >> 5, return_inverse=True)
            bit = np.zeros(len(word), np.int64)
            np.bitwise_or.at(bit, at, np.int64(1) << (slot & 31))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit)], ["word", "bit"])

    # At most 2 ** (SLOT_BITS - 5) rows.
    found = table.select("len", "context").mapInArrow(marks, "word long, bit long")
    found = found.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    if not found.num_rows:
        return None
    bits = np.zeros(1 << (SLOT_BITS - 5), "<u4")
    bits[found.column("word").to_numpy()] = found.column("bit").to_numpy()
    return Rest(table, tuple(sorted(have - {0})), bits.view(np.uint8))


def _more(met: DataFrame, rest: Rest, tree: Tree, depth: int) -> DataFrame:
    """What the table's contexts add to the tree's log10, by code; only grams with such a
    context."""
    grams = met.select("code").distinct().withColumn("len", F.lit(depth))
    grams = stored(_by_tree(grams, tree), "tree-met").drop("len")
    tails = [
        F.struct(F.lit(d).alias("len"), F.shiftright("code", 8 * (depth - d + 1)).alias("context")) for d in rest.lengths
    ]
    tails = grams.select("code", "p", F.inline(F.array(*tails)))
    seen = F.coalesce(F.element_at("next", F.col("code").bitwiseAND(F.lit(255))), F.lit(0))
    step = F.struct("len", seen.alias("n"), "all", (F.size("next") * F.lit(SMOOTH)).alias("pull"))
    steps = tails.join(rest.table, ["len", "context"]).select("code", "p", step.alias("s"))
    p = F.aggregate(
        F.sort_array("steps"), F.col("p"), lambda p, s: (s["n"] + s["pull"] * p) / (s["all"] + s["pull"])
    )
    return steps.groupBy("code", "p").agg(F.collect_list("s").alias("steps")).select(
        "code", (F.log10(p) - F.log10("p")).alias("gain")
    )


def score_texts(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
                frequent: int = FREQUENT, most: int | None = None) -> DataFrame:
    """Rows doc_id, n_tokens, n_known, train_tokens, base_score, score, one per document.

    ``train`` says which rows the model learns from. Tokens are words and one end for
    each document. base_score: sum over tokens of log10((c + 1) / (N + V + 1)). score:
    log10 of the tree's probability of the text; ``frequent`` words and ``most`` grams
    go to every task, which changes no result. Null and empty texts are their end mark
    alone. Repeated rows and ids are scored each by itself; an empty table, or one without
    rows to learn from, gives a model that knows nothing. Other columns are not read.
    """
    texts = docs.where(train).select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = stored(
        texts.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "lm-words",
    )
    trained = texts.count()
    facts = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens = (facts["n"] or 0) + trained
    kinds = facts["v"] + (1 if trained else 0)
    # The least count at which no more than ``frequent`` words go to every task: from a
    # histogram of counts on a log scale, at most 64 * 8 rows.
    level = F.floor(F.log2("n") * 8)
    least = math.inf
    seen = 0
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("v")).orderBy(F.desc("level")).collect():
        seen += r["v"]
        if seen > frequent:
            break
        least = r["level"]
    top = counts.where(level >= F.lit(least)).toArrow()  # at most ``frequent`` rows
    scale = math.log10(tokens + kinds + 1)
    logs = {
        w.as_py(): math.log10(n.as_py() + 1) - scale
        for w, n in zip(top.column("word"), top.column("n"), strict=True)
    }
    del top
    end = math.log10(trained + 1) - scale
    grams = texts.mapInArrow(_count_grams, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    tree, more = grow(stored(grams, "lm-grams"), most=most)
    share = docs.sparkSession.sparkContext.broadcast((logs, tree, (more.lengths, more.bits) if more else None))

    def run(batches):
        logs, tree, marks = share.value
        scores = Scorer(tree)
        for b in batches:
            plain = [normal(t) for t in b.column("text").to_pylist()]
            n, hit, base, rare = [], [], [], []
            for t in plain:
                ws = t.split(b" ") if t else []
                got = list(map(logs.get, ws))
                if None in got:
                    rest = [w for w, x in zip(ws, got, strict=True) if x is None]
                    got = [x for x in got if x is not None]
                else:
                    rest = []
                n.append(len(ws) + 1)
                hit.append(len(got))
                base.append(math.fsum(got) + end)
                rare.append(rest)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(hit, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(scores(plain), pa.float64()),
                    pa.array(rare, pa.list_(pa.binary())),
                    _met(plain, tree.depth, *marks) if marks else pa.array([[]] * len(plain), MET),
                ],
                ["doc_id", "n_tokens", "hit", "base", "score", "rare", "met"],
            )

    all_docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = all_docs.schema["doc_id"].dataType.simpleString()
    scored = all_docs.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, hit long, base double, score double, rare array<binary>, met array<struct<code: bigint, times: bigint>>"
    ).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "lm-scores")  # from here on a row's number is fixed
    rest = scored.select("row", F.explode("rare").alias("word")).join(
        counts.where(level < F.lit(least)) if math.isfinite(least) else counts, "word", "left"
    )
    rest = rest.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1) - F.lit(scale)).alias("more"), F.count("n").alias("found")
    )
    if more:
        met = scored.select("row", F.inline("met"))
        gains = met.join(_more(met, more, tree, tree.depth), "code").groupBy("row").agg(
            F.sum(F.col("gain") * F.col("times")).alias("gain")
        )
        scored = scored.join(gains, "row", "left").withColumn("score", F.col("score") + F.coalesce("gain", F.lit(0.0)))
    return scored.join(rest, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("hit") + F.coalesce("found", F.lit(0)) + F.lit(1 if trained else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )
